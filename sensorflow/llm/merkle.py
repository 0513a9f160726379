"""Merkle manifest of a dataset: a content-addressed DAG that is descended for proofs.

Build. The rows of a part (a language) are leaves, ranked by id; every
``arity`` consecutive nodes become their hash until one is left, the part's
subroot, and the subroots likewise become the root. A record of the store maps
a digest to its children, ``span`` levels of them, so a node of a record has
up to ``width = arity ** span`` descendants on its lowest level. A round builds
one layer of records for all parts: a group of at most ``width`` nodes each.

Descend. Requests for all leaves start as one at the root's digest. A request
finds its digest's record and goes on by the digits of the rank, collecting at
every level the children that were not chosen; requests that agree in their
leading digits travel as one until their digits differ. What a request has
collected is a list of path segments from the root down; at the leaf it is
reversed, hashed (the proof) and folded with the leaf to a root again.

Both take one join per layer (log of the rows to the base ``width``), and no
task holds more than a layer of ``width`` nodes per row that it reads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import spread_join, table

#: Nodes of a run, descendants of a record's node on its lowest level (at most), and records a Python function gets at once.
ARITY, WIDTH, BATCH = 2, 256, 64


def digest(parts: str) -> str:
    return hashlib.sha256(parts.encode()).hexdigest()


def runs(nodes: Sequence[str], arity: int) -> list[str]:
    """The next level: each run of ``arity`` nodes becomes its hash, the last run may be shorter."""
    return [digest("".join(nodes[i:i + arity])) for i in range(0, len(nodes), arity)]


def span_of(arity: int, width: int = WIDTH) -> int:
    """Levels of a record."""
    if arity < 2:
        raise ValueError("a run has at least two nodes")
    span = 1
    while arity ** (span + 1) <= width:
        span += 1
    return span


def leaf_hash(values: Sequence[Column]) -> Column:
    """sha256 of ``byte count:value`` of each value in its text form, ``-`` for NULL."""
    def one(c: Column) -> Column:
        s = c.cast("string")
        return F.when(s.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))
    return F.sha2(F.concat(*[one(v) for v in values]), 256)


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) and ``n`` of each row within its ``part``, by ``order``, NULLs first.

    The rows are dealt by range, so a part of any size is spread over tasks and
    its rows are numbered from the counts of the ranges before. Equal rows stay
    in any order, but are dealt over ranges too.
    """
    by = ["part", *order, "_at"]
    dealt = table(rows.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*by)
                  .withColumn("_range", F.spark_partition_id()), "merkle-dealt")
    counts = dealt.groupBy("part", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("part").orderBy("_range")  # as many rows as ranges
    counts = counts.select("part", "_range", (F.sum("_n").over(before) - F.col("_n")).alias("_before"),
                           F.sum("_n").over(Window.partitionBy("part")).alias("n"))
    place = F.row_number().over(Window.partitionBy("part", "_range").orderBy(*order, "_at"))
    return (dealt.withColumn("_place", place).join(counts, ["part", "_range"])
            .withColumn("rank", F.col("_before") + F.col("_place") - 1).drop("_at", "_range", "_place", "_before"))


RECORD = "part string, rank long, n long, digest string, levels array<array<string>>, ids array<long>, changed array<string>"


def _raised(arity: int, span: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            digests, below = [], []
            for n, nodes in zip(pdf["n"], pdf["nodes"]):
                levels = [list(nodes)]
                # an upper layer follows as long as the part has more nodes than a record holds
                while len(levels) <= span if n > arity ** span else len(levels[0]) > 1:
                    levels.insert(0, runs(levels[0], arity))
                digests.append(levels[0][0])
                below.append(levels[1:])
            yield pdf.assign(digest=digests, levels=below)[[c.split()[0] for c in RECORD.split(", ")]]
    return run


def build(leaves: DataFrame, arity: int = ARITY, width: int = WIDTH) -> tuple[list[DataFrame], DataFrame]:
    """The records of each layer, lowest first, and the tops (part, digest) of ``leaves``.

    ``leaves`` has part, rank, n, digest, id and changed.
    """
    span = span_of(arity, width)
    size = arity ** span
    layers = []
    nodes = leaves
    while True:
        groups = (nodes.groupBy("part", "n", F.floor(F.col("rank") / size).cast("long").alias("g"))
                  .agg(F.array_sort(F.collect_list(F.struct("rank", "digest", "id", "changed"))).alias("x"))
                  .select("part", F.col("g").alias("rank"), "n", F.col("x.digest").alias("nodes"),
                          F.col("x.id").alias("ids"), F.col("x.changed").alias("changed")))
        layers.append(table(groups.mapInPandas(_raised(arity, span), RECORD), "merkle-records", BATCH))
        more = layers[-1].where(F.col("n") > size)
        if more.isEmpty():
            break
        nodes = more.select("part", "rank", F.ceil(F.col("n") / size).cast("long").alias("n"), "digest",
                            F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("changed"))
    tops = layers[0].where(F.col("n") <= size)
    for layer in layers[1:]:
        tops = tops.unionByName(layer.where(F.col("n") <= size))
    return layers, tops.select("part", "digest")


def _children(levels, arity: int) -> list[list[dict]]:
    """For each node of the lowest level, the unselected children on the way to it, from the top."""
    ways: list[list[dict]] = [[]]
    for nodes in levels:
        nodes = list(nodes)
        nxt = []
        for i in range(len(nodes)):
            a = i - i % arity
            nxt.append([*ways[i // arity], {"l": "".join(nodes[a:i]), "r": "".join(nodes[i + 1:a + arity])}])
        ways = nxt
    return ways


STEP = "array<struct<l:string,r:string>>"
REQUEST = f"place long, digest string, subroot string, path {STEP}"
PROOF = "id long, leaf string, subroot string, root string, proof string, folded string"


def _goes_on(arity: int):
    """One layer down: the requests of a record's lowest nodes."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for place, subroot, path, levels, ends in zip(pdf["place"], pdf["subroot"], pdf["path"], pdf["levels"], pdf["subroots"]):
                ways = _children(levels, arity)
                for i, way in enumerate(ways):
                    node = levels[-1][i]
                    rows.append(((place * 1_000_003 + i) % 2_305_843_009_213_693_951, node, node if ends else subroot, [*path, *way]))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in REQUEST.split(", ")])
            out["place"] = out["place"].astype("int64")
            yield out
    return run


def fold(leaf: str, path: Sequence[dict]) -> str:
    """The root that ``leaf`` and its path (from the leaf up) give."""
    for step in path:
        leaf = digest(step["l"] + leaf + step["r"])
    return leaf


def _proofs(arity: int, root: str):
    """The last layer: paths from the leaf up, their hash, and the root folded from the leaf as it is now."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for digest_, subroot, path, levels, ids, changed in zip(pdf["digest"], pdf["subroot"], pdf["path"], pdf["levels"], pdf["ids"], pdf["changed"]):
                leaves = [digest_] if not len(levels) else list(levels[-1])
                above = list(path)[::-1]
                rows = []
                for i, way in enumerate(_children(levels, arity)):
                    way = way[::-1] + above
                    rows.append((leaves[i], subroot, root, digest("".join(s["l"] + s["r"] for s in way)), fold(changed[i] or leaves[i], way)))
                out = pd.DataFrame(rows, columns=["leaf", "subroot", "root", "proof", "folded"])
                yield out.assign(id=pd.array([None if v != v else int(v) for v in ids], dtype="Int64"))[[c.split()[0] for c in PROOF.split(", ")]]
    return run


def prove(rows: DataFrame, arity: int = ARITY, width: int = WIDTH) -> DataFrame:
    """id, leaf, subroot, root, proof and folded of every row of ``rows`` (part, id, digest, changed).

    ``part`` may be NULL (a part of its own, the first), as may ``id`` (the
    first of its part). ``changed`` is the row's digest as it is now, NULL where
    it did not change; ``folded`` is the root that this digest and the proof
    give. An empty table gives no rows; equal rows have leaves of their own.
    """
    spark = rows.sparkSession
    named = rows.select(F.when(F.col("part").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("part"))).alias("part"),
                        F.col("id").cast("long").alias("id"), "digest", "changed")
    leaves = table(ranked(named, ["id", "digest"]), "merkle-leaves")
    layers, tops = build(leaves, arity, width)
    # the subroots are the leaves of one more tree
    under = tops.select(F.lit("").alias("part"), F.col("part").alias("of"), "digest")
    heads = table(ranked(under, ["of"]).select("part", "rank", "n", "digest", F.lit(None).cast("long").alias("id"),
                                               F.lit(None).cast("string").alias("changed")), "merkle-heads")
    if heads.isEmpty():
        return spark.createDataFrame([], PROOF)
    upper, top = build(heads, arity, width)
    root = top.first()["digest"]
    # a digest stands for one content, so one record of it is enough
    store = layers[0].select("digest", "levels", "ids", "changed", F.lit(True).alias("low"), F.lit(False).alias("subroots"))
    for k, layer in enumerate([*layers[1:], *upper]):
        low = k == len(layers) - 1
        store = store.unionByName(layer.where(F.size("levels") > 0).select(
            "digest", "levels", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<string>").alias("changed"),
            F.lit(False).alias("low"), F.lit(low).alias("subroots")))
    store = table(store.dropDuplicates(["digest"]), "merkle-store")
    one = F.when(F.lit(heads.count() == 1), F.lit(root))
    requests = spark.range(1).select(F.lit(0).cast("long").alias("place"), F.lit(root).alias("digest"), one.alias("subroot"),
                                     F.array().cast(STEP).alias("path"))
    done = []
    while True:
        met = table(spread_join(requests, store, "digest", "place"), "merkle-met")
        done.append(table(met.where("low").mapInPandas(_proofs(arity, root), PROOF), "merkle-proofs", BATCH))
        deeper = met.where(~F.col("low"))
        if deeper.isEmpty():
            break
        requests = table(deeper.mapInPandas(_goes_on(arity), REQUEST), "merkle-requests", BATCH)
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def manifest(docs: DataFrame, id: str = "doc_id", part: str = "lang", fields: Sequence[str] = FIELDS,
             count: str = "n_chars", arity: int = ARITY) -> DataFrame:
    """``id``, leaf, subroot, root, proof_sha256, folded_root and verified of every row.

    A leaf hashes ``fields`` of its row (NULL: ``-``, else UTF-8 byte count,
    ``:`` and the value). Parts are the values of ``part``, NULL among them;
    leaves ascend by id, NULL first, then by their hash. Where 7 divides the
    CRC-32 of the id, ``count`` is read as one more, NULL stays NULL (nor does
    a row without an id change), so only there ``verified`` can be false. Rows
    that are there twice are leaves twice; an empty table gives no rows; texts
    of any length are hashed whole; other columns are left out.
    """
    col = {f: F.col(f"`{f}`") for f in {*fields, id, part, count}}
    more = {**col, count: col[count].cast("decimal(20,0)") + 1}
    hit = (F.crc32(col[id].cast("string").cast("binary")) % 7 == 0) & col[count].isNotNull()
    rows = docs.select(col[part].cast("string").alias("part"), col[id].cast("long").alias("id"),
                       leaf_hash([col[f] for f in fields]).alias("digest"),
                       F.when(hit, leaf_hash([more[f] for f in fields])).alias("changed"))
    out = prove(rows, arity)
    return out.select(F.col("id").alias(id), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"),
                      F.col("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op12_merkle(spark, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS))


#: CRC-32 of a short text is a fold over its bytes: eight shifts each, by the reversed polynomial 0xEDB88320.
OP12_SQL = """
with recursive
crc as (
  select doc_id, (4294967295 - r) & 4294967295 as crc from (
    select doc_id, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint),
      lambda a, b: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end, xor(a, b)),
      4294967295::bigint) as r
    from (select distinct doc_id from documents where doc_id is not null))),
field as (
  select d.doc_id, d.lang,
    coalesce(strlen(cast(d.doc_id as varchar)) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') as head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') as tail, coalesce(c.crc % 7 = 0, false) as hit
  from documents d left join crc c on c.doc_id = d.doc_id),
leaf as (
  select doc_id, lang, sha256(head || coalesce(strlen(cast(n_chars as varchar)) || ':' || n_chars, '-') || tail) as digest,
    case when hit then sha256(head || coalesce(strlen(cast(n_chars + 1 as varchar)) || ':' || (n_chars + 1), '-') || tail) end as changed
  from field),
ranked as (
  select *, row_number() over (partition by lang order by doc_id nulls first, digest) - 1 as rank from leaf),
low as (
  select 0 as level, lang, rank as i, digest from ranked
  union all
  (with here as (select l.*, count(*) over (partition by lang) as n from low l)
   select any_value(level) + 1, lang, i // 2, sha256(string_agg(digest, '' order by i)) from here where n > 1 group by lang, i // 2)),
sub as (
  select lang, digest, row_number() over (order by lang nulls first) - 1 as i
  from (select * from low qualify row_number() over (partition by lang order by level desc) = 1)),
high as (
  select 0 as level, i, digest from sub
  union all
  (with here as (select h.*, count(*) over () as n from high h)
   select any_value(level) + 1, i // 2, sha256(string_agg(digest, '' order by i)) from here where n > 1 group by i // 2)),
root as (select digest from high order by level desc limit 1),
walk as (
  select r.rank, r.lang, r.doc_id, s.i as top, 0 as step, r.digest as leaf, coalesce(r.changed, r.digest) as node, '' as path
  from ranked r join sub s on s.lang is not distinct from r.lang
  union all
  select w.rank, w.lang, w.doc_id, w.top, step + 1, leaf,
    sha256(case when q.i < here.i then q.digest || node when q.i > here.i then node || q.digest else node end), path || coalesce(q.digest, '')
  from walk w
  join low here on here.lang is not distinct from w.lang and here.level = w.step and here.i = w.rank >> w.step
  join low up on up.lang is not distinct from w.lang and up.level = w.step + 1 and up.i = w.rank >> (w.step + 1)
  left join low q on q.lang is not distinct from w.lang and q.level = w.step and q.i = xor(here.i, 1::bigint)),
at_sub as (select * from walk qualify row_number() over (partition by lang, rank order by step desc) = 1),
climb as (
  select rank, lang, doc_id, top, 0 as step, leaf, node, path from at_sub
  union all
  select w.rank, w.lang, w.doc_id, w.top, step + 1, leaf,
    sha256(case when q.i < here.i then q.digest || node when q.i > here.i then node || q.digest else node end), path || coalesce(q.digest, '')
  from climb w
  join high here on here.level = w.step and here.i = w.top >> w.step
  join high up on up.level = w.step + 1 and up.i = w.top >> (w.step + 1)
  left join high q on q.level = w.step and q.i = xor(here.i, 1::bigint)),
at_root as (select * from climb qualify row_number() over (partition by lang, rank order by step desc) = 1)
select a.doc_id, a.leaf, s.digest as subroot, r.digest as root, sha256(a.path) as proof_sha256, a.node as folded_root, a.node = r.digest as verified
from at_root a join sub s on s.lang is not distinct from a.lang cross join root r
"""
