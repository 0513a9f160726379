"""Ranked lexical search with pipelined term partitioning.

Index. One scan counts the query terms of every document. Documents are dealt
into blocks, and a block's postings (places of its documents, and what the term
adds to their scores, in integers) are kept per term.

Owners. The terms are cut by document frequency into stages, each of which owns
its terms: the rarest first, the most frequent last.

Pipeline. Items travel in bundles. A bundle at a block carries the sparse sums of
its items' documents; at every stage it meets the postings that the stage's
terms have in that block (cogroup on bundle and block), adds them, and goes
on. Between stages the k-th greatest sum of an item over all blocks bounds its
result from below, and the greatest contributions of the terms still to come
bound a document from above: sums that cannot reach the k best are left
behind. The bounds are exact, so the result is that of the full sums.

A frequent term, a third of all rows say, is spread over the blocks; a block
holds about ``DOCS`` documents, a bundle about ``ITEMS`` items, and a task at most
their product of sums.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorflow.llm.common import spread_join, table, work_dir

#: Documents of a block, items of a bundle, and query terms that travel to every task at once (more take more scans).
DOCS, ITEMS, TERMS = 4096, 256, 1 << 18
#: Shares of all postings up to which each stage owns terms, from the rarest term on.
SHARES = (1 / 64, 1 / 16, 1 / 4, 1.0)
#: Rows that go to a Python function at once, and bytes of a text whose terms are listed at once.
BATCH, CHUNK = 1000, 1 << 22

_TERM, _GAP = re.compile(rb"[0-9A-Za-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")


def counted(text: str | None) -> Counter:
    """Occurrences of each term: runs of ASCII letters, digits and all code points from U+0080 on; only A-Z lower-cased."""
    b = (text or "").encode("utf-8", "surrogatepass").lower()
    if len(b) <= CHUNK:
        return Counter(_TERM.findall(b))
    out: Counter = Counter()
    at = 0
    while at < len(b):  # long texts in pieces that end between terms
        gap = _GAP.search(b, min(at + CHUNK, len(b)))
        end = gap.start() if gap else len(b)
        out.update(_TERM.findall(b, at, end))
        at = end + 1
    return out


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for item, text in zip(pdf["item"], pdf["text"]):
            terms = list(counted(text))
            yield pd.DataFrame({"item": np.full(len(terms), item, "int64"), "term": terms})


POSTED = "row long, id long, n long, numbers array<int>, tfs array<long>"


def _posted(vocabulary):
    """Terms and counts of each document that has any term; ``vocabulary`` numbers the query terms."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = {t: i for i, t in enumerate(vocabulary.value)}
        for pdf in batches:
            rows = []
            for row, id_, text in zip(pdf["row"], pdf["id"].astype("Int64"), pdf["text"]):
                c = counted(text)
                if c:
                    hits = sorted((number[t], c[t]) for t in c.keys() & number.keys())
                    rows.append((row, id_, sum(c.values()), [h[0] for h in hits], [h[1] for h in hits]))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in POSTED.split(", ")])
            yield out.astype({"row": "int64", "id": "Int64", "n": "int64"})
    return run


def measure(n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """The length of a document against the mean, in hundredths, half weighted."""
    return np.array([100 - 50 + (50 * int(x) * documents) // tokens for x in n], dtype="int64")


INVERTED = "block long, number int, stage int, places binary, gains binary, ids binary"


def _inverted(weights, stages, documents: int, tokens: int):
    """The postings of a block by term, and one row (number -1) with the ids of its documents by place, ascending."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        weight, stage = weights.value, stages.value
        pdf = pdf.sort_values(["id", "row"], kind="stable")
        m = measure(pdf["n"].to_numpy(), documents, tokens)
        sizes = pdf["numbers"].map(len).to_numpy()
        place = np.repeat(np.arange(len(pdf), dtype="int32"), sizes)
        number = np.concatenate([np.asarray(x, "int32") for x in pdf["numbers"]])
        tf = np.concatenate([np.asarray(x, "int64") for x in pdf["tfs"]])
        gain = weight[number] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[place]))
        by = np.argsort(number, kind="stable")
        number, place, gain = number[by], place[by], gain[by]
        cut = np.flatnonzero(np.concatenate((number[:1] >= 0, number[1:] != number[:-1], number[:1] >= 0)))
        rows = [(int(number[a]), int(stage[number[a]]), place[a:b].tobytes(), gain[a:b].tobytes(), None) for a, b in zip(cut[:-1], cut[1:])]
        rows.append((-1, -1, None, None, pdf["id"].to_numpy("int64").tobytes()))
        out = pd.DataFrame(rows, columns=["number", "stage", "places", "gains", "ids"])
        out.insert(0, "block", pdf["block"].iloc[0])
        return out
    return run


SUMS = "bundle long, block long, items binary, places binary, sums binary, top_items array<int>, top_sums array<long>"


def best_of(sums: np.ndarray, k: int) -> np.ndarray:
    """Places of the k greatest sums above 0, ties to the first places."""
    place = np.flatnonzero(sums > 0)
    if len(place) > k:
        least = np.partition(sums[place], len(place) - k)[len(place) - k]
        more, ties = place[sums[place] > least], place[sums[place] == least]
        place = np.concatenate((more, ties[:k - len(more)]))
    return place


def _stage(last: int, k: int):
    """A bundle at a block meets the postings of one owner; ``last``: its stage."""
    def run(key: tuple, carried: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        names = [c.split()[0] for c in SUMS.split(", ")]
        if not len(carried):
            return pd.DataFrame([], columns=names)
        here = carried.iloc[0]
        items, places = np.frombuffer(here["items"], "int32"), np.frombuffer(here["places"], "int32")
        met = [(np.frombuffer(r.places, "int32"), np.frombuffer(r.gains, "int64"), r.items) for r in postings.itertuples()]
        wide = 1 + max([int(places.max()) if len(places) else -1, *(int(p.max()) for p, _, _ in met)])
        sums = np.zeros((int(here["size"]), wide), "int64")
        sums[items, places] = np.frombuffer(here["sums"], "int64")
        for p, gain, wanted in met:
            for i in wanted:
                sums[i, p] += gain
        rest, floor = np.zeros(len(sums), "int64"), np.ones(len(sums), "int64")
        for x in here["to_come"]:
            if x["stage"] > last:
                rest[x["slot"]] += x["most"]
        for x in here["floors"] if here["floors"] is not None else ():
            floor[x["slot"]] = max(1, x["floor"])
        kept = (sums > 0) & (sums + rest[:, None] >= floor[:, None])
        for i in np.flatnonzero(rest == 0):  # final sums: the k best of a block are enough
            kept[i], best = False, best_of(sums[i], k)
            kept[i, best] = True
        at, place = np.nonzero(kept)
        tops = [(i, best_of(sums[i], k)) for i in np.unique(at)]
        return pd.DataFrame([(key[0], key[1], at.astype("int32").tobytes(), place.astype("int32").tobytes(), sums[at, place].tobytes(),
                              np.concatenate([np.full(len(p), i, "int32") for i, p in tops] or [np.zeros(0, "int32")]),
                              np.concatenate([sums[i, p] for i, p in tops] or [np.zeros(0, "int64")]))], columns=names)
    return run


def _selected(k: int):
    """The k best documents of every item within a block, by their ids."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                items, places = np.frombuffer(r.items, "int32"), np.frombuffer(r.places, "int32")
                sums, ids = np.frombuffer(r.sums, "int64"), np.frombuffer(r.ids, "int64")
                for i in np.unique(items):
                    mine = items == i
                    at = best_of(sums[mine], k)
                    yield pd.DataFrame({"bundle": r.bundle, "slot": i, "doc_id": ids[places[mine][at]], "score": sums[mine][at]})
    return run


RANKED = "item_id long, rank int, doc_id long, score long"


def search(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", k: int = 50) -> DataFrame:
    """item_id, rank, doc_id, score: the k highest-scoring documents of every item, ties to the smaller id.

    Every row of ``docs`` is a document, also where ids or texts repeat. A NULL
    or empty text has no terms and counts in nothing. A document without an
    id counts in the statistics, but is not returned. The terms of an item are
    those of all rows of its id, once each; items without an id or terms, or
    whose terms no document has, give no rows, as do empty tables. Texts of any
    length are read whole; other columns are left out.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    asked = items.select(F.col(f"`{item}`").cast("long").alias("item"), F.col(f"`{item_text}`").alias("text")).where("item is not null and text is not null")
    pairs = table(asked.mapInPandas(_terms, "item long, term binary").distinct(), "lex-pairs")
    distinct = pairs.select("term").distinct()
    scans = -(-distinct.count() // TERMS)
    none = spark.createDataFrame([], RANKED)
    if not scans:
        return none
    # a scan's terms are about TERMS, numbered within the scan
    terms = table(distinct.withColumn("scan", F.pmod(F.xxhash64("term"), F.lit(scans)).cast("int"))
                  .withColumn("number", (F.row_number().over(Window.partitionBy("scan").orderBy("term")) - 1).cast("int")), "lex-terms")
    numbered = read.withColumn("row", F.monotonically_increasing_id())
    if scans > 1:  # all scans must agree on the rows
        numbered = table(numbered, "lex-rows")
    posted = []
    for s in range(scans):
        vocabulary = spark.sparkContext.broadcast([bytes(r["term"]) for r in terms.where(F.col("scan") == s).orderBy("number").select("term").collect()])
        posted.append(table(numbered.mapInPandas(_posted(vocabulary), POSTED), "lex-posted", BATCH))
        vocabulary.unpersist()
    total = posted[0].agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("tokens")).first()
    documents, tokens = total["documents"], total["tokens"]
    if not documents:
        return none

    # bundles: places of the items, what their terms can add at most at each stage
    count = pairs.select("item").distinct().count()
    bundles = -(-count // ITEMS)
    slots = table(pairs.select("item").distinct().withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)))
                  .withColumn("slot", (F.row_number().over(Window.partitionBy("bundle").orderBy("item")) - 1).cast("int")), "lex-slots")
    blocks = -(-documents // DOCS)
    uses, inverted = [], []
    for s in range(scans):
        m = F.lit(50) + F.expr(f"(cast(50 as decimal(38,0)) * n * {documents}) div {tokens}")
        one = posted[s].select("n", F.explode(F.arrays_zip("numbers", "tfs")).alias("p"))
        stats = (one.select(F.col("p.numbers").alias("number"), F.expr("(1000000000 * p.tfs)").alias("up"), (1000 * F.col("p.tfs") + 20 * m.cast("long")).alias("down"))
                 .groupBy("number").agg(F.count(F.lit(1)).alias("df"), F.max(F.expr("up div down")).alias("most")))
        order = Window.orderBy("df", "number").rowsBetween(Window.unboundedPreceding, 0)  # about TERMS rows
        share = F.sum("df").over(order) / F.sum("df").over(Window.partitionBy())
        stage = F.lit(s * len(SHARES) + len(SHARES) - 1)
        for j in reversed(range(len(SHARES) - 1)):
            stage = F.when(share <= SHARES[j], F.lit(s * len(SHARES) + j)).otherwise(stage)
        w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * documents + 2)) / (2 * F.col("df") + 1))).cast("long")
        known = table(stats.withColumn("w", w).withColumn("stage", stage).withColumn("most", F.col("w") * F.col("most")), "lex-known")
        size = terms.where(F.col("scan") == s).count()
        weights, stages = np.zeros(size, "int64"), np.zeros(size, "int32")
        for r in known.select("number", "w", "stage").collect():  # about TERMS rows
            weights[r["number"]], stages[r["number"]] = r["w"], r["stage"]
        sent = spark.sparkContext.broadcast(weights), spark.sparkContext.broadcast(stages)
        path = work_dir(spark, "lex-inverted")
        dealt = posted[s].where("id is not null").withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        (dealt.groupBy("block").applyInPandas(_inverted(*sent, documents, tokens), INVERTED)
         .write.partitionBy("stage").parquet(path))
        for x in sent:
            x.unpersist()
        inverted.append(spark.read.schema(INVERTED).parquet(path))
        mine = terms.where(F.col("scan") == s).join(known, "number")
        uses.append(pairs.join(mine, "term").join(slots, "item").select("bundle", "slot", "stage", "number", "most"))
    used = uses[0]
    for x in uses[1:]:
        used = used.unionByName(x)
    used = table(used, "lex-used")
    sizes = slots.groupBy("bundle").agg((F.max("slot") + 1).alias("size"))
    most = used.groupBy("bundle", "slot", "stage").agg(F.sum("most").alias("most"))
    heads = table(sizes.join(most.groupBy("bundle").agg(F.collect_list(F.struct("slot", "stage", "most")).alias("to_come")), "bundle"), "lex-bundles")

    # every bundle starts at every block with no sums
    ids = inverted[0].where("stage = -1").select("block", "ids")
    empty = F.lit(b"")
    sums = ids.select(F.explode(F.expr(f"sequence(0L, {bundles - 1}L)")).alias("bundle"), "block",
                      empty.alias("items"), empty.alias("places"), empty.alias("sums"))
    floors = None
    for s in range(scans * len(SHARES)):
        info = heads.withColumn("floors", F.lit(None).cast("array<struct<slot:int,floor:long>>")) if floors is None else heads.join(floors, "bundle", "left")
        carried = spread_join(sums, info, "bundle", "block")
        # the bundles and items that want a term travel to its postings: one row per term
        wanted = (used.where(F.col("stage") == s).groupBy("number", "bundle").agg(F.collect_list("slot").alias("items"))
                  .groupBy("number").agg(F.collect_list(F.struct("bundle", "items")).alias("by")))
        postings = (spread_join(inverted[s // len(SHARES)].where(F.col("stage") == s).select("block", "number", "places", "gains"), wanted, "number", "block")
                    .select("block", "places", "gains", F.explode("by").alias("b")).select("b.bundle", "block", "places", "gains", "b.items"))
        postings = postings.toDF(*postings.columns)  # columns of its own: both sides come from one table
        done = table(carried.groupBy("bundle", "block").cogroup(postings.groupBy("bundle", "block")).applyInPandas(_stage(s, k), SUMS), "lex-sums")
        top = (done.select("bundle", F.explode(F.arrays_zip("top_items", "top_sums")).alias("t"))
               .withColumn("at", F.row_number().over(Window.partitionBy("bundle", "t.top_items").orderBy(F.desc("t.top_sums")))).where(F.col("at") <= k))
        floors = (top.groupBy("bundle", F.col("t.top_items").alias("slot")).agg(F.min("t.top_sums").alias("floor"), F.count(F.lit(1)).alias("c"))
                  .where(F.col("c") == k).groupBy("bundle").agg(F.collect_list(F.struct("slot", "floor")).alias("floors")))
        sums = done.select("bundle", "block", "items", "places", "sums")
    found = sums.join(ids, "block").mapInPandas(_selected(k), "bundle long, slot int, doc_id long, score long")
    rank = F.row_number().over(Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), "doc_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.join(slots, ["bundle", "slot"]).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def op11_lexical(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


OP11_SQL = r"""
with
word as (
  select rowid_ as row, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as rowid_, doc_id, text from documents)),
tf as (select row, any_value(doc_id) as doc_id, term, count(*) as tf from word group by row, term),
len as (select row, sum(tf)::bigint as n from tf group by row),
total as (select count(*) as docs, sum(n)::bigint as tokens from len),
weight as (
  select term, floor(1000 * ln((2.0::double * any_value(docs) + 2) / (2 * count(*) + 1)))::bigint as w
  from tf cross join total group by term),
query as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark where item_id is not null),
score as (
  select q.item_id, tf.row, any_value(tf.doc_id) as doc_id,
    sum(weight.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * (50 + (50 * len.n * total.docs) // total.tokens))))::bigint as score
  from query q join tf using (term) join weight using (term) join len on len.row = tf.row cross join total
  group by q.item_id, tf.row)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score
from score where score > 0 and doc_id is not null
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50
"""
