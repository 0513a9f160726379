"""Near-duplicate documents by min-max hashing, confirmed on the full shingle sets.

1. One pass over the texts hashes the distinct word shingles of a document and
   keeps the minimum and the maximum under every permutation, so k permutations
   give 2k signature values. Values are banded into bucket keys; so many bands
   that a pair at the threshold shares none with a chance below ``MISS``.
2. Documents of equal shingle sets become one node (the least doc_id).
3. Star rounds: in every bucket that holds more than one component, the nodes
   outside the leader's component are compared with the leader, on full sets.
   Confirmed links are merged into components by label propagation.
4. What is left in buckets of several components is settled without comparing
   all pairs: nodes that reach the threshold share one of their rarest
   shingles (prefix filter, exact), so only nodes of different components that
   share one are compared.

No link between components of different texts is lost: every pair in a bucket
is in one component, compared, or excluded by the exact filter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import group_min, spread_join, table, tidy

#: Signature values of a band, and the chance to miss a pair at the threshold.
ROWS, MISS = 5, 1e-7
#: Star rounds before the prefix filter; bytes of text that are hashed at once.
STARS, CHUNK = 2, 1 << 20
#: Rows that go to a Python function at once.
BATCH = 1000
SEED = 20240229

_U = np.uint64


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


class Shingler:
    """Distinct shingle hashes of texts: A-Z lower-cased, words between ASCII white space."""

    def __init__(self, width: int):
        rng = np.random.default_rng(SEED)
        self.width = width
        self.codes = rng.integers(1, 2**63, 256, dtype=_U) | _U(1)
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.base = 0x9E3779B97F4A7C15
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.backward = np.ones(1, _U)
        self.mix = rng.integers(1, 2**63, width, dtype=_U) | _U(1)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            self.powers = np.cumprod(np.concatenate(([_U(1)], np.full(n, self.base, _U))))
            self.backward = np.cumprod(np.concatenate(([_U(1)], np.full(n, self.inverse, _U))))

    @staticmethod
    def _stir(h: np.ndarray) -> np.ndarray:
        h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
        return h ^ (h >> _U(31))

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The sorted distinct hashes of each text, ``CHUNK`` bytes of texts at a time."""
        chunk: list[bytes] = []
        size = 0
        for t in texts:
            b = (t or "").encode("utf-8", "surrogatepass").lower()
            chunk.append(b)
            size += len(b) + 1
            if size >= CHUNK:
                yield from self._chunk(chunk)
                chunk, size = [], 0
        yield from self._chunk(chunk)

    def hashed(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word hashes of all texts, shingle hashes from each word on, and where each text's words begin."""
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self._grow(len(raw))
        word = ~self.space[raw]
        edge = np.flatnonzero(word[1:] != word[:-1]) + 1
        if word[0]:
            edge = np.concatenate(([0], edge))
        start, end = edge[::2], edge[1::2]
        sums = np.concatenate((np.zeros(1, _U), np.cumsum(self.codes[raw] * self.powers[:len(raw)])))
        words = self._stir((sums[end] - sums[start]) * self.backward[start])
        ends = np.cumsum([len(t) + 1 for t in texts])
        cut = np.concatenate(([0], np.searchsorted(start, ends)))
        w = self.width
        n = len(words) - w + 1
        mixed = np.zeros(max(n, 0), _U)
        for k in range(w if n > 0 else 0):
            mixed += words[k:k + n] * self.mix[k]
        return words, self._stir(mixed), cut

    def _chunk(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        if not texts:
            return
        words, mixed, cut = self.hashed(texts)
        w = self.width
        for a, b in zip(cut[:-1], cut[1:]):
            if b - a >= w:
                s = np.sort(mixed[a:b - w + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:  # the whole sequence, kept apart from shingles by its length
                h = np.sum(words[a:b] * self.mix[:b - a], dtype=_U) + _U(int(b - a))
                yield self._stir(np.array([h], _U))
            else:
                yield np.zeros(0, _U)


class Signer:
    """Bucket keys from the minima and maxima under multiplicative permutations."""

    def __init__(self, rows: int, bands: int):
        rng = np.random.default_rng(SEED + 1)
        self.rows, self.bands = rows, bands
        self.multipliers = rng.integers(1, 2**63, -(-rows * bands // 2), dtype=_U) | _U(1)
        self.fold = rng.integers(1, 2**63, rows, dtype=_U) | _U(1)
        self.salt = rng.integers(1, 2**63, bands, dtype=_U)

    def keys(self, s: np.ndarray) -> np.ndarray:
        k = len(self.multipliers)
        low = np.full(k, ~_U(0))
        high = np.zeros(k, _U)
        for at in range(0, len(s), 4096):  # long texts in bounded memory
            x = s[None, at:at + 4096] * self.multipliers[:, None]
            np.minimum(low, x.min(axis=1), out=low)
            np.maximum(high, x.max(axis=1), out=high)
        both = np.stack((low, high), axis=1).ravel()[:self.rows * self.bands]
        mixed = (both.reshape(self.bands, self.rows) * self.fold).sum(axis=1, dtype=_U) + self.salt
        return Shingler._stir(mixed).view(np.int64)


def _signed(width: int, rows: int, bands: int):
    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler, signer = Shingler(width), Signer(rows, bands)
        for pdf in batches:
            n, key, keys = [], [], []
            for s in shingler.sets(pdf["text"].tolist()):
                n.append(len(s))
                key.append(_key(s) if len(s) else None)
                keys.append(signer.keys(s) if len(s) else None)
            yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "n": n, "skey": key, "bands": keys})
    return run


def _key(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sets(width: int, keyed: bool = False):
    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler(width)
        for pdf in batches:
            for at in range(0, len(pdf), 500):
                part = pdf.iloc[at:at + 500]
                sets = list(shingler.sets(part["text"].tolist()))
                out = pd.DataFrame({"node": part["id"].to_numpy(), "s": [s.view(np.int64) for s in sets]})
                yield out.assign(skey=[_key(s) if len(s) else None for s in sets]) if keyed else out
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets reach the threshold."""
    left = spread_join(pairs, sets.withColumnRenamed("node", "u").withColumnRenamed("s", "su"), "u", "v")
    both = spread_join(left, sets.withColumnRenamed("node", "v").withColumnRenamed("s", "sv"), "v", "u")
    return (both.withColumn("both", F.size(F.array_intersect("su", "sv")))
            .where(F.col("both") * 100 >= percent * (F.size("su") + F.size("sv") - F.col("both")))
            .select("u", "v").distinct())


def merge(comps: DataFrame, links: DataFrame) -> DataFrame:
    """comps(node, n, comp) after joining the components that links(u, v) connect.

    Label propagation with pointer jumping over the graph of components; each
    round is a written table, and the rounds end when no label changes.
    """
    of = comps.select("node", "comp")
    a = links.join(of.withColumnRenamed("node", "u").withColumnRenamed("comp", "a"), "u")
    ab = a.join(of.withColumnRenamed("node", "v").withColumnRenamed("comp", "b"), "v").where("a <> b")
    edges = table(ab.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
                  .select("e.a", "e.b").distinct(), "dup-edges")
    if edges.isEmpty():
        return comps
    labels = table(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("label")), "dup-labels")
    changed = True
    while changed:
        # rows of two or three numbers: a hub's share of them is left to the engine's skew join
        near = edges.join(labels.withColumnRenamed("a", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, "a").select("a", "label", F.least("label", "near").alias("new"))
        jump = step.join(labels.select(F.col("a").alias("new"), F.col("label").alias("far")), "new", "left")
        moved = table(jump.select("a", "label", F.least("new", F.coalesce("far", "new")).alias("new")), "dup-labels")
        changed = not moved.where("new <> label").isEmpty()
        labels = moved.select("a", F.col("new").alias("label"))
    out = spread_join(comps, labels.withColumnRenamed("a", "comp"), "comp", "node", "left")
    return table(out.select("node", "n", F.coalesce("label", "comp").alias("comp")), "dup-comps")


def _fits(n: str, m: str, percent: int):
    """Sets of these sizes can reach the threshold."""
    return F.least(n, m) * 100 >= percent * F.greatest(n, m)


def _star(buckets: DataFrame, comps: DataFrame, tested: DataFrame | None, round_: int, percent: int) -> DataFrame:
    """Untested pairs of a bucket's leader with the nodes outside its component."""
    placed = buckets.join(comps, "node")
    order = F.col("node") if round_ == 0 else F.xxhash64("node", F.lit(round_))
    lead = (placed.groupBy("band").agg(F.min(F.struct(order.alias("o"), "node", "n", "comp")).alias("l"),
                                       F.min("comp").alias("c0"), F.max("comp").alias("c1"))
            .where("c0 < c1").select("band", F.col("l.node").alias("lead"), F.col("l.n").alias("ln"), F.col("l.comp").alias("lc")))
    pairs = (spread_join(placed, lead, "band", "node").where((F.col("comp") != F.col("lc")) & _fits("n", "ln", percent))
             .select(F.least("node", "lead").alias("u"), F.greatest("node", "lead").alias("v")).distinct())
    return pairs if tested is None else pairs.join(tested, ["u", "v"], "left_anti")


def _rest(buckets: DataFrame, comps: DataFrame, sets: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Untested pairs of different components that the prefix filter lets through."""
    placed = buckets.join(comps, "node")
    # a bucket of two was settled by its leader
    open_ = placed.groupBy("band").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("m")).where("c0 < c1 and m > 2")
    nodes = buckets.join(open_.select("band"), "band", "left_semi").select("node").distinct()
    words = table(sets.join(nodes, "node", "left_semi").select("node", F.explode("s").alias("w")), "dup-words")
    many = words.groupBy("w").agg(F.count(F.lit(1)).alias("df"))
    held = spread_join(words, many, "w", "node")
    # the rarest n - ceil(percent * n / 100) + 1 shingles of a node; an array per document
    rare = (held.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("all"))
            .select("node", F.posexplode(F.slice("all", 1, (F.size("all") - F.ceil(F.size("all") * percent / 100) + 1).cast("int"))).alias("at", "r"))
            .where("r.df > 1").select("node", "at", F.col("r.w").alias("w")))
    rare = table(rare.join(comps, "node"), "dup-rare")
    by_comp = rare.groupBy("w", "comp").agg(F.count(F.lit(1)).alias("k"))
    main = (by_comp.groupBy("w").agg(F.max(F.struct("k", "comp")).alias("m"), F.count(F.lit(1)).alias("c"))
            .where("c > 1").select("w", F.col("m.comp").alias("main")))
    mixed = table(spread_join(rare, main, "w", "node"), "dup-mixed")
    few = mixed.where("comp <> main").select("w", F.col("node").alias("x"), F.col("comp").alias("cx"), F.col("n").alias("nx"), F.col("at").alias("ax"))
    # two sets that reach the threshold have this many shingles in common, so they
    # share one of the first (size - common + 1) of either
    common = F.ceil((F.col("n") + F.col("nx")) * percent / (100 + percent))
    near = (F.col("at") <= F.col("n") - common) & (F.col("ax") <= F.col("nx") - common)
    pairs = (mixed.join(few, "w").where((F.col("comp") != F.col("cx")) & _fits("n", "nx", percent) & near)
             .select(F.least("node", "x").alias("u"), F.greatest("node", "x").alias("v")).distinct())
    return pairs.join(tested, ["u", "v"], "left_anti")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 85,
                    rows: int = ROWS) -> DataFrame:
    """``id``, n_shingles, component_id and kept of every row.

    Words are lower-cased (A-Z) and split at ASCII white space; a text of fewer
    words than ``width`` has its whole sequence as its one shingle, and a NULL,
    empty or blank text has none and is linked with nothing. Two documents are
    linked if 100 * intersection >= percent * union. component_id is the least
    id reachable. Rows that repeat an id are one document, whose texts are linked
    with each other; n_shingles is that of the row. A row with a NULL id is
    linked with nothing and kept. An empty table gives no rows; texts of any
    length are read whole; other columns are left out.
    """
    read = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    bands = bands_for(percent, rows)
    signed = table(read.mapInPandas(_signed(width, rows, bands), "id long, n long, skey binary, bands array<long>"), "dup-signed", BATCH)
    known = table(group_min(signed.select("id", "n", F.expr("case when id is not null then skey end").alias("skey")), "skey", "id", "least")
                  .withColumn("node", F.col("least")), "dup-known")
    # an id with several sets would name several nodes: the sets that it is the least id of get numbers of their own
    several = table(known.where("skey is not null").groupBy("id").agg(F.min("skey").alias("a"), F.max("skey").alias("b")).where("a <> b").select("id"), "dup-several")
    repeats = not several.isEmpty()
    if repeats:
        own = F.when(F.col("own"), F.xxhash64("skey").bitwiseOR(F.lit(-2**63))).otherwise(F.col("least"))
        known = table(spread_join(known, several.select(F.col("id").alias("least"), F.lit(True).alias("own")), "least", "skey", "left")
                      .select("id", "n", "skey", "least", own.alias("node")), "dup-known")
    heads = known.where("id = least").select("id", "skey", "node").distinct()
    firsts = signed.select("id", "n", "skey", "bands").join(heads, ["id", "skey"])
    exploded = firsts.select("node", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b").select("band")
    buckets = table(exploded.join(shared, "band", "left_semi").distinct(), "dup-buckets")
    nodes = buckets.select("node")
    if repeats:
        texts_of = known.join(several, "id", "left_semi").select("id", "node").distinct()
        same = table(texts_of.join(texts_of.groupBy("id").agg(F.min("node").alias("u")), "id").where("u <> node").select("u", F.col("node").alias("v")).distinct(), "dup-same")
        nodes = nodes.union(same.select("u")).union(same.select("v"))
    nodes = table(nodes.distinct(), "dup-nodes")
    size = known.where("id = least").groupBy("node").agg(F.max("n").alias("n"))
    comps = table(size.join(nodes, "node", "left_semi").select("node", "n", F.col("node").alias("comp")), "dup-comps")
    if repeats:
        comps = merge(comps, same)
        wanted = heads.join(nodes, "node", "left_semi")
        found = read.join(wanted.select("id").distinct(), "id", "left_semi").mapInPandas(_sets(width, keyed=True), "node long, s array<long>, skey binary")
        sets = table(found.withColumnRenamed("node", "id").join(wanted, ["id", "skey"]).select("node", "s").dropDuplicates(["node"]), "dup-sets", BATCH)
    else:
        texts = read.join(nodes.withColumnRenamed("node", "id"), "id", "left_semi")
        sets = table(texts.mapInPandas(_sets(width), "node long, s array<long>").distinct(), "dup-sets", BATCH)
    tested = None
    for k in range(STARS):
        pairs = table(_star(buckets, comps, tested, k, percent), "dup-pairs")
        comps = merge(comps, table(_confirmed(pairs, sets, percent), "dup-links"))
        tested = pairs if tested is None else tested.union(pairs)
    pairs = table(_rest(buckets, comps, sets, tested, percent), "dup-pairs")
    comps = merge(comps, table(_confirmed(pairs, sets, percent), "dup-links"))
    comp = comps.groupBy("node").agg(F.min("comp").alias("comp"))
    out = spread_join(known, comp, "node", "id", "left")
    if repeats:  # labels are not ids then
        out = group_min(out, "comp", "id", "root").drop("comp").withColumnRenamed("root", "comp")
    out = out.withColumn("component_id", F.coalesce("comp", "least", "id"))
    # a row without words of an id that has others is in their component
    blank = known.where("id is not null and skey is null").select("id").distinct()
    mixed = table(known.where("skey is not null").join(blank, "id", "left_semi").select("id").distinct(), "dup-mixed-ids")
    if not mixed.isEmpty():
        theirs = out.where("skey is not null").join(mixed, "id", "left_semi").groupBy("id").agg(F.min("component_id").alias("theirs"))
        out = spread_join(out, theirs, "id", "node", "left").withColumn("component_id", F.coalesce("theirs", "component_id"))
    return out.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, whole, but those of documents that are in the component of a lesser doc_id.

    Rows without an id or a text stay; all rows of an id stay or go together.
    """
    gone = near_duplicates(docs, width=width, percent=percent).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op8_near_dup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
