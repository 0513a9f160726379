"""Benchmark decontamination by greedy string tiling.

Documents and test items are word sequences (lower case, ASCII punctuation and
white space between words). Seeds of ``SEED_WORDS`` words that an item and a
document share make them a pair. A pair is tiled: running Karp-Rabin hashes
find the common runs of at least s words, the longest that overlap no earlier
one are marked, again and again until none is left, then s is halved, down to
the seed length. The share of an item's words under tiles is its coverage,
which does not depend on the order of the tiles, so reordered passages count.

Items reach the tasks in blocks of bounded size; the documents are read once
for each block and are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import tidy
from sensorflow.llm.near_dup import Shingler

#: Words of a seed (the least tile), first search length, and the share of an item that condemns a document.
SEED_WORDS, FIRST_SEARCH, COVERAGE = 5, 40, 0.6
#: Characters of items that travel to every task at once, at most (a longer item goes alone).
BLOCK_CHARS = 8_000_000

_U = np.uint64
_FILTER_BITS = 22


class Words(Shingler):
    """Word hashes of folded texts, with the seeds that start at every word."""

    def __init__(self):
        super().__init__(SEED_WORDS)
        kept = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
        self.space = np.array([c not in kept for c in range(256)])

    def sequences(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        chunk: list[bytes] = []
        size = 0
        for t in texts:
            chunk.append((t or "").lower().encode("utf-8", "surrogatepass"))
            size += len(chunk[-1]) + 1
            if size >= 1 << 20:
                yield from self._sequences(chunk)
                chunk, size = [], 0
        yield from self._sequences(chunk)

    def _sequences(self, texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if texts:
            words, mixed, cut = self.hashed(texts)
            for a, b in zip(cut[:-1], cut[1:]):
                yield words[a:b], mixed[a:max(a, b - self.width + 1)]


def windows(x: np.ndarray, s: int) -> np.ndarray:
    """Karp-Rabin hashes of the windows of s words."""
    base = 0x100000001B3
    powers = np.cumprod(np.concatenate(([_U(1)], np.full(len(x), base, _U))))
    back = np.cumprod(np.concatenate(([_U(1)], np.full(len(x), pow(base, -1, 2**64), _U))))
    sums = np.concatenate((np.zeros(1, _U), np.cumsum(x * powers[:len(x)])))
    n = len(x) - s + 1
    return (sums[s:] - sums[:-s]) * back[:n] if n > 0 else np.zeros(0, _U)


def tile(p: np.ndarray, t: np.ndarray, least: int = SEED_WORDS, first: int = FIRST_SEARCH) -> list[tuple[int, int, int]]:
    """Greedy tiles (place in p, place in t, length) of two word sequences; longest first, ties to the first places."""
    free_p, free_t = np.ones(len(p), bool), np.ones(len(t), bool)
    out: list[tuple[int, int, int]] = []
    s = max(least, min(first, len(p)))
    while True:
        hp, ht = windows(p, s), windows(t, s)
        common = np.intersect1d(hp, ht)
        tp = np.flatnonzero(np.isin(hp, common))
        tt = np.flatnonzero(np.isin(ht, common))
        order = tt[np.argsort(ht[tt], kind="stable")]
        lo, hi = np.searchsorted(ht[order], hp[tp], "left"), np.searchsorted(ht[order], hp[tp], "right")
        while len(tp):
            # windows that hold no marked word
            sum_p, sum_t = np.concatenate(([0], np.cumsum(~free_p))), np.concatenate(([0], np.cumsum(~free_t)))
            a = np.repeat(tp, hi - lo)
            step = np.arange(len(a)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)
            b = order[np.repeat(lo, hi - lo) + step]
            ok = (sum_p[a + s] == sum_p[a]) & (sum_t[b + s] == sum_t[b])
            a, b = a[ok], b[ok]
            if not len(a):
                break
            # windows that follow each other on a diagonal are one run
            by = np.lexsort((a, b - a))
            a, b = a[by], b[by]
            new = np.concatenate(([True], (np.diff(b - a) != 0) | (np.diff(a) != 1)))
            at = np.flatnonzero(new)
            length = np.diff(np.append(at, len(a))) + s - 1
            pick = np.lexsort((b[at], a[at], -length))
            top = length[pick[0]]
            for k in pick:
                i, j, n = int(a[at[k]]), int(b[at[k]]), int(length[k])
                # a shorter run waits: what is left of an overlapped longer one may be longer
                if n < max(s, (top + 1) // 2):
                    break
                if free_p[i:i + n].all() and free_t[j:j + n].all():
                    free_p[i:i + n] = free_t[j:j + n] = False
                    out.append((i, j, n))
        if s == least or not free_p.any():
            return out
        s = max(least, s // 2)


class Items:
    """Test items with an index from seeds to items."""

    def __init__(self, ids: list[int], words: list[np.ndarray], keys: np.ndarray, owner: np.ndarray):
        self.ids, self.words, self.keys, self.owner = ids, words, keys, owner
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[self.keys >> _U(64 - _FILTER_BITS)] = True

    @staticmethod
    def folded(ids: list[int], texts: list[str | None]) -> tuple:
        """What the constructor takes, as plain arrays that a broadcast can hold."""
        kept, words = [], []
        keys, owner = [np.zeros(0, _U)], [np.zeros(0, int)]
        for i, (w, seeds) in zip(ids, Words().sequences(texts)):
            if len(seeds):
                keys.append(np.unique(seeds))
                owner.append(np.full(len(keys[-1]), len(kept)))
                kept.append(i)
                words.append(w)
        by = np.argsort(np.concatenate(keys), kind="stable")
        return kept, words, np.concatenate(keys)[by], np.concatenate(owner)[by]

    def sharing(self, seeds: np.ndarray) -> np.ndarray:
        """Places of the items that share a seed."""
        maybe = seeds[self.filter[seeds >> _U(64 - _FILTER_BITS)]]
        if not len(maybe):
            return np.zeros(0, int)
        maybe = np.unique(maybe)
        lo, hi = np.searchsorted(self.keys, maybe, "left"), np.searchsorted(self.keys, maybe, "right")
        return np.unique(np.concatenate([self.owner[a:b] for a, b in zip(lo, hi)] or [np.zeros(0, int)]))


PAIRS = "doc_id long, item_id long, item_words long, covered long, n_tiles long, longest long"


def _scan(items, least_share: float):
    @tidy
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bench, folder = Items(*items.value), Words()
        for pdf in batches:
            rows = []
            for doc, (words, seeds) in zip(pdf["doc_id"], folder.sequences(pdf["text"].tolist())):
                for k in bench.sharing(seeds):
                    tiles = tile(bench.words[k], words)
                    covered = sum(n for _, _, n in tiles)
                    if covered >= least_share * len(bench.words[k]):
                        rows.append((doc, bench.ids[k], len(bench.words[k]), covered, len(tiles), max(n for _, _, n in tiles)))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PAIRS.split(", ")])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out
    return run


def _blocks(benchmark: DataFrame) -> Iterator[tuple]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_CHARS))
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).orderBy("item_id", "text").collect()  # about BLOCK_CHARS
        yield Items.folded([r["item_id"] for r in part], [r["text"] for r in part])


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """One row per document and test item of which at least ``coverage`` lies under tiles.

    doc_id, item_id, item_words, covered, n_tiles, longest, coverage. Items that
    are NULL, have no id or fewer words than a seed match nothing, nor do NULL
    and empty documents. Rows that repeat an id are tiled one by one and give
    equal rows once; an empty benchmark gives no rows. Other columns are left
    out.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(f"`{id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    out = None
    for items in _blocks(benchmark):
        found = read.mapInPandas(_scan(spark.sparkContext.broadcast(items), coverage), PAIRS)
        out = found if out is None else out.unionByName(found)
    return (out.distinct().withColumn("coverage", F.col("covered") / F.col("item_words")).withColumnRenamed("doc_id", id))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """The rows of ``docs``, whole, that hold no test item; judged row by row, so ids may be NULL or repeat."""
    spark = docs.sparkSession

    def clean(items):
        @F.pandas_udf("boolean")
        @tidy
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            bench, folder = Items(*items.value), Words()
            for texts in batches:
                ok = []
                for words, seeds in folder.sequences(texts.tolist()):
                    ok.append(not any(sum(n for _, _, n in tile(bench.words[k], words)) >= coverage * len(bench.words[k]) for k in bench.sharing(seeds)))
                yield pd.Series(ok, dtype=bool)
        return run

    for items in _blocks(benchmark):
        docs = docs.where(clean(spark.sparkContext.broadcast(items))(F.col(f"`{text}`")))
    return docs


def op6_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return contaminated(docs, benchmark).select("doc_id", "item_id", "item_words", "covered", "n_tiles", "longest", "coverage")
