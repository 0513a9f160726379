"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding lower-cases, maps homoglyphs to Latin letters, undoes digit and sign
substitutions inside words, and leaves single spaces between words. Entries are
whole words and word beginnings; their weights are smoothed log-odds from the
labelled training rows. Word pairs that the training rows show to be harmless
although they hold an entry become exception phrases: matches inside them do
not count. The matched weight, alone and per length, goes through a logistic
fit to a score between 0 and 1.

Labels are read in training only, and only of rows outside the held-out fold.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import table, tidy

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ɡ": "g", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m",
    "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y", "α": "a", "ε": "e",
    "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ո": "n", "ս": "u",
}
#: Signs written for letters; they count inside a word only.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "l"}

#: Labelled rows from which the lexicon is learned, at most (the least hashes of their ids).
TRAIN_ROWS = 40_000
#: Lengths of word beginnings, rows an entry needs, its least share of toxic rows, and entries in all.
PREFIXES, MIN_ROWS, MIN_SHARE, MAX_ENTRIES = (4, 5, 6), 6, 0.8, 20_000
FOLDS, HELD_OUT = 5, 0

_GLYPHS = str.maketrans(HOMOGLYPHS)
_SIGNS = "".join(map(re.escape, SUBSTITUTES))
_INSIDE = re.compile(rf"(?<=[^\W\d_])[{_SIGNS}]+(?=[^\W\d_])|(?<![\w{_SIGNS}])[{_SIGNS}](?=[^\W\d_])")
_GAPS = re.compile(r"[\W\d_]+")
_SUBST = str.maketrans(SUBSTITUTES)
_FOLDED = re.compile(rf"[^\x00-\x7f]|[{_SIGNS}]")


def fold(text: str) -> str:
    """``text`` as lower-case words between single spaces, with a space at either end."""
    text = text.lower()
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text).lower()
        text = text.translate(_GLYPHS)
    if _FOLDED.search(text):
        text = _INSIDE.sub(lambda m: m[0].translate(_SUBST), text)
    return f" {_GAPS.sub(' ', text).strip()} "


@dataclass
class Model:
    """Entries are `` word `` or `` beginning`` (a leading space) with their weights."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    fit: tuple[float, float, float] = (-4.0, 1.0, 0.5)

    def automaton(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        a = ahocorasick.Automaton()
        for entry, w in self.weights.items():
            a.add_word(entry, (len(entry), w))
        for phrase in self.exceptions:
            a.add_word(phrase, (len(phrase), None))
        a.make_automaton()
        return a

    def scores(self, texts: list[str]) -> np.ndarray:
        a = self.automaton()
        return np.array([self.probability(matched(a, fold(t or ""))) for t in texts], float)

    def probability(self, x: tuple[float, float]) -> float:
        b, w, d = self.fit
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, b + w * x[0] + d * x[1]))))


def matched(a: ahocorasick.Automaton | None, folded: str) -> tuple[float, float]:
    """log(1 + weight) and log(1 + weight per 100 characters) of the counted matches."""
    if a is None:
        return 0.0, 0.0
    hits, free = [], []
    for end, (n, w) in a.iter(folded):
        (hits if w is not None else free).append((end - n + 1, end + 1, w))
    if free:
        starts = np.array([s for s, _, _ in free])
        reach = np.maximum.accumulate([e for _, e, _ in sorted(free)])
        starts.sort()

        def harmless(s: int, e: int) -> bool:
            k = int(np.searchsorted(starts, s, "right")) - 1
            return k >= 0 and reach[k] >= e

        hits = [h for h in hits if not harmless(h[0], h[1])]
    best: dict[int, float] = {}  # one entry counts per word: the heaviest
    for s, _, w in hits:
        best[s] = max(best.get(s, 0.0), w)
    total = sum(best.values())
    return math.log1p(total), math.log1p(100 * total / max(1, len(folded)))


def _features(words: list[str]) -> set[str]:
    out = {f" {w} " for w in words}
    for n in PREFIXES:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


def _counted(batches: Iterator[pd.DataFrame], features) -> Iterator[pd.DataFrame]:
    """(feature, toxic, clean) row counts of a partition; flushed in part before they grow large."""
    pos, neg = Counter(), Counter()

    def out():
        keys = list(pos | neg)
        return pd.DataFrame({"feature": keys, "toxic": [pos[k] for k in keys], "clean": [neg[k] for k in keys]})

    for pdf in batches:
        for text, y in zip(pdf["text"], pdf["y"]):
            (pos if y else neg).update(features(fold(text)))
            if len(pos) + len(neg) > 400_000:
                yield out()
                pos.clear(), neg.clear()
    yield out()


_COUNTS = "feature string, toxic long, clean long"


def train(labelled: DataFrame) -> Model:
    """Model from labelled(text, y); y is 1 for toxic. Without both classes, a model of no entries.

    ``labelled_rows`` bounds the rows by ``TRAIN_ROWS``; at most
    ``MAX_ENTRIES`` entries, the heaviest, reach the driver.
    """
    spark = labelled.sparkSession
    rows = table(labelled.select("text", "y"), "tox-train")
    n = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model(fit=(-4.0 if n.get(0, 1) else 4.0, 1.0, 0.5))
    rows = rows.repartition(max(8, spark.sparkContext.defaultParallelism))
    counts = rows.mapInPandas(lambda b: _counted(b, lambda t: _features(t.split())), _COUNTS)
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    share = F.col("toxic") / n[1] / (F.col("toxic") / n[1] + F.col("clean") / n[0])
    entries = (counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
               .where((F.col("toxic") >= MIN_ROWS) & (share >= MIN_SHARE) & (F.col("toxic") >= 2 * F.col("clean")))
               .withColumn("weight", odds).orderBy(F.desc("weight"), "feature").limit(MAX_ENTRIES).collect())
    weights: dict[str, float] = {}
    for r in sorted(entries, key=lambda r: (len(r["feature"]), r["feature"])):
        stem = r["feature"].rstrip()
        # a longer entry adds nothing to a beginning that is as telling
        if not any(weights.get(stem[:k], -1) >= r["weight"] - 0.5 for k in range(2, len(stem) + 1) if stem[:k] != r["feature"]):
            weights[r["feature"]] = float(r["weight"])
    model = Model(weights)
    model.exceptions = _exceptions(rows, model)
    model.fit = _calibrated(rows, model)
    return model


def _exceptions(rows: DataFrame, model: Model) -> list[str]:
    """Pairs of words, one with an entry, in three clean rows or more and no toxic one."""
    def pairs(folded: str, a=None) -> set[str]:
        out = set()
        for end, (n, _) in model_automaton().iter(folded):
            s = end - n + 1
            e = folded.find(" ", s + 1)
            before, after = folded.rfind(" ", 0, s), folded.find(" ", e + 1)
            if before >= 0:
                out.add(folded[before:e + 1])
            if after > e:
                out.add(folded[s:after + 1])
        return out

    cache: list = []

    def model_automaton():
        if not cache:
            cache.append(Model(weights).automaton())
        return cache[0]

    weights = model.weights
    if not weights:
        return []
    counts = rows.mapInPandas(lambda b: _counted(b, pairs), _COUNTS)
    kept = (counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .where("toxic = 0 and clean >= 3").orderBy(F.desc("clean"), "feature").limit(MAX_ENTRIES).collect())
    return [r["feature"] for r in kept]


def _calibrated(rows: DataFrame, model: Model) -> tuple[float, float, float]:
    """Logistic weights (intercept, weight, density) by Newton steps on sums over the training rows."""
    @tidy
    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = model.automaton()
        for pdf in batches:
            x = np.array([matched(a, fold(t)) for t in pdf["text"]], float).reshape(-1, 2)
            # rounded, so equal measures meet in one row
            yield pd.DataFrame({"a": x[:, 0].round(1), "b": x[:, 1].round(1), "y": pdf["y"].astype("int64")})

    m = (rows.mapInPandas(measure, "a double, b double, y long").groupBy("a", "b", "y").count().toPandas())
    x = np.column_stack([np.ones(len(m)), m["a"], m["b"]]).astype(float)
    y, c = m["y"].to_numpy(float), m["count"].to_numpy(float)
    beta = np.zeros(3)
    ridge = np.diag([1e-3, 1e-1, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (c * p * (1 - p))[:, None]) + ridge, x.T @ (c * (y - p)) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in beta)


def fold_of(id: Column) -> Column:
    """crc32 of the id as text, modulo ``FOLDS``; NULL ids are in fold 0."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % FOLDS, F.lit(0))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """id, text, y of the documents with a 0/1 label that are not held out.

    The labels are aggregated to one row per id (contradictions count as toxic).
    """
    y = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
         .where(fold_of(F.col("doc_id")) != HELD_OUT)
         .groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").cast("int").alias("y")))
    # the ids that training takes, first; then their texts only
    y = y.orderBy(F.xxhash64("id"), "id").limit(TRAIN_ROWS)
    return (docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(y), "id"))  # at most TRAIN_ROWS rows of 12 bytes


def score_documents(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, held_out, score and predicted of every row, from its whole text.

    NULL and empty texts get the score of no match. Rows that repeat are scored
    alike; other columns are left out.
    """
    @tidy
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = model.automaton()
        for pdf in batches:
            s = [model.probability(matched(a, fold(t or ""))) for t in pdf["text"]]
            yield pd.DataFrame({"id": pdf["id"].astype("Int64"), "score": s})

    scored = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")).mapInPandas(score, "id long, score double")
    return scored.select(F.col("id").alias(id), (fold_of(F.col("id")) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose score is below 0.5."""
    @F.pandas_udf("double")
    @tidy
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        a = model.automaton()
        for t in batches:
            yield pd.Series([model.probability(matched(a, fold(x or ""))) for x in t])

    return docs.where(score(F.col(f"`{text}`")) < 0.5)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return score_documents(docs, train(labelled_rows(docs, labels)))
