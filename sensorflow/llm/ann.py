"""Nearest neighbours by inner product: learned partitions of a neighbour graph.

On a bounded sample: the neighbour graph, its balanced partition (recursive
spectral bisection, refined by swaps), and a softmax classifier that learns in
which parts the neighbours of a vector lie. The classifier then assigns every
vector to its most probable part, and routes a query to as many parts as gave
the wanted recall on held-out vectors of the sample. Queries are compared with
all vectors of their parts, in double precision.

Parts are cut into blocks, so a part of any size, or a vector that a third of
the rows repeat, is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import table

#: Vectors on which the partition is fitted, at most; vectors for each part; parts at least and at most.
SAMPLE, PART_ROWS, MIN_PARTS, MAX_PARTS = 8192, 512, 8, 256
#: Neighbours in the graph, held-out vectors that calibrate the number of parts, and their wanted recall.
DEGREE, HELD_OUT, RECALL = 16, 512, 0.95
#: Vectors and queries that meet in one task.
VECTOR_BLOCK, QUERY_BLOCK = 8192, 2048
#: Shares in which the hits of a query are merged before they meet.
MERGE = 32


def usable(v: Column) -> Column:
    """Not NULL, not all zero, every component finite."""
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def neighbours(x: np.ndarray, q: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Indices of the k rows of x of largest inner product with each row of q, but for its own row."""
    out = np.empty((len(q), k), int)
    for a in range(0, len(q), 1024):
        s = q[a:a + 1024] @ x.T
        if own is not None:
            s[np.arange(len(s)), own[a:a + 1024]] = -np.inf
        out[a:a + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def bisect(nodes: np.ndarray, near: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Whether each of ``nodes`` goes to the second of two halves of a size, with few edges cut."""
    place = np.full(len(near), -1)
    place[nodes] = np.arange(len(nodes))
    to = place[near[nodes]]
    inside = to >= 0
    src = np.repeat(np.arange(len(nodes)), inside.sum(axis=1))
    dst = to[inside]
    degree = np.bincount(src, minlength=len(nodes)) + np.bincount(dst, minlength=len(nodes)) + 1e-9

    def pull(f: np.ndarray) -> np.ndarray:
        return np.bincount(src, f[dst], len(nodes)) + np.bincount(dst, f[src], len(nodes))

    f = rng.standard_normal(len(nodes))
    for _ in range(60):  # power steps towards the slowest mode of the lazy walk
        f = f + pull(f) / degree
        f -= (f * degree).sum() / degree.sum()
        f /= np.abs(f).max() + 1e-12
    half = len(nodes) // 2
    right = np.zeros(len(nodes), bool)
    right[np.argsort(f, kind="stable")[half:]] = True
    for _ in range(10):  # swap the pairs that gain most
        gain = np.where(right, -1, 1) * pull(np.where(right, 1.0, -1.0))
        a = np.flatnonzero(~right)[np.argsort(-gain[~right], kind="stable")]
        b = np.flatnonzero(right)[np.argsort(-gain[right], kind="stable")]
        n = min(len(a), len(b))
        good = int(np.argmax(np.append(gain[a[:n]] + gain[b[:n]] <= 2, True)))
        if not good:
            break
        good = max(1, good // 2)
        right[a[:good]], right[b[:good]] = True, False
    return right


def partition(near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    label = np.zeros(len(near), int)
    level = 1
    while level < parts:
        for p in range(level):
            nodes = np.flatnonzero(label == p)
            if len(nodes) > 1:
                label[nodes[bisect(nodes, near, rng)]] += level
        level *= 2
    return label


@dataclass
class Router:
    """Softmax classifier over scaled vectors, and the number of parts that a query visits."""

    weights: np.ndarray
    bias: np.ndarray
    scale: float
    probes: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x * self.scale) @ self.weights + self.bias

    def best(self, x: np.ndarray, n: int) -> np.ndarray:
        z = self.logits(x)
        if n >= z.shape[1]:
            return np.tile(np.arange(z.shape[1]), (len(x), 1))
        return np.argpartition(-z, n - 1, axis=1)[:, :n]


def classify(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression to the rows of ``target`` (shares of parts) by Adam steps."""
    n, d, p = len(x), x.shape[1], target.shape[1]
    theta = np.zeros((d + 1, p))
    m, v, t = np.zeros_like(theta), np.zeros_like(theta), 0
    x1 = np.column_stack([x, np.ones(n)])
    for _ in range(rounds):
        for rows in np.array_split(rng.permutation(n), max(1, n // 512)):
            z = x1[rows] @ theta
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            g = x1[rows].T @ (z - target[rows]) / len(rows) + 1e-4 * theta
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta[:-1], theta[-1]


def fit(x: np.ndarray, rows: int, k: int) -> Router:
    """Router for a table of ``rows`` vectors, fitted on the sample ``x``."""
    rng = np.random.default_rng(11)
    scale = 1 / max(1e-12, float(np.sqrt((x * x).sum(axis=1).mean())) / np.sqrt(x.shape[1]))
    parts = MIN_PARTS
    while parts < min(MAX_PARTS, rows / PART_ROWS, len(x) / 32):
        parts *= 2
    if len(x) < 4 * MIN_PARTS:  # too few to learn from: one part
        return Router(np.zeros((x.shape[1], 1)), np.zeros(1), scale, 1)
    degree = min(DEGREE, len(x) - 1)
    near = neighbours(x, x, degree, np.arange(len(x)))
    label = partition(near, parts, rng)
    target = np.zeros((len(x), parts))
    for j in range(degree):
        target[np.arange(len(x)), label[near[:, j]]] += 0.5 / degree
    target[np.arange(len(x)), label] += 0.5
    held = rng.permutation(len(x))[:min(HELD_OUT, len(x) // 4)]
    rest = np.setdiff1d(np.arange(len(x)), held)
    router = Router(*classify(x[rest] * scale, target[rest], rng), scale, parts)
    true = rest[neighbours(x[rest], x[held], min(k, len(rest)))]
    home = router.best(x, 1)[:, 0]
    order = np.argsort(-router.logits(x[held]), axis=1, kind="stable")
    visited = np.empty_like(order)
    np.put_along_axis(visited, order, np.arange(parts)[None, :], axis=1)
    need = np.take_along_axis(visited, home[true], axis=1)
    router.probes = next((m for m in range(1, parts) if (need < m).mean() >= RECALL), parts)
    return router


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal vectors get equal bits wherever they lie."""
    return (q[None, :] * v).sum(axis=1)


def nearest(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int) -> pd.DataFrame:
    """query_id, ids, scores: the k rows of v nearest to every row of q, but for rows of its own id; ties to the smaller id."""
    v = np.ascontiguousarray(v)
    _, group = np.unique(v.view(np.dtype((np.void, v.dtype.itemsize * v.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((vid, group))
    vid, v, group = vid[order], v[order], group[order]
    new = np.concatenate(([True], (group[1:] != group[:-1]) | (vid[1:] != vid[:-1])))
    vid, v, group = vid[new], v[new], group[new]
    # of equal vectors only the k + 1 smallest ids can count
    keep = np.arange(len(group)) - np.searchsorted(group, group) <= k
    vid, v, group = vid[keep], v[keep], group[keep]
    at = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    members = np.split(np.arange(len(group)), at[1:])
    table_ = v[at]
    rows = []
    # the k + 1 best vectors (one may be the query's own), and all that the rounding of the product cannot tell from the last of them
    wide = min(len(table_), k + 1)
    longest = np.sqrt((table_ * table_).sum(axis=1).max())
    for a in range(0, len(q), 256):
        s = q[a:a + 256] @ table_.T
        last = np.partition(s, len(table_) - wide, axis=1)[:, len(table_) - wide]
        slack = 4 * table_.shape[1] * np.finfo(float).eps * longest * np.sqrt((q[a:a + 256] ** 2).sum(axis=1))
        for i in range(len(s)):
            c = np.flatnonzero(s[i] >= last[i] - slack[i])
            exact = _exact(q[a + i], table_[c])
            ids = np.concatenate([vid[members[j]] for j in c])
            score = np.repeat(exact, [len(members[j]) for j in c])
            mine = ids != qid[a + i]
            ids, score = ids[mine], score[mine]
            top = np.lexsort((ids, -score))[:k]
            rows.append((qid[a + i], ids[top], score[top]))
    return pd.DataFrame(rows, columns=["query_id", "ids", "scores"])


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def search(vectors: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found to every query row, nearest first.

    Vectors that are NULL, zero, or hold NULL or non-finite components take no
    part, nor do rows without an id or of another dimension than most. Rows
    that repeat an id and its vector count once; with another vector they are
    candidates of their own. No row is a neighbour of its own id. A table of
    fewer rows gives fewer neighbours; an empty one gives no rows. Other
    columns are left out.
    """
    read = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").alias("v"), is_query.alias("q"))
    good = read.where(F.col("id").isNotNull() & usable(F.col("v")))
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], schema)
    good = good.where(F.size("v") == sizes[0]["d"])
    sample = good.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).toPandas()
    router = fit(_matrix(sample["v"]), sizes[0]["count"], k)

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = _matrix(pdf["v"])
                home = router.best(x, 1)[:, 0]
                visit = list(router.best(x, router.probes).astype("int32"))
                yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "home": home.astype("int32"),
                                    "visit": [list(c) if f else None for c, f in zip(visit, pdf["q"].fillna(False))]})

    routed = table(good.mapInPandas(route, "id long, v array<double>, home int, visit array<int>"), "ann-routed")
    stored = {r["home"]: r["count"] for r in routed.groupBy("home").count().collect()}
    asked = {r["part"]: r["count"] for r in routed.select(F.explode("visit").alias("part")).groupBy("part").count().collect()}
    parts = [p for p in stored if p in asked]
    if not parts:
        return vectors.sparkSession.createDataFrame([], schema)

    def blocks(counts: dict[int, int], size: int) -> Column:
        return F.create_map(*[F.lit(x) for p in parts for x in (p, max(1, -(-counts[p] // size)))])

    nv, nq = blocks(stored, VECTOR_BLOCK), blocks(asked, QUERY_BLOCK)
    v = (routed.where(F.col("home").isin(parts)).select(F.col("home").alias("part"), "id", "v")
         .withColumn("vb", F.pmod(F.xxhash64("id"), nv[F.col("part")]).cast("int"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0), nq[F.col("part")] - 1))))
    q = (routed.where(F.col("visit").isNotNull()).select(F.col("id").alias("qid"), F.col("v").alias("qv"), F.explode("visit").alias("part")).where(F.col("part").isin(parts))
         .withColumn("qb", F.pmod(F.xxhash64("qid", F.lit(1)), nq[F.col("part")]).cast("int"))
         .withColumn("vb", F.explode(F.sequence(F.lit(0), nv[F.col("part")] - 1))))

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"query_id": np.zeros(0, "int64"), "ids": [], "scores": []})
        return nearest(b["qid"].to_numpy(), _matrix(b["qv"]), a["id"].to_numpy(), _matrix(a["v"]), k)

    key = ["part", "vb", "qb"]
    found = v.groupBy(*key).cogroup(q.groupBy(*key)).applyInPandas(compare, "query_id long, ids array<long>, scores array<double>")
    hits = found.select("query_id", F.arrays_zip(F.transform("scores", lambda s: -s).alias("far"), F.col("ids").alias("id")).alias("hits"),
                        F.pmod(F.xxhash64("ids"), F.lit(MERGE)).alias("share"))
    # k hits of every block become k hits of every share, then k hits
    for keys in (["query_id", "share"], ["query_id"]):
        merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))), 1, k)
        hits = hits.groupBy(*keys).agg(merged.alias("hits"))
    ranked = hits.select("query_id", F.posexplode("hits").alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), (-F.col("hit.far")).alias("score"))


def op9_ann(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return search(vectors, F.col("vec_id") % 20 == 0)
