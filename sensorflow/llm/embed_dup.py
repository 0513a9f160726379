"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products within cells.

1. Equal vectors become one node that counts its copies.
2. Spherical k-means on a bounded sample gives the cells; every vector goes to
   the cell of its most similar centre.
3. The other vector of a link may lie in another cell, so a vector also visits
   cells. With ``d = sqrt(2 - 2 * threshold)``, the longest way between linked unit
   vectors, a cell c can hold a link of v (whose cell is h) only if a move of
   at most d takes v to the side of c: ``v.h - v.c <= d * |c - h|``. A move
   that points where vectors differ from their centres, not straight at c, is
   shorter in the direction of c; with ``miss`` > 0 the bound is the length that
   such moves exceed with that chance (from the covariance of the sample around
   its centres). ``miss`` = 0 keeps the bound that loses nothing. Of two cells
   one visits the other, so each pair meets once.
4. Cells are cut into blocks; a task multiplies two blocks and returns for every
   vector the number of its links there and one link to the least vector of
   its group there, not the pairs.
5. The links are merged to components; the least id of each is kept.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.ann import usable
from sensorflow.llm.common import components, group_min, spread_join, table

#: Vectors of the sample at most, bytes of it at most, vectors for each cell, cells at most, and rounds of k-means.
SAMPLE, SAMPLE_BYTES, CELL_ROWS, MAX_CELLS, ROUNDS = 32_768, 1 << 26, 2048, 1024, 12
#: Chance to miss a link at the threshold between two cells; 0: none.
MISS = 1e-6
#: Vectors of a block, and rows that go to a Python function at once.
BLOCK, BATCH = 4096, 2000
#: Cosines so near to the threshold are computed again, by one formula wherever the pair meets.
NEAR = 1e-9


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by their largest component first, so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def kmeans(x: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centres of spherical k-means; a centre without vectors moves to the vector worst off."""
    rng = np.random.default_rng(5)
    centres = x[rng.permutation(len(x))[:cells]]
    for _ in range(rounds):
        home, near = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        length = np.sqrt((sums * sums).sum(axis=1))
        empty = np.flatnonzero(length < 1e-9)
        sums[empty] = x[np.argsort(near, kind="stable")[:len(empty)]]
        length[empty] = 1.0
        centres = sums / length[:, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Most similar centre of each row, and the similarity."""
    home, near = np.empty(len(x), int), np.empty(len(x))
    for a in range(0, len(x), 4096):
        s = x[a:a + 4096] @ centres.T
        home[a:a + 4096] = s.argmax(axis=1)
        near[a:a + 4096] = s.max(axis=1)
    return home, near


def reach(x: np.ndarray, centres: np.ndarray, threshold: float, miss: float) -> np.ndarray:
    """[h, c]: how much more similar to h than to c a vector may be whose link lies in cell c."""
    way = math.sqrt(max(0.0, 2 - 2 * threshold))
    dot = centres @ centres.T
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * dot))
    bound = way * apart
    if miss > 0:
        rest = x - centres[nearest(x, centres)[0]]
        cov = rest.T @ rest
        total = np.trace(cov)
        if total > 0:
            cov /= total
            own = np.einsum("id,de,ie->i", centres, cov, centres)
            spread = own[:, None] + own[None, :] - 2 * (centres @ cov @ centres.T)
            bound = np.minimum(bound, NormalDist().inv_cdf(1 - miss) * way * np.sqrt(np.maximum(spread, 0.0)))
    return bound + 1e-9


def fit(x: np.ndarray, rows: int, threshold: float, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres and their reach for ``rows`` vectors, of which ``x`` (unit) are a sample."""
    cells = int(max(1, min(MAX_CELLS, rows // CELL_ROWS, len(x) // 16)))
    centres = kmeans(x, cells)
    return centres, reach(x, centres, threshold, miss)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        # + 0.0: the two zeros are one value
        yield pdf.assign(key=[hashlib.blake2b((np.asarray(v, np.float64) + 0.0).tobytes(), digest_size=16).digest() for v in pdf["v"]])


def _placed(centres: np.ndarray, bound: np.ndarray):
    """cell of each vector, and the cells that it visits."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        k = np.arange(len(centres))
        for pdf in batches:
            homes, visits = np.full(len(pdf), -1), [None] * len(pdf)
            fits = np.flatnonzero(pdf["v"].map(len).to_numpy() == centres.shape[1])
            if len(fits):
                s = unit(_matrix(pdf["v"].iloc[fits])) @ centres.T
                home = s.argmax(axis=1)
                homes[fits] = home
                # of two cells, which one visits depends on the parity of their sum: half of the pairs each
                turn = np.where((k[None, :] + home[:, None]) % 2 == 0, k[None, :] < home[:, None], k[None, :] > home[:, None])
                near = s[np.arange(len(s)), home][:, None] - s <= bound[home]
                for i, row in zip(fits, turn & near):
                    visits[i] = np.flatnonzero(row).astype("int32")
            yield pdf.assign(cell=homes.astype("int32"), visits=visits)
    return run


def _groups(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group number of each row and column of a boolean matrix (-1: no link); rows and columns are searched once each."""
    rows, cols = np.full(mask.shape[0], -1), np.full(mask.shape[1], -1)
    open_rows, n = mask.any(axis=1), 0
    for i in np.flatnonzero(open_rows):
        if rows[i] >= 0:
            continue
        front = np.array([i])
        rows[front] = n
        while len(front):
            new = np.flatnonzero(mask[front].any(axis=0) & (cols < 0))
            cols[new] = n
            front = np.flatnonzero(mask[:, new].any(axis=1) & (rows < 0)) if len(new) else new
            rows[front] = n
        n += 1
    return rows, cols


FOUND = "node long, n long, hub long"


def linked(a: pd.DataFrame, b: pd.DataFrame, same: bool, threshold: float) -> pd.DataFrame:
    """FOUND rows of the vectors of two blocks (node, copies, v); ``same``: the blocks are one."""
    x, y = unit(_matrix(a["v"])), unit(_matrix(b["v"]))
    hit = np.zeros((len(x), len(y)), bool)
    for i in range(0, len(x), 512):
        s = x[i:i + 512] @ y.T
        part = s >= threshold
        for p, q in zip(*np.nonzero(np.abs(s - threshold) < NEAR)):
            part[p, q] = (x[i + p] * y[q]).sum() >= threshold
        hit[i:i + 512] = part
    if same:
        np.fill_diagonal(hit, False)
    some, any_ = np.flatnonzero(hit.any(axis=1)), np.flatnonzero(hit.any(axis=0))
    hit = hit[np.ix_(some, any_)]
    left, right = a["node"].to_numpy()[some], b["node"].to_numpy()[any_]
    rows, cols = _groups(hit)
    node, group = np.concatenate((left, right)), np.concatenate((rows, cols))
    hub = np.full(int(group.max()) + 1 if len(group) else 0, np.iinfo(np.int64).max)
    np.minimum.at(hub, group, node)
    # a matrix of a block with itself has every link twice
    n = np.concatenate((hit @ b["copies"].to_numpy()[any_], np.zeros(len(right), int) if same else a["copies"].to_numpy()[some] @ hit))
    out = pd.DataFrame({"node": node, "n": n.astype("int64"), "hub": hub[group]})
    return out[out["n"] > 0] if same else out


def links(vectors: DataFrame, threshold: float, miss: float = MISS) -> DataFrame:
    """FOUND rows of the table ``vectors`` (node, copies, v): a node may have a row in several pairs of blocks."""
    sizes = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], FOUND)
    d = sizes[0]["d"]
    fits = vectors.where(F.size("v") == d)
    sample = fits.select("v").orderBy(F.xxhash64("v"), "node").limit(max(64, min(SAMPLE, SAMPLE_BYTES // (8 * d)))).toPandas()
    centres, bound = fit(unit(_matrix(sample["v"])), sizes[0]["count"], threshold, miss)
    # vectors of other dimensions are cells of their own, numbered below 0
    placed = table(vectors.mapInPandas(_placed(centres, bound), "node long, copies long, v array<double>, cell int, visits array<int>")
                   .withColumn("cell", F.when(F.col("cell") < 0, -F.size("v") - 1).otherwise(F.col("cell"))), "cells", BATCH)
    visitors = placed.select("node", "copies", "v", F.explode("visits").alias("cell"))
    held = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("mine"))
    come = visitors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("theirs"))
    cells = table(held.join(come, "cell", "left").select("cell", "mine", F.coalesce("theirs", F.lit(0)).alias("theirs")), "cell-blocks")

    def dealt(df: DataFrame, count: str, first: str | None = None) -> DataFrame:
        """``df`` with the block of each row in its cell; cells are few rows, so any cell can be of any size."""
        start = F.col(first) if first else F.lit(0)
        return spread_join(df, cells, "cell", "node").withColumn("block", (start + F.pmod(F.xxhash64("node", F.lit(7)), F.col(count))).cast("int"))

    own = dealt(placed.select("node", "copies", "v", "cell"), "mine")
    far = dealt(visitors, "theirs", "mine")
    left = own.select("node", "copies", "v", "cell", F.col("block").alias("i"), F.explode(F.expr("sequence(block, mine + theirs - 1)")).alias("j"))
    right = (own.select("node", "copies", "v", "cell", F.explode(F.expr("sequence(0, block)")).alias("i"), F.col("block").alias("j")).where("i < j")
             .unionByName(far.select("node", "copies", "v", "cell", F.explode(F.expr("sequence(0, mine - 1)")).alias("i"), F.col("block").alias("j"))))
    right = right.toDF(*right.columns)  # columns of its own: both sides come from one table

    def compare(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        same = key[1] == key[2]
        if not len(a) or not (same or len(b)):
            return pd.DataFrame({"node": np.zeros(0, "int64"), "n": np.zeros(0, "int64"), "hub": np.zeros(0, "int64")})
        return linked(a, a if same else b, same, threshold)

    pair = ["cell", "i", "j"]
    return left.groupBy(*pair).cogroup(right.groupBy(*pair)).applyInPandas(compare, FOUND)


def near_duplicates(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", threshold: float = 0.9,
                    miss: float = MISS) -> DataFrame:
    """``id``, n_links, component_id and kept of every row.

    Two rows are linked if the cosine of their vectors (double precision) is
    ``threshold`` or more; n_links counts the other rows linked, component_id is
    the least id reachable. Rows that are NULL, zero, or hold NULL or non-finite
    components, and rows without an id, link with nothing and are kept; vectors
    of different dimensions do not link. Every row is a vector of its own, also
    where ids or vectors repeat. An empty table gives no rows; other columns
    are left out.
    """
    read = vectors.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    good = F.col("id").isNotNull() & usable(F.col("v"))
    rows = table(read.where(good).mapInPandas(_keyed, "id long, v array<double>, key binary"), "vectors", BATCH)
    # copies of a vector: one node, numbered in the written table
    nodes = table(rows.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v"))
                  .withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = table(links(nodes.select("node", "copies", "v"), threshold, miss), "found")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    comps = components(found.select(F.col("node").alias("u"), F.col("hub").alias("v")))
    least = group_min(nodes.select("node", "least").join(comps, "node"), "comp", "least", "root").select("node", "root")
    told = (nodes.select("key", "node", "least", "copies").join(counts, "node", "left").join(least, "node", "left")
            .select("key", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("root", "least").alias("component_id")))
    linked_rows = spread_join(rows.select("id", "key"), told, "key", "id").select("id", "n_links", "component_id")
    rest = read.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked_rows.unionByName(rest)
    return out.select(F.col("id").alias(id), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op13_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


OP13_SQL = """
with recursive
good as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit as (select vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) as v from good),
link as (
  select a.vec_id as u, b.vec_id as v from unit a join unit b on a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_inner_product(a.v, b.v) >= 0.9),
reach as (
  select vec_id as u, vec_id as v from embeddings
  union
  select r.u, l.v from reach r join link l on l.u = r.v),
comp as (select u, min(v) as c from reach group by u),
n as (select u, count(*) as n from link group by u)
select e.vec_id, coalesce(n.n, 0) as n_links, comp.c as component_id, e.vec_id = comp.c as kept
from embeddings e join comp on comp.u = e.vec_id left join n on n.u = e.vec_id
"""
