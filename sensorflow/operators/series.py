"""Per-series sequential operators.

A "series" is the set of rows sharing the ``by`` key columns, ordered by
``order`` (event time first, then tie-breakers).

Scale notes
-----------
* ``lag`` over one series puts the whole series into one task. A single
  sensor may hold a third of all rows, so :func:`lag_stitched` deals long series
  by range of (series, order) and repairs the first row of every range with
  the last row of the range before (one boundary row per range and series,
  joined back on the same keys the window already shuffled on).
* Latest-per-key uses ``max_by`` aggregates (partial aggregation before the
  shuffle, so a hot key ships one row per map task), not a full window.
* Top-k per key relies on Spark's window group limit (``row_number() <= k``
  is cut per map task before the shuffle); top-k of one series is a
  distributed ``TakeOrderedAndProject``.
* Global minima / maxima are scalar subqueries, evaluated once and inlined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timestamps import as_instant
from ..session import cut_lineage

_K = "__sf_key"
_B = "__sf_bucket"
_FIRST = "__sf_first_in_bucket"
_LAST = "__sf_last"
_PREV = "__sf_prev"

# Bucket widths accepted by ``bucket=``; pick one that keeps the rows of the
# busiest (series, bucket) well inside one task.
_BUCKET_US = {
    "1 minute": 60_000_000,
    "10 minutes": 600_000_000,
    "1 hour": 3_600_000_000,
    "6 hours": 21_600_000_000,
    "1 day": 86_400_000_000,
}


def _names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _bucket_of(ts: str, width_us: int) -> Column:
    # floor, so instants before 1970 still land in the right bucket
    return F.floor(F.unix_micros(as_instant(ts)) / F.lit(width_us)).cast("bigint")


#: Rows of the longest series up to which a plain window per series is used.
SPLIT_ROWS = 200_000


def longest_series(keyed: DataFrame) -> int:
    """Rows of the longest series (``_K``): an aggregate over the key columns alone, one row per series and map task."""
    return keyed.groupBy(_K).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0


def with_ranges(keyed: DataFrame, order: Sequence[str]) -> DataFrame:
    """``keyed`` dealt by range of (series, order), with the number of each row's range in ``_B``.

    Ranges hold about the same number of rows whatever the series and the pace
    of their times, and ascend with (series, order); rows that agree in both stay
    together. The rows are written once with their range, so both uses of the
    ranges agree, also when tasks are recomputed.
    """
    return cut_lineage(keyed.repartitionByRange(_K, *order).withColumn(_B, F.spark_partition_id().cast("bigint")), "lag-ranges")


def lag_stitched(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: str | Sequence[str],
    cols: str | Sequence[str],
    bucket: str | None = "auto",
    prefix: str = "prev_",
    has_prev: str = "has_prev",
) -> DataFrame:
    """Add ``prev_<c>`` (value of ``c`` in the previous row of the series) and
    ``has_prev`` (the row has a predecessor) for every ``c`` in ``cols``.

    Equal to ``lag(c) over (partition by by order by order)``.
    ``bucket='auto'`` (default) counts the rows of every series first; while none
    has more than ``SPLIT_ROWS`` it is that plain window, else the window is
    over (series, range) and stitched (:func:`with_ranges`, which needs
    ``spark.checkpoint.dir``): the input is read twice, and no task holds
    more than a range. A fixed width such as ``'1 hour'`` cuts by the clock
    (the first ``order`` column must be a timestamp); ``bucket=None`` is the plain
    window, for inputs already small per series.
    """
    by, order, cols = _names(by), _names(order), _names(cols)
    key = F.struct(*by) if by else F.lit(0)  # one struct: NULL-safe equality in a plain equi-join
    if bucket == "auto" and longest_series(df.select(key.alias(_K))) <= SPLIT_ROWS:
        bucket = None
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(*order)
        out = df
        for c in cols:
            out = out.withColumn(prefix + c, F.lag(c).over(w))
        return out.withColumn(has_prev, F.lag(F.lit(True)).over(w).isNotNull())

    # the join below keeps the (key, bucket) hash partitioning of the window
    keyed = df.withColumn(_K, key)
    keyed = (with_ranges(keyed, order) if bucket == "auto"
             else keyed.withColumn(_B, F.coalesce(_bucket_of(order[0], _BUCKET_US[bucket]), F.lit(-(2 ** 62)))))
    w = Window.partitionBy(_K, _B).orderBy(*order)
    inner = keyed.withColumn(_FIRST, F.lag(F.lit(True)).over(w).isNull())
    for c in cols:
        inner = inner.withColumn(prefix + c, F.lag(c).over(w))

    # Last row of every non-empty (series, bucket): an aggregate combined per
    # map task before its (small) shuffle, then the one of the bucket before.
    # This side has one row per (series, bucket); AQE measures it at runtime
    # and broadcasts it only below the broadcast threshold, else sort-merges.
    last = keyed.groupBy(_K, _B).agg(last_of(keyed, cols, order).alias(_LAST))
    prev = (last.withColumn(_PREV, F.lag(_LAST).over(Window.partitionBy(_K).orderBy(_B)))
            .where(F.col(_PREV).isNotNull())
            .select(_K, _B, _PREV))

    joined = inner.join(prev, on=[_K, _B], how="left")
    for c in cols:
        joined = joined.withColumn(
            prefix + c,
            F.when(F.col(_FIRST), F.col(f"{_PREV}.{c}")).otherwise(F.col(prefix + c)))
    joined = joined.withColumn(
        has_prev, ~F.col(_FIRST) | F.col(_PREV).isNotNull())
    return joined.drop(_K, _B, _FIRST, _PREV)


_FIXED = ("double", "float", "bigint", "int", "smallint", "tinyint", "boolean",
          "timestamp", "timestamp_ntz", "date")
_INTEGRAL = ("bigint", "int", "smallint", "tinyint")
_TIMES = ("timestamp", "timestamp_ntz")


def order_key(df: DataFrame, order: Sequence[str]) -> Column | None:
    """One DECIMAL(38,0) that sorts like ``order`` (NULLS FIRST), when ``order``
    is a time or integer column optionally followed by an integer tie-breaker.

    A fixed-width ordering keeps ``max_by`` / ``min_by`` in a hash aggregate;
    a struct ordering forces a sort-based aggregate (every map task sorts its
    rows). Returns None when the columns cannot be packed.
    """
    types = dict(df.dtypes)
    if not 1 <= len(order) <= 2:
        return None
    first, rest = order[0], order[1:]
    def dec(v) -> Column:
        return F.lit(str(v)).cast("decimal(38,0)")

    if types.get(first) in _TIMES:
        # valid instants lie within +-2.6e17 us (years 1..9999); NULL sorts
        # below them, and head * 1e20 + tie stays inside DECIMAL(38,0)
        head = F.coalesce(F.unix_micros(as_instant(first)).cast("decimal(38,0)"), dec(-(10 ** 17)))
    elif types.get(first) in _INTEGRAL and not rest:
        # NULL just below the smallest BIGINT, so it never ties with a value
        head = F.coalesce(F.col(first).cast("decimal(38,0)"), dec(-(2 ** 63) - 1))
    else:
        return None
    if rest and types.get(rest[0]) not in _INTEGRAL:
        return None
    key = head
    if rest:
        # tie-breaker mapped to 1 .. 2^64 (NULL -> 0), below the 1e20 multiplier
        tie = F.coalesce(F.col(rest[0]).cast("decimal(38,0)") + dec(2 ** 63 + 1), dec(0))
        key = (key * dec(10 ** 20) + tie).cast("decimal(38,0)")
    return key


def last_of(df: DataFrame, cols: Sequence[str], order: Sequence[str]) -> Column:
    """Aggregate: struct of ``cols`` taken from the row that is last by ``order``."""
    types = dict(df.dtypes)
    key = order_key(df, order)
    if key is not None and all(types[c] in _FIXED for c in cols):
        return F.struct(*[F.max_by(c, key).alias(c) for c in cols])
    return F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order]))


def segments(df: DataFrame, by, order, lat: str = "lat", lon: str = "lon",
             bucket: str | None = "auto") -> DataFrame:
    """Consecutive points of a series as segments (prev_lat, prev_lon) -> (lat, lon).

    The first point of every series starts no segment and is dropped.
    """
    out = lag_stitched(df, by, order, [lat, lon], bucket=bucket)
    return out.where(F.col("has_prev")).drop("has_prev")


def on_change(df: DataFrame, by, order, col: str, bucket: str | None = "auto") -> DataFrame:
    """Keep a reading only when it differs from the previous one of its series.

    NULL equals NULL here; the first reading of a series is kept unless it is NULL.
    """
    out = lag_stitched(df, by, order, [col], bucket=bucket, prefix="__sf_lag_")
    prev = F.col("__sf_lag_" + col)
    return out.where(~F.col(col).eqNullSafe(prev)).drop("__sf_lag_" + col, "has_prev")


def sample_gap(df: DataFrame, by, order, ts: str = "ts", factor: float | None = None,
               clip_s: tuple[float, float] | None = (0.0, 5.0),
               bucket: str | None = "auto") -> DataFrame:
    """Gap to the previous sample of the series.

    Adds ``gap_us`` (integer µs, NULL for the first sample) and, with
    ``factor``, ``gap_s`` = gap / factor in seconds and ``pause_s`` = gap_s when
    it lies strictly inside ``clip_s`` else 0 (the replay pause).
    """
    us = "__sf_us"
    out = lag_stitched(df.withColumn(us, F.unix_micros(as_instant(ts))), by, order, [us],
                       bucket=bucket, prefix="__sf_lag_")
    out = out.withColumn("gap_us", F.col(us) - F.col("__sf_lag_" + us))
    if factor is not None:
        gap_s = F.col("gap_us") / F.lit(1e6) / F.lit(float(factor))
        out = out.withColumn("gap_s", gap_s)
        if clip_s is not None:
            lo, hi = clip_s
            out = out.withColumn(
                "pause_s",
                F.when((F.col("gap_s") > F.lit(lo)) & (F.col("gap_s") < F.lit(hi)), F.col("gap_s"))
                .otherwise(F.lit(0.0)))
    return out.drop(us, "__sf_lag_" + us, "has_prev")


def last_k(df: DataFrame, by, order_desc: Sequence[Column], k: int,
           resort: Sequence[Column] | None = None) -> DataFrame:
    """The newest ``k`` rows of each series (or of the whole frame if ``by`` is empty).

    ``order_desc`` are the sort columns newest-first, e.g. ``[F.col('ts').desc()]``;
    ``resort`` (e.g. ``[F.col('ts')]``) puts the ``k`` rows back in ascending order
    for display -- a sort of ``k`` rows only.
    """
    by = _names(by)
    if not by:
        top = df.orderBy(*order_desc).limit(k)
        return top.orderBy(*resort) if resort else top
    rn = "__sf_rn"
    w = Window.partitionBy(*by).orderBy(*order_desc)
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= k).drop(rn)


def latest_by_key(df: DataFrame, key, order) -> DataFrame:
    """W4 / K3 read side: newest row per key, by ``order`` (version, time, tie-breakers).

    A ``max_by`` aggregate: combined per map task before the shuffle.
    """
    key, order = _names(key), _names(order)
    rest = [c for c in df.columns if c not in key]
    v = "__sf_row"
    # fixed-width columns and a packable order: hash aggregate (last_of);
    # rows carrying strings: max_by over structs, a sort-based aggregate
    return (df.groupBy(*key)
            .agg(last_of(df, rest, order).alias(v))
            .select(*key, *[F.col(f"{v}.{c}").alias(c) for c in rest]))


def max_of(df: DataFrame, c: str | Column) -> Column:
    """Scalar subquery: the maximum of ``c`` over ``df`` (evaluated once)."""
    return df.select(F.max(c)).scalar()


def min_of(df: DataFrame, c: str | Column) -> Column:
    """Scalar subquery: the minimum of ``c`` over ``df`` (evaluated once)."""
    return df.select(F.min(c)).scalar()


def trailing(df: DataFrame, ts: str, interval: str, by=None) -> DataFrame:
    """Rows with ``ts >= max(ts) - interval``, globally or per series (a NULL key is a series)."""
    by = _names(by)
    span = F.expr(f"INTERVAL {interval}")
    if not by:
        return df.where(F.col(ts) >= max_of(df, ts) - span)
    m = "__sf_max"
    # one struct key: NULL-safe equality in a plain equi-join
    tops = df.groupBy(F.struct(*by).alias(_K)).agg(F.max(ts).alias(m))
    return (df.withColumn(_K, F.struct(*by)).join(tops, on=_K, how="inner")
            .where(F.col(ts) >= F.col(m) - span).drop(_K, m))


def unseen(new: DataFrame, seen: DataFrame, key) -> DataFrame:
    """Rows of ``new`` whose key was never seen (left anti join).

    A window keeps the first value it was shown with; later updates of a seen
    key are not re-emitted.
    """
    key = _names(key)
    # one struct key, so a NULL key that was seen is seen
    shown = seen.select(F.struct(*key).alias(_K)).distinct()
    return new.withColumn(_K, F.struct(*key)).join(shown, on=_K, how="left_anti").drop(_K)


def time_bounds(df: DataFrame, ts: str, by=None) -> DataFrame:
    """First and last instant and row count (per series if ``by``)."""
    aggs = [F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("n")]
    by = _names(by)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def first_last(df: DataFrame, by, order, col: str) -> DataFrame:
    """First and last value of ``col`` per series, by ``order``."""
    by, order = _names(by), _names(order)
    o = order_key(df, order) if dict(df.dtypes)[col] in _FIXED else None
    if o is None:  # sort-based aggregate; still combined per map task
        o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*by).agg(F.min_by(col, o).alias("first_" + col),
                               F.max_by(col, o).alias("last_" + col),
                               F.count(F.lit(1)).alias("n"))


def delta(df: DataFrame, by, order, col: str, out: str | None = None,
          bucket: str | None = "auto") -> DataFrame:
    """M1: difference of ``col`` to the previous row of the series (NULL for the first)."""
    out = out or f"d_{col}"
    lagged = lag_stitched(df, by, order, [col], bucket=bucket, prefix="__sf_lag_")
    return (lagged.withColumn(out, F.col(col) - F.col("__sf_lag_" + col))
            .drop("__sf_lag_" + col, "has_prev"))


def elapsed(df: DataFrame, ts: str, out: str = "elapsed_s") -> DataFrame:
    """Seconds since the first instant of the frame."""
    us = F.unix_micros(as_instant(ts))
    t0 = min_of(df, F.unix_micros(as_instant(ts)))
    return df.withColumn(out, (us - t0) / F.lit(1e6))


def after_warmup(df: DataFrame, ts: str, seconds: int = 1) -> DataFrame:
    """F5 on instants: rows at least ``seconds`` after the first one. The stored
    column is compared with one scalar, so the filter reaches the scan."""
    return df.where(F.col(ts) >= min_of(df, ts) + F.make_dt_interval(secs=F.lit(seconds)))


def rebase_start(df: DataFrame, ts: str, start_ms: int, out: str = "ts_rebased",
                 precision: str = "ms") -> DataFrame:
    """P5 on a table: shift the series so its first sample lands on ``start_ms``,
    then truncate to ``precision`` (the producers send whole milliseconds)."""
    from ..functions.timestamps import rebase_us
    us = F.unix_micros(as_instant(ts))
    off = "__sf_offset_us"
    # the offset is a column of its own, so the scalar subquery is planned once
    shifted = df.withColumn(off, us - min_of(df, F.unix_micros(as_instant(ts))))
    return shifted.withColumn(out, rebase_us(off, start_ms * 1000, precision)).drop(off)


def rebase_to_end(df: DataFrame, ts: str, target_ms: int, out: str = "ts_rebased") -> DataFrame:
    """Shift the series so its last sample lands on ``target_ms`` (exact µs)."""
    us = F.unix_micros(as_instant(ts))
    last = max_of(df, F.unix_micros(as_instant(ts)))
    return df.withColumn(out, F.timestamp_micros(us + (F.lit(target_ms * 1000) - last)))
