"""Table scans.

All predicates are written as ``column <op> literal`` on stored columns, with
literals cast to the column's own type, so Parquet receives them as
``PushedFilters`` (row-group statistics) and Hive-style partition columns as
``PartitionFilters`` (whole directories skipped).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import semicircles_to_deg
from ..functions.timestamps import as_instant


def _lit_as(df: DataFrame, col: str, value) -> Column:
    if isinstance(value, Column):
        return value
    dtype = dict(df.dtypes)[col]
    if isinstance(value, (dt.datetime, dt.date)) and getattr(value, "tzinfo", None) is None:
        # Text literal: read as UTC wall time, independent of the Python process zone.
        return F.lit(value.isoformat(sep=" ") if isinstance(value, dt.datetime)
                     else value.isoformat()).cast(dtype)
    return F.lit(value).cast(dtype)


def time_range(df: DataFrame, ts: str, start, stop,
               equals: Mapping[str, object] | None = None) -> DataFrame:
    """``start <= ts < stop`` and column equalities, pushable."""
    cond = (F.col(ts) >= _lit_as(df, ts, start)) & (F.col(ts) < _lit_as(df, ts, stop))
    for c, v in (equals or {}).items():
        cond = cond & (F.col(c) == _lit_as(df, c, v))
    return df.where(cond)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a parquet folder by path."""
    if "/" in name_or_path or ":" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_points(spark: SparkSession, path: str, start, stop, measurement: str,
                field: str | None = None) -> DataFrame:
    """``(time, value)`` of one measurement (and field) in ``[start, stop)``.

    The points table is partitioned by measurement and day, so the measurement
    and the days of the range prune folders, and the time range prunes row
    groups: a range of a long series opens the files of its days only. Of the
    writes of a (field, time) the newest counts.
    """
    from ..operators.series import latest_by_key
    pts = spark.read.parquet(path)
    eq = {"measurement": measurement}
    if field is not None:
        eq["field"] = field
    hits = time_range(pts, "time", start, stop, eq)
    if "day_bucket" in pts.columns:  # tables of an older layout have no days
        hits = hits.where(F.col("day_bucket").between(F.to_date(_lit_as(pts, "time", start)), F.to_date(_lit_as(pts, "time", stop))))
    hits = hits.select("field", "time", "value", "write_id")
    return latest_by_key(hits, ["field", "time"], ["write_id"]).select("time", "value")


def read_partition(spark: SparkSession, path: str, sensor_id: str, day: dt.date | str,
                   order: bool = True) -> DataFrame:
    """The current readings of one (sensor_id, day_bucket), time ascending."""
    from ..sinks.tables import read_readings
    out = read_readings(spark, path, sensor_id, day)
    return out.orderBy("ts") if order else out


def read_partition_sql(spark: SparkSession, table: str, sensor_id: str,
                       day: dt.date | str) -> DataFrame:
    """S10 / F12 in SQL with bound parameters (no string building of values)."""
    from ..sinks.tables import SENSOR_BUCKETS
    return spark.sql(
        f"SELECT sensor_id, day_bucket, ts, max_by(lx, write_id) AS lx FROM {table} "
        f"WHERE sensor_bucket = pmod(xxhash64(:sensor), {SENSOR_BUCKETS}) "
        "AND sensor_id = :sensor AND day_bucket = :day "
        "GROUP BY sensor_id, day_bucket, ts ORDER BY ts",
        args={"sensor": sensor_id, "day": dt.date.fromisoformat(str(day))})


def read_latest(spark: SparkSession, path: str, prefix: str,
                now: dt.datetime | Column) -> DataFrame:
    """Newest live version of every key starting with ``prefix``, by window start.

    ``path`` is the table folder or a table / view name (see ``publish_latest``).

    The table holds one row per (key, run, epoch); the newest version wins, then expiry
    is checked against ``now`` (an explicit instant, so reruns agree).
    """
    from ..operators.series import latest_by_key
    from ..sinks.tables import not_expired
    versions = read_table(spark, path).where(F.col("key").startswith(prefix))
    newest = latest_by_key(versions, "key", ["run_id", "epoch_id"])
    return not_expired(newest, now).orderBy("fenster_start", "key")


def flag_fit(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """S13, one pass: location rows of decoded fitness records with ``reason``
    (NULL when the record is usable)."""
    out = records.select(
        *keep,
        as_instant("timestamp").alias("zeit"),
        semicircles_to_deg("position_lat").alias("lat"),
        semicircles_to_deg("position_long").alias("lon"),
        F.col("enhanced_altitude").cast("double").alias("alt"),
        F.col("heart_rate").cast("double").alias("hr"),
        F.col("temperature").cast("double").alias("temp"),
    )
    missing = F.col("zeit").isNull() | F.col("lat").isNull() | F.col("lon").isNull()
    in_range = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    return out.withColumn("reason", F.when(missing, F.lit("missing:time,lat,lon"))
                          .when(~in_range, F.lit("coords out of range")))


def normalise_fit(records: DataFrame, fill_zero: bool = False,
                  keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Decoded fitness records -> location rows (zeit, lat, lon, alt, hr, temp).

    Records without time or position are rejects; positions are converted from
    semicircles and must be valid coordinates. ``fill_zero`` reproduces the
    producers that send 0 for a missing altitude / heart rate / temperature.
    """
    flagged = flag_fit(records, keep)
    kept = flagged.where(F.col("reason").isNull()).drop("reason")
    if fill_zero:
        for c in ("alt", "hr", "temp"):
            kept = kept.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    return kept, flagged.where(F.col("reason").isNotNull())
