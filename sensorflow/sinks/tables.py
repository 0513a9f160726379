"""Table sinks: points, day-partitioned readings, keyed latest-window table with
expiry, catalog tables, fan-out (K3-K9).

There is no lakehouse format on the class path, so upserts are versioned
writes: each carries a version (``run_id`` and ``epoch_id``, or ``write_id``),
and the read side keeps the newest version per key with a ``max_by`` aggregate.
Writing a version again overwrites exactly its partitions (dynamic partition
overwrite), which makes the sinks idempotent. :func:`drop_versions` removes
versions that a compacted table has taken over.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timestamps import as_instant, day_bucket, window_key


def with_ttl(df: DataFrame, base: str | Column, seconds: int, out: str = "expires_at") -> DataFrame:
    """K4: ``expires_at = base + seconds`` (base = write time or event time)."""
    b = as_instant(base)
    return df.withColumn(out, b + F.make_dt_interval(secs=F.lit(seconds)))


def not_expired(df: DataFrame, now: dt.datetime | Column, col: str = "expires_at") -> DataFrame:
    """K4: entries still alive at ``now``; take the newest version *before* this.

    An entry written without a TTL (``expires_at`` NULL) never expires.
    """
    if isinstance(now, Column):
        now_c = now
    elif isinstance(now, dt.datetime) and now.tzinfo is None:
        # naive = UTC wall time, whatever the Python process zone is
        now_c = F.lit(now.isoformat(sep=" ")).cast("timestamp")
    else:
        now_c = F.lit(now).cast("timestamp")
    # no expiry set (NULL) means the entry never expires
    return df.where(F.col(col).isNull() | (F.col(col) > now_c))


def latest_rows(df: DataFrame, key_prefix: str, ttl_s: int | None, now: Column | None = None,
                epoch_id: int = 0, run_id: int = 0) -> DataFrame:
    """K3 record shape: window rows -> (key, ..., run_id, epoch_id, expires_at).

    ``now`` is the write instant the expiry counts from (default: the
    batch's current timestamp, one value per query).
    """
    out = df.withColumn("key", window_key(key_prefix, "fenster_start"))
    out = out.withColumn("run_id", F.lit(run_id).cast("bigint"))
    out = out.withColumn("epoch_id", F.lit(epoch_id).cast("bigint"))
    if ttl_s is not None:
        base = now if now is not None else F.current_timestamp()
        out = with_ttl(out, base, ttl_s)
    else:
        out = out.withColumn("expires_at", F.lit(None).cast("timestamp"))
    cols = ["key", *[c for c in df.columns if c != "key"], "run_id", "epoch_id", "expires_at"]
    return out.select(*cols)


def upsert_batch(batch: DataFrame, epoch_id: int, path: str, key_prefix: str,
                 ttl_s: int | None = 120, now: Column | None = None, run_id: int = 0) -> None:
    """Write one micro-batch of changed windows as version ``(run_id, epoch_id)``.

    Runs on the executors (no ``collect``); a repeated epoch replaces its own
    partition only, so replays after a failure leave the table unchanged.
    """
    rows = latest_rows(batch, key_prefix, ttl_s, now, epoch_id, run_id)
    (rows.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "epoch_id").parquet(path))


VERSION = ("run_id", "epoch_id")


def _not_after(run_id: int, epoch_id: int) -> Column:
    return (F.col("run_id") < run_id) | ((F.col("run_id") == run_id) & (F.col("epoch_id") <= epoch_id))


def compact_latest(spark: SparkSession, path: str, out_path: str,
                   now: dt.datetime | Column | None = None,
                   upto_epoch: int | None = None, upto_run: int = 0) -> DataFrame:
    """Rewrite the newest live version per key of versions up to ``(upto_run,
    upto_epoch)`` (all by default) into ``out_path``, a new folder: the live table is never
    overwritten while it is read. Expired keys are dropped. Readers move over
    with :func:`publish_latest`."""
    from ..operators.series import latest_by_key
    versions = spark.read.parquet(path)
    if upto_epoch is not None:
        versions = versions.where(_not_after(upto_run, upto_epoch))
    newest = latest_by_key(versions, "key", VERSION)
    if now is not None:
        newest = not_expired(newest, now)
    newest.write.mode("overwrite").partitionBy(*VERSION).parquet(out_path)
    return spark.read.parquet(out_path)


def publish_latest(spark: SparkSession, view: str, compacted_path: str, live_path: str,
                   upto_epoch: int, upto_run: int = 0) -> None:
    """Switch readers to ``compacted + live versions after (upto_run, upto_epoch)``
    by replacing a view definition (the pointer). Queries already running keep
    their files; the next read sees the new layout. Newest version still wins
    per key."""
    if "." in view:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{view.split('.')[0]}`")
    spark.sql(
        f"CREATE OR REPLACE VIEW {view} AS "
        f"SELECT * FROM parquet.`{compacted_path}` "
        f"UNION ALL SELECT * FROM parquet.`{live_path}` "
        f"WHERE run_id > {int(upto_run)} OR run_id = {int(upto_run)} AND epoch_id > {int(upto_epoch)}")


def drop_versions(spark: SparkSession, path: str, upto_epoch: int, upto_run: int = 0) -> int:
    """Remove the version folders up to ``(upto_run, upto_epoch)``; returns how many.

    To be called after :func:`publish_latest` moved the readers to a compacted
    table that holds these versions, and after queries that began before it are
    done: readers of the view no longer list the folders removed here.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    gone = 0
    for run in fs.listStatus(root):
        name = run.getPath().getName()
        if not name.startswith("run_id="):
            continue
        run_id = int(name.removeprefix("run_id="))
        for epoch in fs.listStatus(run.getPath()):
            e = epoch.getPath().getName()
            if e.startswith("epoch_id=") and (run_id, int(e.removeprefix("epoch_id="))) <= (upto_run, upto_epoch):
                gone += bool(fs.delete(epoch.getPath(), True))
        if not fs.listStatus(run.getPath()):
            fs.delete(run.getPath(), True)
    return gone


def _one_per_key(df: DataFrame, key: Sequence[str], version: str | None, value: str) -> DataFrame:
    """One row per key: the highest ``version`` if there is one; ties, and rows
    without, go to the greatest value, so a repeated write picks the same row."""
    from ..operators.series import latest_by_key
    return latest_by_key(df, key, [*([version] if version else []), value])


def write_points(df: DataFrame, path: str, write_id: int, precision: str = "ms",
                 version: str | None = None) -> None:
    """K5: long points -> parquet partitioned by (measurement, day_bucket, write_id).

    The day is that of the point's time, so a range of a long series is a few
    folders (:func:`sources.tables.read_points`). Time is truncated to ``precision``; the key is (measurement, field, time),
    and the newest ``write_id`` wins on read. Inside one write the highest ``version`` survives, if given. Writing a
    ``write_id`` again replaces it, so a replayed batch adds nothing.
    """
    t = as_instant("time")
    if precision == "ms":
        t = F.timestamp_millis(F.unix_millis(t))
    elif precision == "s":
        t = F.timestamp_seconds(F.unix_seconds(t))
    pts = _one_per_key(df.withColumn("time", t), ["measurement", "field", "time"], version, "value")
    # Range partitioning: each file holds one time slice of one series, and a
    # hot measurement is split over many writers instead of one.
    (pts.withColumn("day_bucket", day_bucket("time")).withColumn("write_id", F.lit(write_id).cast("bigint"))
     .repartitionByRange("measurement", "day_bucket", "field", "time")
     .sortWithinPartitions("measurement", "day_bucket", "field", "time")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("measurement", "day_bucket", "write_id").parquet(path))


#: Folders into which the sensors of a readings table are dealt by a hash of their id.
SENSOR_BUCKETS = 64


def sensor_bucket(sensor_id: str | Column = "sensor_id") -> Column:
    c = F.col(sensor_id) if isinstance(sensor_id, str) else sensor_id
    return F.pmod(F.xxhash64(c), F.lit(SENSOR_BUCKETS)).cast("int")


def write_readings(df: DataFrame, path: str, write_id: int, ts: str = "ts", version: str | None = None) -> None:
    """K6: readings (sensor_id, ts, lx) -> parquet partitioned by (sensor_bucket,
    day_bucket, write_id), sorted by sensor and time: the number of folders
    does not grow with the sensors. The key is (sensor_id, day_bucket, ts) and
    the newest ``write_id`` wins on read (:func:`read_readings`). Writing a
    ``write_id`` again replaces it."""
    out = (df.withColumn("ts", F.timestamp_millis(F.unix_millis(as_instant(ts))))
           .withColumn("day_bucket", day_bucket("ts")))
    out = (_one_per_key(out, ["sensor_id", "day_bucket", "ts"], version, "lx")
           .withColumn("sensor_bucket", sensor_bucket())
           .withColumn("write_id", F.lit(write_id).cast("bigint")))
    (out.repartitionByRange("sensor_bucket", "day_bucket", "sensor_id", "ts")
     .sortWithinPartitions("sensor_bucket", "day_bucket", "sensor_id", "ts")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("sensor_bucket", "day_bucket", "write_id").parquet(path))


def read_readings(spark: SparkSession, path: str, sensor_id: str | None = None,
                  day: dt.date | str | None = None) -> DataFrame:
    """Current readings (newest write per key), optionally of one sensor or day only."""
    from ..operators.series import latest_by_key
    df = spark.read.parquet(path)
    if sensor_id is not None:
        one = int(spark.range(1).select(sensor_bucket(F.lit(sensor_id))).first()[0])
        df = df.where((F.col("sensor_bucket") == one) & (F.col("sensor_id") == F.lit(sensor_id)))
    if day is not None:
        df = df.where(F.col("day_bucket") == F.lit(str(day)).cast("date"))
    return latest_by_key(df.select("sensor_id", "day_bucket", "ts", "lx", "write_id"),
                         ["sensor_id", "day_bucket", "ts"], ["write_id"]).drop("write_id")


def ensure_table(spark: SparkSession, name: str, schema: T.StructType,
                 partition_cols: Sequence[str] = (), location: str | None = None) -> None:
    """K8: create the namespace and the parquet table when missing."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    part = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_cols)})" if partition_cols else ""
    loc = f" LOCATION '{location}'" if location else ""
    quoted = ".".join(f"`{p}`" for p in name.split("."))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted} ({cols}) USING parquet{part}{loc}")


def append_rows(df: DataFrame, table: str) -> None:
    """K9: append rows to a catalog table (columns matched by name)."""
    cols = df.sparkSession.table(table).columns
    df.select(*cols).write.insertInto(table)


def current_rows(spark: SparkSession, table: str, key: Sequence[str] | str,
                 version: str) -> DataFrame:
    """K9 read side: a keyed table written by appends, one row per key (newest
    ``version`` wins), the way an insert on an existing primary key overwrites."""
    from ..operators.series import latest_by_key
    return latest_by_key(spark.table(table), key, [version])


def fan_out(df: DataFrame, sinks: Sequence[Callable[[DataFrame], None]]) -> None:
    """K7: write ``df`` to every sink; one failing sink does not stop the others.

    The frame is persisted once so the sinks do not recompute it; after all
    sinks ran, the first failure is raised (none is swallowed).
    """
    df.persist(StorageLevel.MEMORY_AND_DISK)
    errors: list[BaseException] = []
    try:
        for sink in sinks:
            try:
                sink(df)
            except Exception as e:  # noqa: BLE001 - collected and re-raised below
                errors.append(e)
    finally:
        df.unpersist()
    if errors:
        raise RuntimeError(f"{len(errors)} of {len(sinks)} sinks failed") from errors[0]


def to_pandas_bounded(df: DataFrame, n: int, order: Sequence | None = None):
    """At most ``n`` rows to the caller as pandas (after ordering, if given).

    The limit is applied in Spark (top-k per partition, then merged), so the
    driver never receives more than ``n`` rows.
    """
    out = df.orderBy(*order) if order else df
    return out.limit(n).toPandas()


# Fields of one latest-window entry, in the order the surveyed
# cache wrote them.
LATEST_FIELDS = ("fenster_start", "fenster_ende", "avg_absolute", "avg_gx", "avg_gy", "avg_gz",
                 "n_samples")


def as_hash_view(df: DataFrame, decimals: int = 6) -> DataFrame:
    """D15 text view: ``(key, fields map<string,string>)`` with numbers as
    rounded text (NULL -> ''), timestamps as text -- for consumers that read a
    key-value cache. The table itself keeps typed columns."""
    from ..functions.formats import fmt_num
    pairs = []
    for c in LATEST_FIELDS:
        dtype = dict(df.dtypes)[c]
        if dtype in ("double", "float"):
            v = fmt_num(c, decimals)
        else:
            v = F.coalesce(F.col(c).cast("string"), F.lit(""))
        pairs += [F.lit(c), v]
    return df.select("key", F.create_map(*pairs).alias("fields"))


def from_hash_view(df: DataFrame) -> DataFrame:
    """Map entries back to typed columns ('' -> NULL)."""
    def text(c):
        v = F.col("fields")[c]
        return F.when(v != F.lit(""), v)
    return df.select(
        "key",
        text("fenster_start").try_cast("timestamp").alias("fenster_start"),
        text("fenster_ende").try_cast("timestamp").alias("fenster_ende"),
        *[text(c).try_cast("double").alias(c)
          for c in ("avg_absolute", "avg_gx", "avg_gy", "avg_gz")],
        text("n_samples").try_cast("bigint").alias("n_samples"))
