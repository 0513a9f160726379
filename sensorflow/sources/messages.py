"""Message topics as sources (S4) and sinks (K1).

``fmt='kafka'`` uses Spark's Kafka connector (its jar must be on the class
path). ``fmt='files'`` is a stand-in with the same columns (key, value,
topic, partition, offset, timestamp, timestampType) stored as parquet files,
one folder per topic; it is what the tests use offline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_messages(spark: SparkSession, topic: str, servers: str | None = None,
                  starting: str = "earliest", fmt: str = "kafka", path: str | None = None,
                  max_per_trigger: int | None = None, stream: bool = True) -> DataFrame:
    """A topic as an unbounded (``stream=True``) or bounded source.

    The query's checkpoint, not ``starting``, decides where a restarted query
    resumes; ``starting`` only applies to the first run.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
             .option("subscribe", topic).option("startingOffsets", starting))
        if stream and max_per_trigger:
            r = r.option("maxOffsetsPerTrigger", max_per_trigger)
        elif not stream:
            r = r.option("endingOffsets", "latest")
        return r.load()
    if fmt == "files":
        if path is None:
            raise ValueError("fmt='files' needs path")
        r = reader.schema(schemas.MESSAGE).format("parquet")
        if stream and max_per_trigger:
            r = r.option("maxFilesPerTrigger", max_per_trigger)
        return r.load(f"{path.rstrip('/')}/{topic}")
    raise ValueError(f"unknown message format {fmt!r}")


def as_messages(df: DataFrame, value: Column | str, topic: str,
                key: Column | str | None = None, partitions: int = 3) -> DataFrame:
    """Rows -> message rows: ``value`` text as bytes, optional key.

    With a key, the partition is the key's hash modulo ``partitions`` (one
    series stays in one partition, in order); without one, rows are spread by
    a hash of the value. Works on a batch and on a stream: the offset is not
    part of a row before it is published (a broker gives it on arrival, the
    file stand-in in :func:`write_messages`).
    """
    v = F.col(value) if isinstance(value, str) else value
    k = None if key is None else (F.col(key) if isinstance(key, str) else key)
    part = (F.pmod(F.hash(k), F.lit(partitions)) if k is not None
            else F.pmod(F.hash(v.cast("string")), F.lit(partitions)))
    return df.select(
        (k.cast("string").cast("binary") if k is not None else F.lit(None).cast("binary")).alias("key"),
        v.cast("string").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        part.cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def write_messages(df: DataFrame, topic: str, servers: str | None = None, fmt: str = "kafka",
                   path: str | None = None) -> None:
    """K1: publish message rows (``as_messages`` output or key/value columns)."""
    if fmt == "kafka":
        (df.select("key", "value").write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic).save())
        return
    if fmt == "files":
        if path is None:
            raise ValueError("fmt='files' needs path")
        if "offset" in df.columns:
            df = df.withColumn("offset", F.coalesce("offset", F.monotonically_increasing_id()))
        df.write.mode("append").parquet(f"{path.rstrip('/')}/{topic}")
        return
    raise ValueError(f"unknown message format {fmt!r}")


def publish_stream(df: DataFrame, name: str, topic: str, servers: str | None = None, fmt: str = "kafka",
                   path: str | None = None, trigger: str | None = "1 second", available_now: bool = False,
                   checkpoint: str | None = None):
    """K1 on a stream: message rows (:func:`as_messages`) to a topic, one append per micro-batch."""
    from ..streaming.streams import for_each_batch

    return for_each_batch(df, name, lambda b, e: write_messages(b, topic, servers, fmt, path), mode="append",
                          trigger=trigger, available_now=available_now, checkpoint=checkpoint)


def co_locate(df: DataFrame, key: str | list[str], ts: str,
              partitions: int | None = None) -> DataFrame:
    """M4: keep each series contiguous and in time order.

    Range partitioning on (key, ts): a series occupies consecutive partitions,
    and a hot series is split by time over several of them instead of landing
    in one task as a hash partitioning on the key would.
    """
    keys = [key] if isinstance(key, str) else list(key)
    parts = ([partitions] if partitions else [])
    return df.repartitionByRange(*parts, *keys, ts).sortWithinPartitions(*keys, ts)
