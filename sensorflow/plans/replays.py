"""Registered queries that run a stream: the events arrive out of order, in two
parts, and the operators of :mod:`sensorflow.streaming.ordered` put them right.

Every event arrives some hours after its time (an integer rule of its id). The
events that have arrived by the middle of the period are the first part, the
rest the second; each part is written as files and consumed by a query that is
restarted from its checkpoint, and a last row in the far future moves the
watermark past all others. What the streams wrote is the result, and the same
SQL rule tells which events came too late.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timestamps import as_instant, as_wall_clock
from ..session import SESSION_DEFAULTS, checkpoint_path
from ..streaming import streams
from ..streaming.ordered import gap_stream, in_view, lag_stream, trailing_stream
from .queries import ORDER, QUERIES
from .oracle import ORACLE
from .tables import events, lat_of, lon_of

#: An event arrives (event_id * STEP) % SPREAD seconds after its time; the stream waits DELAY seconds.
STEP, SPREAD, DELAY = 7919, 21_600, 7_200
#: Bucket of waiting rows in milliseconds, the range of the trailing view, and tasks of the state (a few series here).
WIDTH_MS, VIEW, STATE_TASKS = 60_000, "2 days", 4


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint root; local sessions without one get their own, as in tests."""
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="sf-replay-"))
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


def arrived(ev: DataFrame) -> list[DataFrame]:
    """The events by the time of their arrival: up to the middle of the period, after it, and the row that ends the stream."""
    us = F.unix_micros(as_instant("ts"))
    late = us + (F.col("event_id") * STEP % SPREAD) * 1_000_000
    middle = ev.select((F.min(us) + F.floor((F.max(us) - F.min(us)) / 2))).scalar()
    end = ev.limit(1).select(*[(F.lit(-1).cast("bigint") if c == "event_id" else F.lit("2100-01-01 00:00:00").cast(t) if c == "ts"
                                else F.lit(-1).cast(t) if c == "user_id" else F.lit(None).cast(t)).alias(c) for c, t in ev.dtypes])
    return [ev.where(F.coalesce(late <= middle, F.lit(True))), ev.where(late > middle), end]


def replay(spark: SparkSession, ev: DataFrame, stream: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """What ``stream`` writes when ``ev`` arrives in parts, the query stopping and starting again between them."""
    folder = scratch(spark, name)
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(STATE_TASKS))
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", SESSION_DEFAULTS["spark.sql.streaming.stateStore.providerClass"])
        for part in arrived(ev):
            part.write.mode("append").parquet(os.path.join(folder, "in"))
            out = stream(spark.readStream.schema(ev.schema).parquet(os.path.join(folder, "in")))
            streams.to_table(out, f"{name}_{uuid.uuid4().hex[:8]}", os.path.join(folder, "out"), available_now=True,
                             checkpoint=os.path.join(folder, "checkpoint")).awaitTermination()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return spark.read.schema(out.schema).parquet(os.path.join(folder, "out"))


def _delay() -> str:
    return f"{DELAY} seconds"


def stream_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the previous value of its type in event-time order, whether it is a change, or came late."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type", "value")
    out = replay(spark, ev, lambda s: lag_stream(s, "event_type", ORDER, ["value"], _delay(), f"{WIDTH_MS} milliseconds"), "changes")
    return out.select("event_type", "event_id", "value", "prev_value", "late",
                      (~F.col("late") & ~F.col("value").eqNullSafe(F.col("prev_value"))).alias("changed"))


def stream_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path segments of every user with the gap between their ends, each once, from rows that were not late."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", lat_of().alias("lat"), lon_of().alias("lon"))

    def both(s: DataFrame) -> DataFrame:
        timed = s.withColumn("us", F.unix_micros(as_instant("ts")))
        return lag_stream(timed, "user_id", ORDER, ["lat", "lon", "us"], _delay(), f"{WIDTH_MS} milliseconds").where("has_prev and not late")

    out = replay(spark, ev, both, "segments")
    return out.select("user_id", "event_id", "prev_lat", "prev_lon", "lat", "lon", (F.col("us") - F.col("prev_us")).alias("gap_us"))


def stream_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap of every sample to the one before in its type; late samples are marked and have none."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "event_type")
    out = replay(spark, ev, lambda s: gap_stream(s, "event_type", ORDER, _delay(), f"{WIDTH_MS} milliseconds"), "gaps")
    return out.select("event_type", "event_id", "gap_us", "late")


def stream_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the view of the last two days after all events have arrived, from the changes that the stream wrote."""
    ev = events(spark, sf_dir).select("event_id", "ts", "user_id", "value")

    def shown(s: DataFrame) -> DataFrame:
        return trailing_stream(s.where("user_id >= 0"), "user_id", "ts", VIEW)

    changes = replay(spark, ev, shown, "trailing")
    return in_view(changes).select("event_id", as_wall_clock("ts").alias("ts"), "value")


_ARRIVED = f"""
with came as (
  select *, epoch_us(ts) // 1000 as ms, epoch_us(ts) + (event_id * {STEP} % {SPREAD}) * 1000000 as arrival,
    (select min(epoch_us(ts)) + (max(epoch_us(ts)) - min(epoch_us(ts))) // 2 from events) as middle
  from events),
mark as (select max(ms) - {DELAY * 1000} as watermark from came where arrival <= middle),
done as (
  select {{key}} as k, max(ms - ms % {WIDTH_MS} + {WIDTH_MS}) as until from came cross join mark
  where arrival <= middle and ms - ms % {WIDTH_MS} + {WIDTH_MS} <= watermark group by 1),
told as (
  select came.*, coalesce(arrival > middle and ms < until, false) as late from came left join done on done.k = {{key}}),
lagged as (
  select *, {{lags}} from told where not late)
"""

STREAM_QUERIES = {"stream_changes": stream_changes, "stream_segments": stream_segments, "stream_gaps": stream_gaps,
                  "stream_trailing": stream_trailing}

_W = "over (partition by {key} order by ts, event_id)"
STREAM_ORACLE = {
    "stream_changes": _ARRIVED.format(key="event_type", lags="lag(value) " + _W.format(key="event_type") + " as prev_value") + """
        select event_type, event_id, value, prev_value, late, value is distinct from prev_value as changed from lagged
        union all select event_type, event_id, value, null, late, false from told where late""",
    "stream_segments": _ARRIVED.format(key="user_id", lags=", ".join(
        f"lag({c}) {_W.format(key='user_id')} as prev_{n}" for c, n in (
            ("(event_id*7919)%20000/100.0::double - 100.0::double", "lat"), ("(event_id*104729)%40000/100.0::double - 200.0::double", "lon"),
            ("epoch_us(ts)", "us"), ("1", "one")))) + """
        select user_id, event_id, prev_lat, prev_lon, (event_id*7919)%20000/100.0::double - 100.0::double as lat,
          (event_id*104729)%40000/100.0::double - 200.0::double as lon, epoch_us(ts) - prev_us as gap_us
        from lagged where prev_one = 1""",
    "stream_gaps": _ARRIVED.format(key="event_type", lags="epoch_us(ts) - lag(epoch_us(ts)) " + _W.format(key="event_type") + " as gap_us") + """
        select event_type, event_id, gap_us, late from lagged
        union all select event_type, event_id, null, late from told where late""",
    "stream_trailing": """
        select event_id, ts, value from events
        where epoch_us(ts) // 1000 >= (select max(epoch_us(ts)) // 1000 from events) - 2 * 86400000""",
}

QUERIES.update(STREAM_QUERIES)
ORACLE.update(STREAM_ORACLE)
