"""End-to-end jobs: the surveyed workflows as Spark plans (lifecycles L1-L4).

Each job is sources -> typed series -> operators -> sink, one Catalyst plan
per stage; nothing loops over rows on the driver. Start instants are
parameters (never the wall clock) so reruns give the same event times.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.formats import encode, label
from ..functions.parse import event_time_s
from ..functions.timestamps import from_epoch, rebase
from ..operators import clean, series
from ..operators.counts import load_counts, observed
from ..operators.extract import extract_readings
from ..operators.messages import flag_location, parse_gyro, parse_location
from ..operators.reshape import GYRO_POINT_MAPPING, to_points
from ..operators.windows import track_summary, window_stats
from ..sinks.tables import fan_out, write_points, write_readings
from ..sources import files
from ..sources.messages import as_messages
from ..sources.tables import normalise_fit
from ..streaming import streams

GYRO_MEANS = ["absolute", "gx", "gy", "gz"]
TRACK_MEANS = {"lat_mean": "lat", "lon_mean": "lon", "alt_mean": "alt",
               "speed_mean": "speed", "hr_mean": "hr", "temp_mean": "temp"}


# -- L1: batch analysis of a gyroscope recording -------------------------------

def batch_gyro(spark: SparkSession, csv_path: str, start_s: float,
               size: str = "1 second") -> tuple[DataFrame, DataFrame]:
    """Gyroscope CSV -> per-window means of all axes in one aggregate, ordered,
    with seconds elapsed since the first window. Returns ``(windows, rejects)``."""
    rows, rejects = files.read_sensor_csv(spark, csv_path)
    timed = rows.withColumn("zeit", event_time_s(F.lit(float(start_s)) + F.col("time_s")))
    win = window_stats(timed, "zeit", size, GYRO_MEANS, count_of="absolute")
    return series.elapsed(win, "fenster_start").orderBy("fenster_start"), rejects


# -- L2: live window table of a gyroscope topic ----------------------------------

def gyro_windows(messages: DataFrame, size: str = "1 second",
                 watermark: str = "10 seconds") -> DataFrame:
    """Gyroscope messages -> windowed means + sample count (batch or stream)."""
    parsed, _ = parse_gyro(messages)
    return window_stats(parsed, "zeit", size, GYRO_MEANS, count_of="absolute",
                        watermark=watermark if messages.isStreaming else None)


def gyro_rejects(messages: DataFrame) -> DataFrame:
    """What :func:`gyro_windows` leaves out: (raw, reason), of a batch or a stream."""
    return parse_gyro(messages)[1]


def stream_gyro(messages: DataFrame, name: str = "gyro_results", path: str | None = None,
                memory: bool = False, mode: str = "complete", trigger: str = "5 seconds",
                available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Topic -> window table: below ``path``, written by the executors in update
    mode (:func:`serve_latest`, no expiry), or with ``memory`` in the driver's
    memory, queryable as ``name`` (K2, S12): a dashboard for one device or a few.
    """
    return _window_sink(gyro_windows(messages), name, path, memory, "sensor:gyro", mode, trigger,
                        available_now, checkpoint)


def _window_sink(windows: DataFrame, name: str, path: str | None, memory: bool, key_prefix: str, mode: str,
                 trigger: str, available_now: bool, checkpoint: str | None) -> StreamingQuery:
    if memory:
        return streams.to_memory(windows, name, mode, trigger, available_now, checkpoint)
    if path is None:
        raise ValueError("give the path of the window table, or memory=True")
    return streams.upsert_stream(windows, name, path, key_prefix, None, trigger=trigger,
                                 available_now=available_now, checkpoint=checkpoint)


def stream_rejects(rejects: DataFrame, name: str, path: str, trigger: str = "5 seconds",
                   available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Reject rows of a stream (``gyro_rejects``, ``track_rejects``) -> parquet folder."""
    return streams.to_table(rejects, name, path, "append", trigger, available_now, checkpoint=checkpoint)


def gyro_chart(spark: SparkSession, name: str = "gyro_results",
               minutes: int = 2) -> DataFrame:
    """The chart table: windows of the last ``minutes`` before the newest one."""
    table = spark.table(name)
    return series.trailing(table, "fenster_start", f"{minutes} minutes").orderBy("fenster_start")


# -- L3: keyed latest-window table with expiry ------------------------------------

def serve_latest(messages: DataFrame, path: str, key_prefix: str, ttl_s: int = 120,
                 name: str = "gyro_latest", trigger: str = "1 second",
                 available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Topic -> changed windows per micro-batch (update mode) -> versioned keyed table."""
    return streams.upsert_stream(gyro_windows(messages), name, path, key_prefix, ttl_s,
                                 trigger=trigger, available_now=available_now,
                                 checkpoint=checkpoint)


# -- part 6: location track -------------------------------------------------------

def track_windows(messages: DataFrame, size: str = "500 milliseconds",
                  watermark: str = "1 second", by: Sequence[str] = ()) -> DataFrame:
    """Location messages (both layouts) -> valid coordinates -> windowed means."""
    parsed, _ = parse_location(messages)
    valid = clean.valid_coords(parsed)
    return window_stats(valid, "zeit", size, TRACK_MEANS, count_of="lat", by=list(by),
                        watermark=watermark if messages.isStreaming else None, end=None, counts=True)


def track_rejects(messages: DataFrame) -> DataFrame:
    """What :func:`track_windows` leaves out: (raw, reason), of a batch or a stream."""
    flagged = flag_location(messages)
    outside = F.when(~F.coalesce(clean.coords_ok(), F.lit(False)), F.lit("coords out of range"))
    return (flagged.select("raw", F.coalesce("reason", outside).alias("reason"))
            .where(F.col("reason").isNotNull()))


def stream_track(messages: DataFrame, name: str = "track_windows", path: str | None = None,
                 memory: bool = False, mode: str = "complete", trigger: str = "1 second",
                 available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Location topic -> window table, as :func:`stream_gyro`."""
    return _window_sink(track_windows(messages), name, path, memory, "sensor:track", mode, trigger,
                        available_now, checkpoint)


def track_view(windows: DataFrame, shown: DataFrame | None = None,
               by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Map layers from a window table: new points (F9, F8), path segments (W1),
    labels (P25), altitude deltas (M1) and the summary (A7)."""
    complete = clean.drop_incomplete(windows, ["lat_mean", "lon_mean"])
    new = complete if shown is None else series.unseen(complete, shown, [*by, "fenster_start"])
    points = new.withColumn("label", label("hr_mean", "alt_mean", "temp_mean", "n_samples"))
    segs = series.segments(complete, list(by), ["fenster_start"], "lat_mean", "lon_mean",
                           bucket="1 hour")
    deltas = series.delta(complete, list(by), ["fenster_start"], "alt_mean", "d_alt",
                          bucket="1 hour")
    summary = track_summary(complete, ["hr_mean", "alt_mean"])
    return {"points": points, "segments": segs, "deltas": deltas, "summary": summary}


# -- L4: points and readings ---------------------------------------------------------

def gyro_points(spark: SparkSession, csv_path: str, start_s: float, out_path: str,
                precision: str = "ms", warmup_s: int = 1, write_id: int = 0) -> dict[str, int]:
    """Gyroscope CSV -> four measurements as points (R1) -> points table (K5).

    Returns the counts: rows read (including warm-up rows) and points written.
    """
    rows, rejects = files.read_sensor_csv(spark, csv_path)
    counted, obs = observed(rows, "gyro_rows", warmup=F.col("time_s").try_cast("bigint") < warmup_s)
    kept = clean.skip_warmup(counted, "time_s", warmup_s)
    timed = kept.withColumn("time", from_epoch(rebase("time_s", start_s, "us"), "us"))
    pts = to_points(timed, GYRO_POINT_MAPPING, "time")
    write_points(pts, out_path, write_id, precision)
    m = obs.get
    return {"rows": m["rows"], "warmup": m["warmup"], "points": 4 * (m["rows"] - m["warmup"]),
            "rejects": rejects.count()}


def light_readings(spark: SparkSession, csv_path: str, target_end_s: float,
                   readings_path: str, points_path: str, write_id: int,
                   sensor_id: str = "light") -> None:
    """Light CSV (ns) -> shifted so the last sample lands on ``target_end_s``
    -> readings table (K6) and points table (K5), both tried (K7)."""
    rows, _ = files.read_light_csv(spark, csv_path)
    shifted = series.rebase_to_end(rows, "time", int(target_end_s * 1000), out="ts")
    readings = shifted.select(F.lit(sensor_id).alias("sensor_id"), "ts", "lx")
    fan_out(readings, [
        lambda d: write_readings(d, readings_path, write_id),
        lambda d: write_points(
            d.select(F.col("sensor_id").alias("measurement"), F.lit("lx").alias("field"),
                     F.col("lx").alias("value"), F.col("ts").alias("time")),
            points_path, write_id, precision="us"),
    ])


def dump_readings(spark: SparkSession, dumps_path: str, sensor_id: str = "light",
                  at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Sensor-service dumps -> readings, emitted only on change.

    The reading time is the dump file's modification time unless ``at`` is given.
    """
    dumps = files.read_dumps(spark, dumps_path).withColumn(
        "ts", at if at is not None else F.col("modified"))
    ok, rejects = extract_readings(dumps)
    readings = ok.select(F.lit(sensor_id).alias("sensor_id"), "ts", F.col("value").alias("lx"),
                         "dump_id")
    changed = series.on_change(readings, "sensor_id", ["ts", "dump_id"], "lx", bucket="1 hour")
    return changed.drop("dump_id"), rejects


# -- replay producers: files -> topic messages -------------------------------------------

def walk_messages(spark: SparkSession, csv_path: str, start_s: float, topic: str = "location",
                  fill_zero: bool = True, speed_factor: float = 5.0
                  ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Walk CSV -> location messages ``ts,lat,lon,alt,speed`` (P5, P7, P8, K1 rows),
    the replay pauses (W5) and the load counts (A8)."""
    rows, rejects = files.read_walk_csv(spark, csv_path)
    if fill_zero:
        rows = clean.fill_zero(rows, ["alt", "speed"])
    rows = rows.withColumn("ts_ms", rebase("time_s", start_s, "ms"))
    msg = encode({"ts_ms": "ts_ms", "lat": "lat", "lon": "lon", "alt": "alt", "speed": "speed"},
                 "walk")
    messages = as_messages(rows, msg, topic)
    timed = rows.withColumn("ts", F.timestamp_millis("ts_ms"))
    pauses = series.sample_gap(timed, None, ["ts"], "ts", factor=speed_factor, bucket="1 hour")
    return messages, pauses, load_counts(rows, rejects)


def fit_messages(records: DataFrame, topic: str = "location",
                 fill_zero: bool = True) -> tuple[DataFrame, DataFrame]:
    """Decoded fitness records -> location messages ``ts,lat,lon,alt,hr,temp``.

    The event time is the record's own timestamp (not the send time)."""
    rows, rejects = normalise_fit(records, fill_zero)
    msg = encode({"ts_ms": F.unix_millis("zeit"), "lat": "lat", "lon": "lon", "alt": "alt",
                  "hr": "hr", "temp": "temp"}, "fitness")
    return as_messages(rows, msg, topic), rejects


def _versions() -> Callable[[int], int]:
    """Write ids of a run: epoch numbers after the run's start, above those of every earlier run."""
    first = streams.run_start() * 1_000_000
    return lambda epoch_id: first + epoch_id


def stream_dump_readings(spark: SparkSession, dumps_dir: str, readings_path: str,
                         sensor_id: str | None = None, name: str = "dump_readings",
                         files_per_trigger: int = 100, available_now: bool = False,
                         checkpoint: str | None = None) -> StreamingQuery:
    """Dumps arriving in a folder -> sensor value (X1) -> only changes (T6) ->
    readings table (K6), one version per micro-batch.

    The stream form of polling a device and posting a value only when it
    changed; the reading time is the dump file's modification time. Each device
    has a folder below ``dumps_dir`` whose name is its sensor id, so devices
    are separate groups; ``sensor_id`` names the one device of a flat folder.
    """
    from ..operators.extract import with_dump_value
    from ..streaming.state import on_change_stream

    dumps = (spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
             .option("recursiveFileLookup", "true").text(dumps_dir, wholetext=True)
             .select(F.col("_metadata.file_path").alias("dump_id"), F.col("value").alias("text"),
                     F.col("_metadata.file_modification_time").alias("ts")))
    values = with_dump_value(dumps, "text", "lx").where(F.col("lx").isNotNull())
    device = F.lit(sensor_id) if sensor_id else F.regexp_extract("dump_id", "([^/]+)/[^/]+$", 1)
    readings = values.select(device.alias("sensor_id"), "ts", "lx", "dump_id")
    version_of = _versions()
    changed = on_change_stream(readings, "sensor_id", ["ts", "dump_id"], "lx")
    return streams.start(
        changed, lambda b, e: write_readings(b.drop("dump_id"), readings_path, write_id=version_of(e)),
        name, mode="append", available_now=available_now, checkpoint=checkpoint)


#: Epoch seconds that are a time of the years 1 to 9999.
CALENDAR_S = (-62_135_596_800, 253_402_300_799)


def stream_payload_readings(spark: SparkSession, bodies_dir: str, readings_path: str,
                            points_path: str, name: str = "payload_readings",
                            files_per_trigger: int = 100, available_now: bool = False,
                            checkpoint: str | None = None, rejects_path: str | None = None) -> StreamingQuery:
    """Reading request bodies (JSON lines ``{id?, time_sec, lx}``) -> readings
    table (K6) and points table (K5), both tried for every micro-batch (K7).

    ``time_sec`` is float epoch seconds: the reading time is rounded to the
    microsecond, the point keeps ns as BIGINT next to it (NULL beyond its
    range). Bodies that give no reading go to ``rejects_path`` (F4) as ``raw`` and
    ``reason``, one partition ``version`` per micro-batch that a replay replaces:
    readings and rejects together are the bodies.
    """
    from ..operators.messages import flag_payload

    bodies = (spark.readStream.schema("body string")
              .option("maxFilesPerTrigger", files_per_trigger).text(bodies_dir)
              .withColumnRenamed("value", "body"))
    t = F.col("time_sec")
    reason = F.coalesce("reason", F.when(~t.between(*CALENDAR_S), F.lit("bad:time_sec")))
    rows = flag_payload(bodies, "reading").withColumn("reason", reason)
    us = F.when(F.col("reason").isNull(), F.round(t * F.lit(1e6)).cast("bigint"))
    readings = rows.select("sensor_id", F.timestamp_micros(us).alias("ts"), "lx",
                           (t * F.lit(1e9)).try_cast("bigint").alias("time_ns"), "raw", "reason")

    version_of = _versions()

    def sinks(batch: DataFrame, epoch_id: int) -> None:
        version = version_of(epoch_id)
        good = batch.where(F.col("reason").isNull()).drop("raw", "reason")
        outs = [
            lambda d: write_readings(good.drop("time_ns"), readings_path, write_id=version),
            lambda d: write_points(
                good.select(F.col("sensor_id").alias("measurement"), F.lit("lx").alias("field"),
                            F.col("lx").alias("value"), F.col("ts").alias("time"), "time_ns"),
                points_path, version, precision="us"),
        ]
        if rejects_path:
            outs.append(lambda d: (
                batch.where(F.col("reason").isNotNull()).select("raw", "reason", F.lit(epoch_id).alias("version"))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(rejects_path)))
        fan_out(batch, outs)
    return streams.start(readings, sinks, name, mode="append", available_now=available_now,
                         checkpoint=checkpoint)


def payload_messages(bodies: DataFrame, kind: str, topic: str, body: str = "body",
                     now: Column | None = None) -> DataFrame:
    """Gyroscope / location request bodies -> topic message rows.

    Missing or NULL fields take the ingest defaults (time: ``now``, values: 0);
    the gyroscope magnitude is computed here. Works on a batch or a stream.
    """
    from ..operators.messages import parse_payload
    rows = parse_payload(bodies, kind, body, now)
    ts_ms = F.unix_millis("zeit")
    if kind == "gyro":
        msg = encode({"ts_ms": ts_ms, "gx": "gx", "gy": "gy", "gz": "gz",
                      "absolute": "absolute"}, "server_gyro")
    elif kind == "location":
        msg = encode({"ts_ms": ts_ms, "lat": "lat", "lon": "lon", "alt": "alt",
                      "speed": "speed"}, "server_location")
    else:
        raise ValueError(f"no message layout for payload kind {kind!r}")
    return as_messages(rows, msg, topic)
