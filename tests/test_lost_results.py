"""Results that an earlier version lost, invented, repeated or undercounted."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest

from conftest import rows
from sensorflow import session
from sensorflow.functions import parse, timestamps
from sensorflow.functions.text import normalise_line
from sensorflow.operators import clean, series
from sensorflow.operators.counts import outcome_counts
from sensorflow.operators.extract import extract_readings, extract_readings_long, explode_lines, long_rejects
from sensorflow.operators.messages import flag_payload, parse_gyro, parse_location, parse_payload, payload_rejects
from sensorflow.operators.windows import track_summary
from sensorflow.plans import jobs
from sensorflow.sinks import tables as sinks
from sensorflow.sources import files
from sensorflow.sources import tables as sources
from sensorflow.sources.messages import as_messages, publish_stream, read_messages, write_messages
from sensorflow.streaming import streams
from pyspark.sql import functions as F

T0 = dt.datetime(2024, 1, 5, 12, 0, 0)
POINT = "measurement string, field string, value double, time timestamp"
READING = "sensor_id string, ts timestamp, lx double"
WINDOW = "fenster_start timestamp, fenster_ende timestamp, avg_absolute double, avg_gx double, avg_gy double, avg_gz double, n_samples bigint"


def _points(spark, value):
    return spark.createDataFrame([("m", "f", value, T0)], POINT)


def _window(spark, n):
    return spark.createDataFrame([(T0, T0 + dt.timedelta(seconds=1), 1.0, 0.0, 0.0, 0.0, n)], WINDOW)


def test_second_write_of_a_point_wins(spark, tmp):
    sinks.write_points(_points(spark, 1.0), tmp, 1)
    sinks.write_points(_points(spark, 2.0), tmp, 2)
    got = sources.read_points(spark, tmp, T0, T0 + dt.timedelta(seconds=1), "m", "f")
    assert rows(got, "value") == [(2.0,)]


def test_replayed_write_adds_nothing(spark, tmp):
    points, readings = os.path.join(tmp, "p"), os.path.join(tmp, "r")
    df = spark.createDataFrame([("light", T0, 1.0)], READING)

    def attempt(fail):
        def bad(_):
            if fail:
                raise RuntimeError("sink down")
        sinks.fan_out(df, [
            lambda d: sinks.write_points(d.selectExpr("sensor_id measurement", "'lx' field", "lx value", "ts time"), points, 7),
            lambda d: sinks.write_readings(d, readings, 7), bad])

    with pytest.raises(RuntimeError):
        attempt(True)
    attempt(False)
    assert spark.read.parquet(points).count() == 1
    assert spark.read.parquet(readings).count() == 1


def test_partition_read_returns_current_readings(spark, tmp):
    sinks.write_readings(spark.createDataFrame([("light", T0, 1.0), ("other", T0, 5.0)], READING), tmp, 1)
    sinks.write_readings(spark.createDataFrame([("light", T0, 9.0)], READING), tmp, 2)
    assert rows(sources.read_partition(spark, tmp, "light", T0.date()), "lx") == [(9.0,)]


def test_repeated_key_in_one_write_is_deterministic(spark, tmp):
    df = spark.createDataFrame([("light", T0, float(v)) for v in (3, 9, 1)], READING)
    sinks.write_readings(df.repartition(3), tmp, 1)
    assert rows(sinks.read_readings(spark, tmp), "lx") == [(9.0,)]


def test_new_checkpoint_does_not_serve_stale_windows(spark, tmp):
    sinks.upsert_batch(_window(spark, 1), 7, tmp, "k", None, run_id=100)
    sinks.upsert_batch(_window(spark, 2), 0, tmp, "k", None, run_id=200)  # epochs begin again
    assert rows(sources.read_latest(spark, tmp, "k", T0), "n_samples") == [(2,)]


def test_superseded_versions_are_dropped_while_a_view_is_read(spark, tmp):
    live, comp = os.path.join(tmp, "live"), os.path.join(tmp, "comp")
    for epoch, n in ((0, 1), (1, 2), (2, 3)):
        sinks.upsert_batch(_window(spark, n), epoch, live, "k", None, run_id=5)
    sinks.compact_latest(spark, live, comp, upto_epoch=1, upto_run=5)
    spark.sql("CREATE DATABASE IF NOT EXISTS sfdemo")
    sinks.publish_latest(spark, "sfdemo.lost_view", comp, live, 1, 5)
    reader = sources.read_latest(spark, "sfdemo.lost_view", "k", T0)
    assert sinks.drop_versions(spark, live, 1, 5) == 2
    assert rows(reader, "n_samples") == [(3,)]
    assert sinks.drop_versions(spark, live, 1, 5) == 0


def test_bad_bodies_are_rejects(spark):
    bodies = ["not json", '{"time": 1000, "x": "abc"}', '{"time": 1000, "x": null, "y": "2.5"}', "", "[1, 2]", None,
              '{"time": 1700000000000000000, "x": 1}', '{"x": 1e999}', '{"x": 1']
    df = spark.createDataFrame([(b,) for b in bodies], "body string")
    good = parse_payload(df, "gyro").select("gx", "gy", "gz", "absolute").collect()
    assert [tuple(r) for r in good] == [(0.0, 2.5, 0.0, 2.5)]
    bad = {r["raw"]: r["reason"] for r in payload_rejects(df, "gyro").collect()}
    assert bad == {"not json": "bad:json", bodies[1]: "bad:x", "": "empty", "[1, 2]": "bad:json", None: "empty",
                   bodies[6]: "bad:time", bodies[7]: "bad:x", bodies[8]: "bad:json"}
    reading = spark.createDataFrame([('{"time_sec": 1.5, "lx": 2}',), ('{"lx": 2}',), ('{"time_sec": 1, "lx": "x"}',)], "body string")
    assert [r["reason"] for r in flag_payload(reading, "reading").collect()] == [None, "bad:time_sec", "bad:lx"]


def test_nanoseconds_as_milliseconds_are_rejects(spark):
    ns = "1700000000000000000"
    gyro = spark.createDataFrame([(f"{ns},1,1,1,1",), ("1700000000000,1,1,1,1",)], "value string")
    ok, bad = parse_gyro(gyro)
    assert ok.count() == 1 and rows(bad, "reason") == [("bad:time",)]
    loc = spark.createDataFrame([(f"{ns},1,1,1,1",), (f"{ns},1,1,1,1,1",), ("1700000000000,1,1,1,1",)], "value string")
    ok, bad = parse_location(loc, resolution="ms")
    assert ok.count() == 1 and rows(bad, "reason") == [("bad:time",)] * 2


def test_not_finite_times_do_not_abort(spark, tmp):
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("1e300",), ("1.5",), (None,)], "t string")
    got = df.select(parse.event_time_s("t").alias("a"), timestamps.rebase("t", 10.0).alias("b"),
                    timestamps.from_epoch(F.col("t").try_cast("double").try_cast("bigint"), "s").alias("c")).collect()
    assert [r["b"] for r in got] == [None, None, None, 11500, None]
    assert [r["a"] is None for r in got] == [True, True, True, False, True]
    light = os.path.join(tmp, "light.csv")
    with open(light, "w") as f:
        f.write("time,lx\nNaN,1\n1700000000000000000,NaN\n1700000000000000000,2.5\n")
    kept, bad = files.read_light_csv(spark, light)
    assert rows(kept, "lx") == [(2.5,)] and rows(bad, "reason") == [("bad:lx",), ("bad:time",)]
    gyro = os.path.join(tmp, "gyro.csv")
    with open(gyro, "w") as f:
        f.write("t;x;y;z;a\nNaN;1;1;1;1\n0,5;NaN;1;1;1\n0,5;2;1;1;1\n")
    win, bad = jobs.batch_gyro(spark, gyro, 1_700_000_000)
    assert rows(win, "avg_gx", "n_samples") == [(2.0, 1)]
    assert rows(bad, "reason") == [("bad:gx",), ("bad:time_s",)]
    rel = spark.createDataFrame([(float("nan"),), (0.5,), (1.0,), (None,)], "t double")
    assert rows(clean.skip_warmup(rel, "t", 1)) == [(1.0,)]
    assert rows(clean.skip_warmup(rel, "t", 0)) == [(0.5,), (1.0,)]


def test_weighted_mean_uses_the_values_behind_each_mean(spark):
    walk = [(f"{1704456000000 + i},47,8,1,1",) for i in range(9)]
    fit = [("1704456000009,47,8,1,100,20",), ("1704456002000,47,8,1,200,20",)]
    win = jobs.track_windows(spark.createDataFrame(walk + fit, "value string"))
    assert "speed_mean" in win.columns
    got = track_summary(win, ["hr_mean", "speed_mean"]).first()
    assert (got["hr_mean_weighted"], got["speed_mean_weighted"]) == (150.0, 1.0)


def test_null_series_keys(spark):
    df = spark.createDataFrame([(None, T0, 1), ("a", T0, 2), (None, T0 - dt.timedelta(days=1), 3)], "k string, ts timestamp, id int")
    assert rows(series.trailing(df, "ts", "1 hour", by="k"), "id") == [(1,), (2,)]
    new = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, id int")
    assert rows(series.unseen(new, df, "k"), "id") == [(3,)]


def test_anchored_sensor_pattern(spark):
    text = "accel\nlight\nvalue: 3"
    ok, bad = extract_readings(spark.createDataFrame([(text,)], "text string"), sensor_pattern="^light")
    assert rows(ok, "value") == [(3.0,)] and bad.count() == 0
    dumps = spark.createDataFrame([(1, text), (2, "nothing")], "dump_id int, text string")
    lines = explode_lines(dumps)
    values = extract_readings_long(lines, sensor_pattern="^light$")
    assert rows(values, "dump_id", "value") == [(1, 3.0)]
    assert rows(long_rejects(lines, values), "dump_id", "reason") == [(2, "no sensor value")]


def test_a_bad_field_does_not_shift_the_line(spark):
    df = spark.createDataFrame([("1,5;x;2,5",), ("1,5;2,5",), ("1;;2",), (None,)], "l string")
    assert [r[0] for r in df.select(normalise_line("l")).collect()] == [None, "1.5,2.5", None, None]
    kept, bad = clean.normalise_lines(df, "l")
    assert rows(kept, "l") == [("1.5,2.5",)]
    assert sorted(r["reason"] for r in bad.collect()) == ["bad:number", "bad:number", "empty"]


def test_counts_in_one_pass(spark):
    df = spark.createDataFrame([(None,), ("bad:x",), ("bad:x",)], "reason string")
    assert rows(outcome_counts(df), "outcome", "n") == [("bad:x", 2), ("kept", 1)]
    assert rows(outcome_counts(df.where("reason is not null")), "outcome", "n") == [("bad:x", 2), ("kept", 0)]


def test_late_rows_are_counted_beyond_the_retained_reports(spark, tmp):
    src = os.path.join(tmp, "src")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(8):  # the newest first; its watermark holds from the batch after the next on
            sec = 3600 if i == 0 else i
            spark.createDataFrame([(T0 + dt.timedelta(seconds=sec), 1.0)], "zeit timestamp, v double").coalesce(1).write.mode("append").parquet(src)
            time.sleep(0.05)
        stream = spark.readStream.schema("zeit timestamp, v double").option("maxFilesPerTrigger", 1).parquet(src)
        win = stream.withWatermark("zeit", "1 second").groupBy(F.window("zeit", "1 second")).count()
        q = streams.start(win, "noop", "late_all", available_now=True, checkpoint=os.path.join(tmp, "ck"))
        q.awaitTermination()
        retained = sum(op.numRowsDroppedByWatermark for p in q.recentProgress for op in p.stateOperators)
        deadline = time.time() + 20
        while streams.dropped_late_rows(q) < 6 and time.time() < deadline:
            time.sleep(0.2)
        assert streams.dropped_late_rows(q) == 6 > retained
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_missing_checkpoint_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local[2]"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_publish_from_a_stream(spark, tmp):
    bodies = os.path.join(tmp, "bodies")
    spark.createDataFrame([('{"time": 1000, "x": 1}',), ("broken",)], "value string").write.text(bodies)
    stream = spark.readStream.schema("body string").text(bodies).withColumnRenamed("value", "body")
    out = os.path.join(tmp, "topics")
    q = publish_stream(jobs.payload_messages(stream, "gyro", "gyro"), "pub", "gyro", fmt="files", path=out,
                       available_now=True, checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    got = read_messages(spark, "gyro", fmt="files", path=out, stream=False)
    assert got.where("offset is not null").count() == 1
    batch = as_messages(spark.range(5), F.col("id"), "t")
    write_messages(batch, "t", fmt="files", path=out)
    assert read_messages(spark, "t", fmt="files", path=out, stream=False).select("offset").distinct().count() == 5


def test_rejects_of_the_window_jobs(spark):
    gyro = spark.createDataFrame([("x",), ("1700000000000,1,1,1,1",)], "value string")
    assert rows(jobs.gyro_rejects(gyro), "raw", "reason") == [("x", "fields<5")]
    loc = spark.createDataFrame([("1700000000000,95,8,1,1",), ("1,2",), ("1700000000000,45,8,1,1",)], "value string")
    assert rows(jobs.track_rejects(loc), "reason") == [("coords out of range",), ("fields=2",)]


def test_each_device_folder_is_its_own_series(spark, tmp):
    for device in ("a", "b"):
        os.makedirs(os.path.join(tmp, "dumps", device))
        with open(os.path.join(tmp, "dumps", device, "1.txt"), "w") as f:
            f.write("light\nvalue: 4\n")
    out = os.path.join(tmp, "out")
    q = jobs.stream_dump_readings(spark, os.path.join(tmp, "dumps"), out, available_now=True, checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    assert rows(sinks.read_readings(spark, out), "sensor_id", "lx") == [("a", 4.0), ("b", 4.0)]


def test_window_stream_needs_a_table_or_memory(spark):
    src = spark.readStream.format("rate").load().selectExpr("cast(value as string) value")
    with pytest.raises(ValueError, match="path"):
        jobs.stream_gyro(src)
