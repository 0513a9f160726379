"""Structured Streaming: late data per output mode, restart from checkpoint,
stream = batch for the stateful operators, keyed upsert stream."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sensorflow.operators import series
from sensorflow.operators.windows import window_stats
from sensorflow.sources.messages import as_messages, read_messages, write_messages
from sensorflow.operators.messages import parse_gyro
from sensorflow.streaming import state, streams

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
BATCHES = [[(0, 1.0), (30, 2.0)], [(31, 3.0)], [(0, 9.0), (25, 5.0), (30, 8.0)]]


def _write_batches(d, batches, start_mtime=1_000_000):
    os.makedirs(d, exist_ok=True)
    for i, b in enumerate(batches):
        p = os.path.join(d, f"b{i}.json")
        with open(p, "w") as f:
            for sec, v in b:
                f.write(json.dumps({"zeit": (T0 + dt.timedelta(seconds=sec)).isoformat(), "gx": v}) + "\n")
        os.utime(p, (start_mtime + i, start_mtime + i))


def _source(spark, d):
    return (spark.readStream.schema("zeit timestamp, gx double")
            .option("maxFilesPerTrigger", 1).json(d))


def _agg(df):
    return window_stats(df, "zeit", "1 second", {"v": "gx"}, count_of="gx",
                        watermark="10 seconds", end=None)


def _s(r):
    return ((r["fenster_start"] - T0).seconds, r["v"], r["n_samples"])


def test_late_rows_update_mode(spark, tmp):
    _write_batches(os.path.join(tmp, "in"), BATCHES)
    out = []
    q = streams.for_each_batch(_agg(_source(spark, os.path.join(tmp, "in"))), "late_update",
                               lambda b, e: out.append(sorted(_s(r) for r in b.collect())),
                               mode="update", available_now=True,
                               checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    assert out == [[(0, 1.0, 1), (30, 2.0, 1)], [(31, 3.0, 1)], [(25, 5.0, 1), (30, 5.0, 2)]]


def test_late_rows_complete_mode(spark, tmp):
    _write_batches(os.path.join(tmp, "in"), BATCHES)
    q = streams.to_memory(_agg(_source(spark, os.path.join(tmp, "in"))), "late_complete",
                          mode="complete", available_now=True, checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    got = sorted(_s(r) for r in spark.sql("SELECT * FROM late_complete").collect())
    assert got == [(0, 5.0, 2), (25, 5.0, 1), (30, 5.0, 2), (31, 3.0, 1)]


def test_late_rows_append_mode(spark, tmp):
    _write_batches(os.path.join(tmp, "in"), BATCHES)
    out = []
    q = streams.for_each_batch(_agg(_source(spark, os.path.join(tmp, "in"))), "late_append",
                               lambda b, e: out.extend(_s(r) for r in b.collect()),
                               mode="append", available_now=True, checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    assert out == [(0, 1.0, 1)]


def test_restart_from_checkpoint_equals_unbroken_run(spark, tmp):
    def run(src, ck, path):
        q = streams.upsert_stream(_agg(_source(spark, src)), f"ups_{abs(hash(ck))}", path,
                                  "sensor:gyro", ttl_s=None, available_now=True, checkpoint=ck)
        q.awaitTermination()

    _write_batches(os.path.join(tmp, "whole"), BATCHES)
    run(os.path.join(tmp, "whole"), os.path.join(tmp, "ck1"), os.path.join(tmp, "t1"))
    _write_batches(os.path.join(tmp, "parts"), BATCHES[:2])
    run(os.path.join(tmp, "parts"), os.path.join(tmp, "ck2"), os.path.join(tmp, "t2"))
    _write_batches(os.path.join(tmp, "parts3"), BATCHES[2:])
    os.rename(os.path.join(tmp, "parts3", "b0.json"), os.path.join(tmp, "parts", "b2.json"))
    os.utime(os.path.join(tmp, "parts", "b2.json"), (1_000_002, 1_000_002))
    run(os.path.join(tmp, "parts"), os.path.join(tmp, "ck2"), os.path.join(tmp, "t2"))

    def latest(p):
        return rows(series.latest_by_key(spark.read.parquet(p), "key", ["epoch_id"]),
                    "key", "v", "n_samples")
    assert latest(os.path.join(tmp, "t1")) == latest(os.path.join(tmp, "t2"))
    assert len(latest(os.path.join(tmp, "t1"))) == 4


def _events_by_day(spark, tmp):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    d = os.path.join(tmp, "ev")
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    for i, chunk in enumerate([days[:10], days[10:20], days[20:]]):
        part = ev.where(F.to_date("ts").isin(chunk))
        part.coalesce(1).write.mode("overwrite").parquet(os.path.join(d, f"p{i}"))
        time.sleep(0.05)
    return ev, d, ev.schema


def test_on_change_stream_equals_batch(spark, tmp):
    ev, d, schema = _events_by_day(spark, tmp)
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", True).parquet(d))
    q = streams.to_memory(state.on_change_stream(src, "event_type", ["ts", "event_id"], "value"),
                          "onchange_mem", mode="append", available_now=True,
                          checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    got = rows(spark.sql("SELECT event_id FROM onchange_mem"), "event_id")
    want = rows(series.on_change(ev, "event_type", ["ts", "event_id"], "value"), "event_id")
    assert got == want and len(got) > 900


def test_first_seen_stream_keeps_first_value(spark, tmp):
    ev, d, schema = _events_by_day(spark, tmp)
    src = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
           .option("recursiveFileLookup", True).parquet(d))
    q = streams.to_memory(state.first_seen_stream(src, "user_id", ["ts", "event_id"]),
                          "first_seen_mem", mode="append", available_now=True,
                          checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    got = rows(spark.sql("SELECT user_id, event_id FROM first_seen_mem"), "user_id", "event_id")
    first = series.last_k(ev, "user_id", [F.col("ts").asc(), F.col("event_id").asc()], 1)
    assert got == rows(first, "user_id", "event_id")


def test_topic_stand_in_end_to_end(spark, tmp):
    """K1 -> S4 -> parse -> windows: gyro messages through the file topic."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from sensorflow.functions.formats import encode
    msg = encode({"ts_ms": F.unix_millis(F.col("ts").cast("timestamp")), "gx": "value",
                  "gy": F.col("user_id"), "gz": F.lit(0.0), "absolute": "value"}, "gyro")
    write_messages(as_messages(ev, msg, "gyro"), "gyro", fmt="files", path=tmp)
    src = read_messages(spark, "gyro", fmt="files", path=tmp, max_per_trigger=1)
    parsed, _ = parse_gyro(src)
    q = streams.to_memory(window_stats(parsed, "zeit", "1 hour", ["gx"], count_of="gx",
                                       watermark="1 day"),
                          "gyro_topic_mem", mode="complete", available_now=True,
                          checkpoint=os.path.join(tmp, "ck"))
    streams.run_stream(q)
    got = spark.sql("SELECT sum(n_samples) n, count(*) w FROM gyro_topic_mem").first()
    assert got["n"] == ev.count()


def test_dropped_late_rows_are_counted(spark, tmp):
    _write_batches(os.path.join(tmp, "in"), BATCHES)
    q = streams.for_each_batch(_agg(_source(spark, os.path.join(tmp, "in"))), "late_count",
                               lambda b, e: None, mode="update", available_now=True,
                               checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    assert streams.dropped_late_rows(q) == 1  # the :00 row of the third file


def test_window_stream_equals_batch(spark, tmp):
    """Same rows as one batch and as three files in time order -> same windows."""
    rows_in = [(s, float(s % 7)) for s in range(0, 90, 3)]
    _write_batches(os.path.join(tmp, "in"), [rows_in[:10], rows_in[10:20], rows_in[20:]])
    q = streams.to_memory(_agg(_source(spark, os.path.join(tmp, "in"))), "eq_batch_mem",
                          mode="update", available_now=True, checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    streamed = sorted(_s(r) for r in spark.sql("SELECT * FROM eq_batch_mem").collect())
    batch_in = spark.read.schema("zeit timestamp, gx double").json(os.path.join(tmp, "in"))
    batch = window_stats(batch_in, "zeit", "1 second", {"v": "gx"}, count_of="gx", end=None)
    assert streamed == sorted(_s(r) for r in batch.collect())


def test_drop_repeated_samples(spark, tmp):
    rep = [[(0, 1.0), (1, 2.0)], [(1, 2.0), (2, 3.0)]]  # second file repeats :01
    _write_batches(os.path.join(tmp, "in"), rep)
    src = streams.drop_repeated(_source(spark, os.path.join(tmp, "in")), [], "zeit", "10 seconds")
    q = streams.to_memory(src, "dedup_mem", mode="append", available_now=True,
                          checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    assert spark.sql("SELECT count(*) FROM dedup_mem").first()[0] == 3


def test_table_sink_fan_out_and_bounded_topic_read(spark, tmp):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from sensorflow.functions.formats import encode
    msg = encode({"ts_ms": F.unix_millis(F.col("ts").cast("timestamp")), "gx": "value",
                  "gy": "user_id", "gz": F.lit(0.0), "absolute": "value"}, "gyro")
    topics = os.path.join(tmp, "topics")
    write_messages(as_messages(ev, msg, "gyro", key="user_id"), "gyro", fmt="files", path=topics)
    bounded = read_messages(spark, "gyro", fmt="files", path=topics, stream=False)
    assert bounded.count() == ev.count()
    # one user's messages share a partition number
    assert bounded.groupBy("key").agg(F.countDistinct("partition").alias("p")).where("p > 1").count() == 0

    src = read_messages(spark, "gyro", fmt="files", path=topics)
    parsed, _ = parse_gyro(src)
    q = streams.to_table(parsed, "parsed_table", os.path.join(tmp, "parsed"), available_now=True,
                         checkpoint=os.path.join(tmp, "ck1"))
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(tmp, "parsed")).count() == ev.count()

    seen = []
    q2 = streams.fan_out_stream(parsed, "fan", [
        lambda d, e: d.write.mode("append").parquet(os.path.join(tmp, "copy")),
        lambda d, e: seen.append(e)], available_now=True, checkpoint=os.path.join(tmp, "ck2"))
    q2.awaitTermination()
    assert spark.read.parquet(os.path.join(tmp, "copy")).count() == ev.count() and seen


def test_on_change_stream_restart_equals_batch(spark, tmp):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    days = sorted(r[0] for r in ev.select(F.to_date("ts")).distinct().collect())
    src_dir, out, ck = os.path.join(tmp, "src"), os.path.join(tmp, "out"), os.path.join(tmp, "ck")

    def add(i, chunk):
        ev.where(F.to_date("ts").isin(chunk)).coalesce(1).write.parquet(os.path.join(src_dir, f"p{i}"))
        time.sleep(0.05)

    def run():
        src = (spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1)
               .option("recursiveFileLookup", True).parquet(src_dir))
        q = streams.to_table(state.on_change_stream(src, "event_type", ["ts", "event_id"], "value"),
                             "onchange_restart", out, available_now=True, checkpoint=ck)
        q.awaitTermination()

    add(0, days[:15])
    run()                      # first run, then the query is gone (as after a failure)
    add(1, days[15:])
    run()                      # restart: state and progress come from the checkpoint
    got = rows(spark.read.parquet(out), "event_id")
    want = rows(series.on_change(ev, "event_type", ["ts", "event_id"], "value"), "event_id")
    assert got == want


def test_start_dispatches_sinks(spark, tmp):
    _write_batches(os.path.join(tmp, "in"), BATCHES)
    agg = _agg(_source(spark, os.path.join(tmp, "in")))
    q = streams.start(agg, "memory", "start_mem", mode="complete", available_now=True,
                      checkpoint=os.path.join(tmp, "ck1"))
    q.awaitTermination()
    assert spark.table("start_mem").count() == 4
    seen = []
    q = streams.start(agg, lambda b, e: seen.append(e), "start_fn", available_now=True,
                      checkpoint=os.path.join(tmp, "ck2"))
    q.awaitTermination()
    assert len(seen) == 3
    q = streams.start(agg, "noop", "start_noop", available_now=True, checkpoint=os.path.join(tmp, "ck3"))
    q.awaitTermination()
    assert q.lastProgress is not None


def test_first_seen_stream_with_expiry(spark, tmp):
    batches = [[(0, 1.0), (5, 2.0)], [(100, 3.0)], [(1, 9.0), (200, 4.0)]]
    _write_batches(os.path.join(tmp, "in"), batches)
    src = _source(spark, os.path.join(tmp, "in")).withColumn("k", F.lit("s")).withWatermark(
        "zeit", "10 seconds")
    q = streams.to_memory(state.first_seen_stream(src, "k", ["zeit"], expire_after_ms=30_000),
                          "first_seen_exp", mode="append", available_now=True,
                          checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    got = sorted((r["zeit"] - T0).seconds for r in spark.table("first_seen_exp").collect())
    # first row of the key, then -- after the key expired at :35 -- the next arrival
    # is new again; the late :01 row is below the watermark and never shown
    assert got[0] == 0 and 1 not in got and 5 not in got
