"""End-to-end jobs on the FIXTURES.md samples."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from sensorflow import schemas
from sensorflow.operators.messages import parse_location
from sensorflow.plans import jobs
from sensorflow.sinks.tables import read_readings
from sensorflow.sources.messages import read_messages, write_messages
from sensorflow.sources.tables import read_latest, read_points
from test_sources import GYRO, LIGHT, WALK, _write

START = 1_700_000_000  # 2023-11-14 22:13:20 UTC


def test_batch_gyro_one_aggregate(spark, tmp):
    win, rejects = jobs.batch_gyro(spark, _write(tmp, "g.csv", GYRO), START)
    got = [(r["elapsed_s"], r["avg_gx"], r["n_samples"]) for r in win.collect()]
    assert got == [(0.0, 0.5, 1), (1.0, (0.0125 + 2.0) / 2, 2)]
    assert rejects.count() == 1


def test_gyro_points_counts_include_warmup(spark, tmp):
    out = os.path.join(tmp, "points")
    counts = jobs.gyro_points(spark, _write(tmp, "g.csv", GYRO), START, out)
    assert counts == {"rows": 3, "warmup": 1, "points": 8, "rejects": 1}
    t0 = dt.datetime(2023, 11, 14, 22, 13, 21)
    got = read_points(spark, out, t0, t0 + dt.timedelta(seconds=1), "gyro_abs", "abs")
    assert rows(got, "value") == [(0.0125,), (3.0,)]


def test_light_readings_to_both_tables(spark, tmp):
    rp, pp = os.path.join(tmp, "readings"), os.path.join(tmp, "points")
    jobs.light_readings(spark, _write(tmp, "l.csv", LIGHT), START + 100, rp, pp, write_id=1)
    got = rows(read_readings(spark, rp), "ts", "lx")
    assert got[-1] == (dt.datetime(2023, 11, 14, 22, 15, 0), 12.5)
    assert spark.read.parquet(pp).count() == 2


def test_walk_messages_parse_back(spark, tmp):
    msgs, pauses, counts = jobs.walk_messages(spark, _write(tmp, "w.csv", WALK), START)
    parsed, bad = parse_location(msgs)
    assert bad.count() == 0
    got = rows(parsed.where("lat = 47.1"), "kind", "alt", "speed")
    assert got == [("walk", 0.0, 0.0), ("walk", 400.0, 1.5)]  # null alt / NaN speed -> 0
    # kept: t = 0, 2, 5, 6 (lat 90.01 is dropped later by the coordinate filter), 36
    assert dict(rows(counts, "outcome", "n")) == {"kept": 5, "missing": 1, "fields<6": 1,
                                                  "bad:lat": 1}
    assert rows(pauses.where("time_s = 36.0"), "pause_s") == [(0.0,)]


def test_fit_messages_use_record_time(spark):
    recs = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 5), 536870912, 0, 410.0, 95, 21)], schemas.FIT_RECORD)
    msgs, _ = jobs.fit_messages(recs)
    assert msgs.select(F.col("value").cast("string")).first()[0] == \
        "1704067205000,45.00000000,0.00000000,410.00,95,21.0"


def test_track_view_layers(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from sensorflow.plans.queries import location_messages
    win = jobs.track_windows(location_messages(spark, SF_SMALL))
    layers = jobs.track_view(win)
    n = layers["points"].count()
    assert n > 0 and layers["segments"].count() == n - 1
    assert layers["summary"].first()["n_windows"] == n
    shown = layers["points"].limit(5).select("fenster_start")
    assert jobs.track_view(win, shown)["points"].count() == n - 5
    assert ev.count() > n


def test_serve_latest_stream_and_read(spark, tmp):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    from sensorflow.functions.formats import encode
    from sensorflow.sources.messages import as_messages
    msg = encode({"ts_ms": F.unix_millis(F.col("ts").cast("timestamp")), "gx": "value",
                  "gy": "user_id", "gz": F.lit(0.0), "absolute": "value"}, "gyro")
    write_messages(as_messages(ev, msg, "gyro"), "gyro", fmt="files", path=os.path.join(tmp, "topics"))
    src = read_messages(spark, "gyro", fmt="files", path=os.path.join(tmp, "topics"))
    q = jobs.serve_latest(src, os.path.join(tmp, "latest"), "sensor:gyro", ttl_s=None,
                          available_now=True, checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    table = spark.read.parquet(os.path.join(tmp, "latest"))
    assert table.select("key").distinct().count() == ev.select(F.date_trunc("second", "ts")).distinct().count()
    live = read_latest(spark, os.path.join(tmp, "latest"), "sensor:gyro", dt.datetime(2030, 1, 1))
    assert live.count() == table.select("key").distinct().count()  # no TTL: never expires


def test_dump_readings_on_change(spark, tmp):
    d = os.path.join(tmp, "dumps")
    os.makedirs(d)
    for i, v in enumerate(["12.5", "12.5", "13", "x"]):
        p = _write(d, f"d{i}.txt", f"Light sensor\n  value: {v}\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    changed, rejects = jobs.dump_readings(spark, d)
    assert rows(changed, "lx") == [(12.5,), (13.0,)]
    assert rejects.count() == 1


def test_live_gyro_table_and_chart(spark, tmp):
    """L2: topic -> window table in memory -> SQL chart of the last 2 minutes."""
    base = 1_700_000_000_000
    texts = [f"{base + 1000 * s},{s % 3}.0,0.5,0.25,1.0" for s in range(0, 600, 2)]
    msgs = spark.createDataFrame([(t,) for t in texts], "value string")
    write_messages(as_messages_df(msgs), "gyro", fmt="files", path=os.path.join(tmp, "t"))
    src = read_messages(spark, "gyro", fmt="files", path=os.path.join(tmp, "t"))
    q = jobs.stream_gyro(src, "gyro_results_test", memory=True, available_now=True,
                         checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    assert spark.sql("SELECT count(*) FROM gyro_results_test").first()[0] == 300
    chart = jobs.gyro_chart(spark, "gyro_results_test", minutes=2)
    starts = [r["fenster_start"] for r in chart.collect()]
    assert len(starts) == 61 and starts == sorted(starts)  # windows within 120 s of the newest


def test_live_track_table(spark, tmp):
    from sensorflow.plans.queries import geo_location_messages
    src_df = geo_location_messages(spark, SF_SMALL)
    write_messages(as_messages_df(src_df), "location", fmt="files", path=os.path.join(tmp, "t"))
    src = read_messages(spark, "location", fmt="files", path=os.path.join(tmp, "t"))
    q = jobs.stream_track(src, "track_test", memory=True, available_now=True, checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    batch = jobs.track_windows(src_df)
    assert spark.table("track_test").count() == batch.count()


def as_messages_df(df):
    from sensorflow.sources.messages import as_messages
    return as_messages(df, F.col("value").cast("string"), "t")


def test_stream_dump_readings(spark, tmp):
    d = os.path.join(tmp, "dumps")
    os.makedirs(d)
    vals = ["12.5", "12.5", "13", "x", "13", "9"]
    for i, v in enumerate(vals):
        p = _write(d, f"d{i}.txt", f"Light sensor\n  value: {v}\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    out = os.path.join(tmp, "readings")
    q = jobs.stream_dump_readings(spark, d, out, sensor_id="light", files_per_trigger=2, available_now=True,
                                  checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    got = rows(read_readings(spark, out), "ts", "lx")
    assert [v for _, v in got] == [12.5, 13.0, 9.0]


def test_stream_payload_readings(spark, tmp):
    d = os.path.join(tmp, "bodies")
    os.makedirs(d)
    _write(d, "b0.json", '{"time_sec": 1700000000.25, "lx": 12.5}\n{"id": "gyro_x", "time_sec": "1700000001", "lx": "3"}\n')
    _write(d, "b1.json", '{"time_sec": 1700000002, "lx": null}\n{"lx": 4}\n{"time_sec": 1700086400, "lx": 7}\n')
    rp, pp = os.path.join(tmp, "readings"), os.path.join(tmp, "points")
    q = jobs.stream_payload_readings(spark, d, rp, pp, files_per_trigger=1, available_now=True,
                                     checkpoint=os.path.join(tmp, "ck"))
    q.awaitTermination()
    got = rows(read_readings(spark, rp), "sensor_id", "ts", "lx")
    assert got == [("gyro_x", dt.datetime(2023, 11, 14, 22, 13, 21), 3.0),
                   ("light", dt.datetime(2023, 11, 14, 22, 13, 20, 250000), 12.5),
                   ("light", dt.datetime(2023, 11, 15, 22, 13, 20), 7.0)]
    assert spark.read.parquet(pp).count() == 3
    assert {r[0] for r in spark.read.parquet(rp).select("day_bucket").distinct().collect()} == \
        {dt.date(2023, 11, 14), dt.date(2023, 11, 15)}


def test_stream_payload_readings_and_rejects_are_the_bodies(spark, tmp):
    d = os.path.join(tmp, "bodies")
    os.makedirs(d)
    good = ['{"time_sec": 1700000000.25, "lx": 12.5}', '{"id": "a", "time_sec": 253402300799, "lx": 1}', '{"time_sec": -5, "lx": 0}']
    bad = [('{"time_sec": 1700000002, "lx": null}', "bad:lx"), ('{"lx": 4}', "bad:time_sec"), ("not json", "bad:json"), ("[1]", "bad:json"),
           ('{"time_sec": 1e300, "lx": 4}', "bad:time_sec"), ('{"time_sec": 253402300801, "lx": 4}', "bad:time_sec"), ('{"time_sec": 1, "lx": "x"}', "bad:lx")]
    _write(d, "b0.json", "\n".join([good[0], bad[0][0], bad[1][0], bad[2][0]]) + "\n")
    _write(d, "b1.json", "\n".join([good[1], *[b for b, _ in bad[3:]], good[2]]) + "\n")
    rp, pp, xp = (os.path.join(tmp, x) for x in ("readings", "points", "rejects"))
    jobs.stream_payload_readings(spark, d, rp, pp, files_per_trigger=1, available_now=True, checkpoint=os.path.join(tmp, "ck"),
                                 rejects_path=xp).awaitTermination()
    assert sorted(r["lx"] for r in read_readings(spark, rp).collect()) == [0.0, 1.0, 12.5]
    assert rows(spark.read.parquet(xp), "raw", "reason") == sorted(bad)
    assert spark.read.parquet(pp).count() == 3


def test_payload_messages_round_trip(spark):
    from sensorflow.operators.messages import parse_gyro
    bodies = spark.createDataFrame([('{"time": 1700000000000, "x": 3, "y": 4}',), ('{}',)], "body string")
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    msgs = jobs.payload_messages(bodies, "gyro", "gyro", now=now)
    texts = sorted(r[0] for r in msgs.select(F.col("value").cast("string")).collect())
    assert texts == ["1700000000000,3.0,4.0,0.0,5.000000", "1704067200000,0.0,0.0,0.0,0.000000"]
    parsed, bad = parse_gyro(msgs)
    assert bad.count() == 0 and rows(parsed, "absolute") == [(0.0,), (5.0,)]
    loc = jobs.payload_messages(spark.createDataFrame([('{"time": 1, "lat": 47.5}',)], "body string"),
                                "location", "location")
    assert loc.select(F.col("value").cast("string")).first()[0] == "1,47.5,0.0,0.0,0.0"
