"""File scans with the FIXTURES.md cases (invented sample values)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from conftest import rows
from sensorflow.operators import clean
from sensorflow.operators.extract import (explode_lines, extract_readings,
                                          extract_readings_long)
from sensorflow.sources import files
from sensorflow.sources.tables import normalise_fit
from sensorflow import schemas


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


GYRO = ('"t";"x";"y";"z";"abs"\n'
        "0,25;0,5;-0,25;1,0;1,145644\n"
        "1,0;1,25E-2;0,0;0,0;0,0125\n"
        "1,75;2,0;1,0;2,0;3,0\n"
        "x;1,0;1,0;1,0;1,7\n")


def test_gyro_csv_decimal_comma_and_rejects(spark, tmp):
    kept, rejects = files.read_sensor_csv(spark, _write(tmp, "g.csv", GYRO))
    assert rows(kept, "time_s", "gx", "gy") == [(0.25, 0.5, -0.25), (1.0, 0.0125, 0.0),
                                                (1.75, 2.0, 1.0)]
    assert rows(rejects) == [("x;1,0;1,0;1,0;1,7", "bad:time_s")]
    # warm-up: int(t) > 0 keeps t = 1.0 and 1.75, drops 0.25
    assert rows(clean.skip_warmup(kept, "time_s"), "time_s") == [(1.0,), (1.75,)]


WALK = ('"Time (s)","Latitude (°)","Longitude (°)","Altitude (m)","Altitude WGS84 (m)",'
        '"Speed (m/s)","Direction (°)","Distance (km)","Horizontal Accuracy (m)",'
        '"Vertical Accuracy (m)","Satellites"\n'
        "0.0,4.71E1,8.5,400.0,450.0,1.5,90,0.0,5,3,7\n"
        "1.0,NaN,8.5,400.0,450.0,1.5,90,0.0,5,3,7\n"
        "2.0,47.1,8.5,null,450.0,NaN,90,0.0,5,3,7\n"
        "3.0,47.1,8.5,400,450\n"
        "4.0,abc,8.5,400,450,1.0,90,0,5,3,7\n"
        "5.0,90,-180,400,450,1.0,90,0,5,3,7\n"
        "6.0,90.01,8.5,400,450,1.0,90,0,5,3,7\n"
        "36.0,47.2,8.6,401,451,1.2,90,0,5,3,7\n")


def test_walk_csv_tokens_short_rows_and_rejects(spark, tmp):
    kept, rejects = files.read_walk_csv(spark, _write(tmp, "w.csv", WALK))
    got = rows(kept, "time_s", "lat", "alt", "speed")
    assert got[0] == (0.0, 47.1, 400.0, 1.5)
    assert (2.0, 47.1, None, None) in got
    reasons = dict(rows(rejects, "raw", "reason"))
    assert reasons["1.0,NaN,8.5,400.0,450.0,1.5,90,0.0,5,3,7"] == "missing"
    assert reasons["3.0,47.1,8.5,400,450"] == "fields<6"
    assert reasons["4.0,abc,8.5,400,450,1.0,90,0,5,3,7"] == "bad:lat"
    filled = clean.fill_zero(kept, ["alt", "speed"])
    assert rows(filled.where("time_s = 2.0"), "alt", "speed") == [(0.0, 0.0)]
    valid = clean.valid_coords(kept)
    assert rows(valid.where("time_s >= 5"), "time_s") == [(5.0,), (36.0,)]


def test_walk_gap_with_replay_factor(spark, tmp):
    from sensorflow.operators.series import sample_gap
    kept, _ = files.read_walk_csv(spark, _write(tmp, "w.csv", WALK))
    t = kept.withColumn("ts", F.timestamp_seconds(F.col("time_s").cast("bigint") + 1_700_000_000))
    gaps = sample_gap(t, None, ["ts"], "ts", factor=5.0, bucket=None)
    got = dict(rows(gaps, "time_s", "pause_s"))
    assert got[2.0] == 0.4          # 2 s / 5
    assert got[36.0] == 0.0         # 30 s / 5 = 6 s: outside (0, 5), not paced


LIGHT = "time_ns,lx\n0,5\n0.0,6\n1700000000123456789,12.5\n1700000001000000000,bad\n"


def test_light_csv_text_zero_and_ns(spark, tmp):
    kept, rejects = files.read_light_csv(spark, _write(tmp, "l.csv", LIGHT))
    got = rows(kept, "time_ns", "lx")
    assert got == [(0, 6.0), (1700000000123456789, 12.5)]
    t = kept.where("lx = 12.5").select("time").first()[0]
    assert t == dt.datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert rows(rejects, "reason") == [("bad:lx",)]


DUMPS = {
    "case1": "Sensor List:\naccel vendor x=1\nLight Sensor | handle 3\n  mode: continuous\n"
             "  value: 12.5\n",
    "case2": "Illuminance (wake)\nrecent events:\n  [ 77.0, 0]\n",
    "case3": "accelerometer\nvalue: 3\n",
    "case4": "light sensor A\n" + "  ...\n" * 30 + "  value: 999\nlight sensor B\nlx = 4\n",
    "case5": "light sensor\nevents:\n  [ 5.0 ]\n  data = 7\n",
}
EXPECTED = {"case1": 12.5, "case2": 77.0, "case4": 4.0, "case5": 7.0}


def test_dump_extraction_both_forms(spark, tmp):
    d = os.path.join(tmp, "dumps")
    os.makedirs(d)
    for k, v in DUMPS.items():
        _write(d, k + ".txt", v)
    dumps = files.read_dumps(spark, d).withColumn(
        "case", F.regexp_extract("dump_id", r"(case\d)", 1))
    ok, rejects = extract_readings(dumps)
    assert dict(rows(ok, "case", "value")) == EXPECTED
    assert rows(rejects, "case") == [("case3",)]
    long = extract_readings_long(explode_lines(dumps, "case", "text"), dump="case")
    assert dict(rows(long, "case", "value")) == EXPECTED


def test_fit_records_semicircles(spark):
    recs = spark.createDataFrame([
        (dt.datetime(2024, 1, 1, 0, 0, 0), 1073741824, 0, 410.0, 95, 21),
        (dt.datetime(2024, 1, 1, 0, 0, 1), 1073741825, 0, 410.0, 96, 21),
        (dt.datetime(2024, 1, 1, 0, 0, 2), None, 0, 410.0, 97, 21),
        (dt.datetime(2024, 1, 1, 0, 0, 3), 536870912, 536870912, None, None, None),
    ], schemas.FIT_RECORD)
    kept, rejects = normalise_fit(recs, fill_zero=True)
    assert rows(kept, "lat", "lon", "hr") == [(45.0, 45.0, 0.0), (90.0, 0.0, 95.0)]
    assert rows(rejects, "reason") == [("coords out of range",), ("missing:time,lat,lon",)]


def test_dump_lines_numbered_across_splits(spark, tmp):
    d = os.path.join(tmp, "big_dumps")
    os.makedirs(d)
    body = "\n".join(f"line {i}" for i in range(400)) + "\nLight sensor\n  value: 42\n"
    _write(d, "a.txt", body)
    _write(d, "b.txt", "\n".join(f"x{i}" for i in range(50)) + "\nilluminance\nevents\n  [ 7 ]\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")  # many splits per file
    try:
        lines = files.read_dump_lines(spark, d)
        assert lines.rdd.getNumPartitions() > 4
        got = {(r["dump_id"].rsplit("/", 1)[-1], r["line_no"]): r["line"] for r in lines.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got[("a.txt", 0)] == "line 0" and got[("a.txt", 399)] == "line 399"
    assert got[("a.txt", 400)] == "Light sensor" and got[("b.txt", 50)] == "illuminance"
    assert len([k for k in got if k[0] == "a.txt"]) == 402
    vals = extract_readings_long(files.read_dump_lines(spark, d))
    assert sorted(r["value"] for r in vals.collect()) == [7.0, 42.0]


def test_extraction_forms_equal_sql_on_random_dumps(spark):
    import random
    rnd = random.Random(5)
    pieces = ["filler text", "Light Sensor", "ILLUMINANCE meter", "recent events:", "  [ 3.5, 1]",
              "  value: 12", "lx = 7.25", "reading = [ -2 ]", "x=1", "event log", "data: [ 9",
              "accel", "  last value = 4", "[ 8 ]", ""]
    dumps = []
    for d in range(300):
        n = rnd.randint(1, 80)
        dumps.append((d, "\n".join(rnd.choice(pieces) for _ in range(n))))
    df = spark.createDataFrame(dumps, "dump_id int, text string")
    # oracle: the same rule in DuckDB SQL (list functions), run on the same texts
    import duckdb
    import pandas as pd
    from sensorflow.plans.oracle import extract_sql
    con = duckdb.connect()
    con.register("random_dumps", pd.DataFrame(dumps, columns=["event_id", "text"]))
    res = con.execute(extract_sql("(select event_id, text from random_dumps)")).fetchall()
    want = {d: v for d, v in res}
    from sensorflow.operators.extract import with_dump_value
    arr = {r["dump_id"]: r["value"] for r in with_dump_value(df).collect()}
    assert arr == want
    lng = {r["dump_id"]: r["value"] for r in extract_readings_long(explode_lines(df)).collect()}
    assert lng == {d: v for d, v in want.items() if v is not None}
