"""Message parsing, payloads and scalar functions (P1-P26 cases of FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from sensorflow.functions import formats, geo, parse, text, timestamps
from sensorflow.operators.messages import parse_gyro, parse_location, parse_payload


def _msgs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, value string")


def test_event_time_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1700000000750,), (-1500,), (None,)], "ms bigint")
    got = df.select(parse.event_time("ms").alias("s"), parse.event_time("ms", "ms").alias("m"))
    got = [tuple(r) for r in got.collect()]
    assert got[0] == (dt.datetime(2023, 11, 14, 22, 13, 20), dt.datetime(2023, 11, 14, 22, 13, 20, 750000))
    assert got[1][0] == dt.datetime(1969, 12, 31, 23, 59, 59)  # -1.5 s -> -1 s
    assert got[2] == (None, None)


def test_gyro_messages_and_rejects(spark):
    df = _msgs(spark, ["1700000000750,0.1,0.2,0.3,0.374166", "1700000001000,1,2,3",
                       "1700000002000,x,0,0,0", "", "abc,1,1,1,1"])
    ok, bad = parse_gyro(df, keep=("id",))
    assert rows(ok, "id", "gx", "absolute") == [(0, 0.1, 0.374166)]
    assert rows(bad, "id", "reason") == [(1, "fields<5"), (2, "bad:number"), (3, "empty"),
                                         (4, "bad:time")]


def test_location_layout_dispatch(spark):
    df = _msgs(spark, ["1700000000000,47.5,8.5,400.00,1.2500",
                       "1700000000000,47.5,8.5,400.00,95,21.5",
                       "1700000000000,NaN,8.5,400.00,1.0",
                       "1700000000000,47.5,8.5,400",
                       "1700000000000,47.5,x,400,1,2"])
    ok, bad = parse_location(df, keep=("id",))
    got = rows(ok, "id", "kind", "speed", "hr", "temp")
    assert got[0] == (0, "walk", 1.25, None, None)
    assert got[1] == (1, "fitness", None, 95.0, 21.5)
    # NaN parses; the coordinate filter drops it later
    assert got[2][:2] == (2, "walk")
    from sensorflow.operators.clean import valid_coords
    assert rows(valid_coords(ok), "id") == [(0,), (1,)]
    assert rows(bad, "id", "reason") == [(3, "fields=4"), (4, "bad:number")]


def test_payload_defaults_and_null(spark):
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    df = spark.createDataFrame([('{"time": 1700000000000, "x": 3, "y": "4"}',),
                                ('{"x": null}',)], "body string")
    got = [tuple(r) for r in parse_payload(df, "gyro", now=now).collect()]
    assert got[0] == (dt.datetime(2023, 11, 14, 22, 13, 20), 3.0, 4.0, 0.0, 5.0)
    assert got[1] == (dt.datetime(2024, 1, 1), 0.0, 0.0, 0.0, 0.0)
    r = spark.createDataFrame([('{"time_sec": "1700000000.5", "lx": 12}',)], "body string")
    assert [tuple(x) for x in parse_payload(r, "reading").collect()] == [("light", 1700000000.5, 12.0)]


def test_encode_fixed_decimals(spark):
    df = spark.createDataFrame([(1700000000123, 47.123456789, 8.5, 400.0, 95.0, 21.25)],
                               "ts_ms bigint, lat double, lon double, alt double, hr double, temp double")
    msg = df.select(formats.encode({c: c for c in df.columns}, "fitness")).first()[0]
    assert msg == "1700000000123,47.12345679,8.50000000,400.00,95,21.3"
    assert df.select(formats.fmt_num(F.lit(None).cast("double"))).first()[0] == ""
    assert df.select(formats.label("hr", "alt", "temp", F.lit(3))).first()[0] == \
        "HR: 95 bpm<br>Alt: 400 m<br>Temp: 21.3 °C<br>Samples: 3"


def test_geo_and_units(spark):
    df = spark.createDataFrame([(1073741824, 1700000000000)], "sc bigint, v bigint")
    r = df.select(geo.semicircles_to_deg("sc"), geo.magnitude(F.lit(3.0), F.lit(4.0), F.lit(0.0)),
                  timestamps.detect_unit("v"), timestamps.detect_unit(F.lit(1700000000)),
                  timestamps.detect_unit(F.lit(1700000000000000000))).first()
    assert tuple(r) == (90.0, 5.0, "ms", "s", "ns")


def test_time_text_and_zones(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5, 14, 41, 33),)], "ts timestamp")
    r = df.select(timestamps.fmt_date("ts", "dd.MM.yyyy"), timestamps.fmt_date("ts", "dd.MMMM yyyy"),
                  timestamps.rfc3339("ts"), timestamps.to_zone("ts", "Europe/Zurich"),
                  timestamps.offset_text(timestamps.zone_offset_minutes("ts", "Europe/Zurich")),
                  timestamps.day_bucket("ts"), timestamps.to_epoch("ts", "ns")).first()
    assert tuple(r) == ("05.01.2024", "05.January 2024", "2024-01-05T14:41:33.000000Z",
                        dt.datetime(2024, 1, 5, 15, 41, 33), "+01:00", dt.date(2024, 1, 5),
                        1704465693000000000)


def test_from_epoch_ns_exact(spark):
    df = spark.createDataFrame([(1700000000123456789,), (-1,)], "ns bigint")
    got = [r[0] for r in df.select(timestamps.from_epoch("ns", "ns")).collect()]
    assert got[0] == dt.datetime(2023, 11, 14, 22, 13, 20, 123456)
    assert got[1] == dt.datetime(1969, 12, 31, 23, 59, 59, 999999)


def test_extract_value_and_normalise_line(spark):
    df = spark.createDataFrame([("Light: lux = 12.5",), ("x = [ 3.25, 1]",), ("nothing",),
                                ("LAST VALUE: [-4",)], "l string")
    got = [r[0] for r in df.select(text.extract_value("l")).collect()]
    assert got == [12.5, 3.25, None, -4.0]
    line = spark.createDataFrame([("0,25;1,25E-2;-3",)], "l string")
    assert line.select(text.normalise_line("l")).first()[0] == "0.25,0.0125,-3.0"


def test_small_helpers(spark):
    from sensorflow.operators import clean
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (float("nan"), 3.0)], "a double, b double")
    kept, bad = clean.drop_missing(df, ["a"])
    assert kept.count() == 1 and rows(bad, "reason") == [("missing:a",), ("missing:a",)]
    arr = spark.createDataFrame([("1,2,3",), ("1,2,3,4,5,6",)], "v string").select(
        parse.split_fields("v").alias("f"))
    ok, short = clean.min_fields(arr, "f", 6)
    assert ok.count() == 1 and short.count() == 1
    assert not clean.is_empty(ok) and clean.is_empty(ok.where("false"))
    r = df.select(parse.with_default("a", 0.0).alias("d"), timestamps.now_ns().alias("n"),
                  timestamps.session_zone().alias("z")).collect()
    assert [x["d"] for x in r][:2] == [1.0, 0.0]
    assert r[0]["z"] == "UTC" and r[0]["n"] > 1_700_000_000 * 10 ** 9


def test_half_second_window_of_truncated_event_time(spark):
    from sensorflow.operators.windows import window_stats
    ok, _ = parse_gyro(_msgs(spark, ["1700000000750,0.1,0.2,0.3,0.4"]))
    w = window_stats(ok, "zeit", "500 milliseconds", count_of="gx").first()
    assert (w["fenster_start"], w["fenster_ende"]) == (
        dt.datetime(2023, 11, 14, 22, 13, 20), dt.datetime(2023, 11, 14, 22, 13, 20, 500000))
