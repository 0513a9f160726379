"""Table sinks: points, readings, keyed latest table with expiry, catalog, fan-out.
Plan checks: pushed filters and partition pruning reach the scan."""

from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sensorflow import schemas
from sensorflow.operators.reshape import GYRO_POINT_MAPPING, to_points
from sensorflow.sinks import tables as sinks
from sensorflow.sources import tables as sources

T0 = dt.datetime(2024, 1, 5, 12, 0, 0)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_points_roundtrip_and_pushdown(spark, tmp):
    wide = spark.createDataFrame(
        [(T0 + dt.timedelta(milliseconds=1500 * i + 7), 0.1 * i, 0.2 * i, 0.3 * i, 1.0 * i)
         for i in range(10)], "time timestamp, gx double, gy double, gz double, absolute double")
    pts = to_points(wide, GYRO_POINT_MAPPING, "time")
    assert pts.count() == 40
    path = os.path.join(tmp, "points")
    sinks.write_points(pts, path, 1, precision="ms")
    got = sources.read_points(spark, path, T0, T0 + dt.timedelta(seconds=3), "gyro_y", "ly")
    assert rows(got, "value") == [(0.0,), (0.2,)]
    assert rows(got, "time")[1] == (dt.datetime(2024, 1, 5, 12, 0, 1, 507000),)
    plan = _plan(got)
    assert "PartitionFilters: [isnotnull(measurement" in plan and "gyro_y" in plan
    assert "PushedFilters: [IsNotNull(time)" in plan and "GreaterThanOrEqual(time" in plan


def test_points_last_write_wins(spark, tmp):
    pts = spark.createDataFrame([("m", "f", 1.0, T0, 1), ("m", "f", 2.0, T0, 2)],
                                "measurement string, field string, value double, time timestamp, v int")
    path = os.path.join(tmp, "p2")
    sinks.write_points(pts, path, 1, version="v")
    assert rows(spark.read.parquet(path), "value") == [(2.0,)]


def test_readings_partitioned_and_pruned(spark, tmp):
    path = os.path.join(tmp, "readings")
    day2 = T0 + dt.timedelta(days=1)
    r1 = spark.createDataFrame([("light", T0, 1.0), ("light", day2, 2.0), ("gyro_x", T0, 3.0)],
                               "sensor_id string, ts timestamp, lx double")
    sinks.write_readings(r1, path, write_id=1)
    sinks.write_readings(spark.createDataFrame([("light", T0, 9.0)], r1.schema), path, write_id=2)
    part = sources.read_partition(spark, path, "light", T0.date())
    assert "PartitionFilters" in _plan(part) and "light" in _plan(part)
    current = sinks.read_readings(spark, path, "light", T0.date())
    assert rows(current, "ts", "lx") == [(T0, 9.0)]
    assert rows(part, "lx") == [(9.0,)]
    assert all(d.startswith(("sensor_bucket=", "_", ".")) for d in os.listdir(path))


def test_upsert_idempotent_and_ttl(spark, tmp):
    path = os.path.join(tmp, "latest")
    win = spark.createDataFrame(
        [(T0, T0 + dt.timedelta(seconds=1), 1.0, 0.1, 0.2, 0.3, 3),
         (T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(seconds=2), 2.0, 0.1, 0.2, 0.3, 1)],
        "fenster_start timestamp, fenster_ende timestamp, avg_absolute double, avg_gx double, "
        "avg_gy double, avg_gz double, n_samples bigint")
    now = F.lit("2024-01-05 12:00:10").cast("timestamp")
    sinks.upsert_batch(win, 0, path, "sensor:gyro", ttl_s=120, now=now)
    upd = win.where("n_samples = 1").withColumn("n_samples", F.lit(2).cast("bigint"))
    later = F.lit("2024-01-05 12:01:00").cast("timestamp")
    sinks.upsert_batch(upd, 1, path, "sensor:gyro", ttl_s=120, now=later)
    snapshot = rows(spark.read.parquet(path))
    sinks.upsert_batch(upd, 1, path, "sensor:gyro", ttl_s=120, now=later)  # replayed epoch
    assert rows(spark.read.parquet(path)) == snapshot
    live = sources.read_latest(spark, path, "sensor:gyro", dt.datetime(2024, 1, 5, 12, 1, 30))
    assert rows(live, "key", "n_samples") == [("sensor:gyro:1704456000000", 3),
                                              ("sensor:gyro:1704456001000", 2)]
    # after the first key's expiry only the renewed one is alive
    live2 = sources.read_latest(spark, path, "sensor:gyro", dt.datetime(2024, 1, 5, 12, 2, 30))
    assert rows(live2, "key") == [("sensor:gyro:1704456001000",)]
    comp = sinks.compact_latest(spark, path, os.path.join(tmp, "compacted"),
                                dt.datetime(2024, 1, 5, 12, 2, 30))
    assert comp.count() == 1


def test_catalog_table_and_append(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS sfdemo.worte")
    sinks.ensure_table(spark, "sfdemo.worte", schemas.WORTE, location=os.path.join(tmp, "worte"))
    sinks.ensure_table(spark, "sfdemo.worte", schemas.WORTE)  # second call is a no-op
    sinks.append_rows(spark.createDataFrame([(47, "hello"), (11, "world")], "anz int, wort string"),
                      "sfdemo.worte")
    assert rows(sources.read_table(spark, "sfdemo.worte"), "wort", "anz") == [("hello", 47), ("world", 11)]


def test_fan_out_tries_every_sink(spark):
    df = spark.range(3)
    seen = []

    def bad(d):
        raise ValueError("store down")

    with pytest.raises(RuntimeError) as e:
        sinks.fan_out(df, [bad, lambda d: seen.append(d.count())])
    assert seen == [3]
    assert isinstance(e.value.__cause__, ValueError)


def test_co_locate_and_bounded_pandas(spark):
    from sensorflow.sources.messages import co_locate
    df = spark.createDataFrame([("a", T0 + dt.timedelta(seconds=i), float(i)) for i in range(50)]
                               + [("b", T0, 1.0)], "k string, ts timestamp, v double")
    parts = co_locate(df, "k", "ts", partitions=4).rdd.glom().collect()
    assert sum(1 for p in parts if any(r["k"] == "a" for r in p)) > 1  # hot key split by time
    for p in parts:
        ts = [r["ts"] for r in p if r["k"] == "a"]
        assert ts == sorted(ts)
    pdf = sinks.to_pandas_bounded(df, 3, [F.col("ts").desc(), "k"])
    assert len(pdf) == 3 and pdf["v"].tolist() == [49.0, 48.0, 47.0]


def test_observed_counts(spark, tmp):
    from sensorflow.operators.counts import observed
    df = spark.range(10)
    counted, obs = observed(df, "obs_test", even=F.col("id") % 2 == 0)
    counted.where("id > 4").write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "even": 5}


def test_keyed_table_current_rows_and_sql_partition(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS sfdemo.worte_v")
    from pyspark.sql import types as T
    sch = T.StructType(schemas.WORTE.fields + [T.StructField("version", T.LongType())])
    sinks.ensure_table(spark, "sfdemo.worte_v", sch, location=os.path.join(tmp, "wv"))
    sinks.append_rows(spark.createDataFrame([("hello", 47, 1), ("world", 11, 1)], sch), "sfdemo.worte_v")
    sinks.append_rows(spark.createDataFrame([("hello", 48, 2)], sch), "sfdemo.worte_v")
    cur = sinks.current_rows(spark, "sfdemo.worte_v", "wort", "version")
    assert rows(cur, "wort", "anz") == [("hello", 48), ("world", 11)]

    path = os.path.join(tmp, "readings_sql")
    r = spark.createDataFrame([("light", T0, 1.0), ("light", T0 + dt.timedelta(days=1), 2.0)],
                              "sensor_id string, ts timestamp, lx double")
    sinks.write_readings(r, path, write_id=1)
    spark.read.parquet(path).createOrReplaceTempView("readings_sql")
    got = sources.read_partition_sql(spark, "readings_sql", "light", T0.date())
    assert rows(got, "lx") == [(1.0,)]
    assert "PartitionFilters" in _plan(got)


def test_last_k_resorted_ascending(spark):
    from sensorflow.operators.series import last_k
    df = spark.range(100).withColumn("ts", F.col("id"))
    got = last_k(df, None, [F.col("ts").desc()], 3, resort=[F.col("ts")])
    assert [r["id"] for r in got.collect()] == [97, 98, 99]


def test_hash_view_roundtrip(spark):
    win = spark.createDataFrame(
        [("sensor:gyro:1", T0, T0 + dt.timedelta(seconds=1), 1.23456789, None, 0.5, 0.25, 3)],
        "key string, fenster_start timestamp, fenster_ende timestamp, avg_absolute double, "
        "avg_gx double, avg_gy double, avg_gz double, n_samples bigint")
    view = sinks.as_hash_view(win)
    fields = view.first()["fields"]
    assert fields["avg_absolute"] == "1.234568" and fields["avg_gx"] == "" and fields["n_samples"] == "3"
    back = sinks.from_hash_view(view).first()
    assert (back["fenster_start"], back["avg_absolute"], back["avg_gx"], back["n_samples"]) == \
        (T0, 1.234568, None, 3)


def test_compact_and_publish_keeps_newest(spark, tmp):
    live, comp = os.path.join(tmp, "live"), os.path.join(tmp, "comp")
    sch = ("fenster_start timestamp, fenster_ende timestamp, avg_absolute double, avg_gx double, "
           "avg_gy double, avg_gz double, n_samples bigint")

    def win(sec, n):
        return spark.createDataFrame(
            [(T0 + dt.timedelta(seconds=sec), T0 + dt.timedelta(seconds=sec + 1), 1.0, 0.0, 0.0, 0.0, n)], sch)
    sinks.upsert_batch(win(0, 1), 0, live, "k", ttl_s=None)
    sinks.upsert_batch(win(0, 2), 1, live, "k", ttl_s=None)
    sinks.upsert_batch(win(1, 1), 2, live, "k", ttl_s=None)
    sinks.compact_latest(spark, live, comp, upto_epoch=1)
    assert spark.read.parquet(comp).count() == 1
    sinks.upsert_batch(win(0, 3), 3, live, "k", ttl_s=None)  # after compaction
    sinks.publish_latest(spark, "sfdemo.latest_view", comp, live, upto_epoch=1)
    got = sources.read_latest(spark, "sfdemo.latest_view", "k", dt.datetime(2000, 1, 1))
    assert rows(got, "key", "n_samples") == [("k:1704456000000", 3), ("k:1704456001000", 1)]


def test_a_range_of_points_opens_the_files_of_its_days_only(spark, tmp):
    path = os.path.join(tmp, "points")
    t0 = dt.datetime(2024, 1, 1)
    pts = spark.range(30 * 24).select(F.lit("m").alias("measurement"), F.lit("f").alias("field"), F.col("id").cast("double").alias("value"),
                                      (F.lit(t0) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("time"))
    sinks.write_points(pts, path, 1)
    sinks.write_points(pts.where("value between 49 and 50").withColumn("value", F.col("value") + 0.5), path, 2)
    got = sources.read_points(spark, path, t0 + dt.timedelta(hours=47), t0 + dt.timedelta(hours=52), "m", "f")
    assert sorted(r["value"] for r in got.collect()) == [47.0, 48.0, 49.5, 50.5, 51.0]
    plan = _plan(got)
    assert re.search(r"PartitionFilters: \[[^\]]*day_bucket#\d+ >=", plan), plan  # (the plan text cuts long lists)
    scanned = spark.read.parquet(path).where("day_bucket between '2024-01-02' and '2024-01-03'").select(F.input_file_name().alias("f")).distinct()
    assert {r["f"].split("day_bucket=")[1][:10] for r in scanned.collect()} == {"2024-01-02", "2024-01-03"}
