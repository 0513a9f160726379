"""Series operators: bucketed lag equals the plain window, per-key operators."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from sensorflow.operators import series
from sensorflow.operators.windows import track_summary, window_stats

T0 = dt.datetime(2024, 1, 1)


def _series(spark, n=600, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = rnd.choice(["a", "a", "a", "b", "c", None])  # "a" is the hot key
        # gaps of up to 3 days, so some (key, day) buckets are empty
        ts = T0 + dt.timedelta(seconds=rnd.randint(0, 6 * 86400))
        v = rnd.choice([None, 1.0, 1.0, 2.0, float(rnd.randint(0, 3))])
        data.append((i, key, ts, v))
    return spark.createDataFrame(data, "id int, k string, ts timestamp, v double")


def test_lag_stitched_equals_plain_lag(spark):
    df = _series(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    want = df.select("id", F.lag("v").over(w).alias("p"),
                     F.lag(F.lit(1)).over(w).isNotNull().alias("h"))
    for bucket in ("1 hour", "1 day"):
        got = series.lag_stitched(df, "k", ["ts", "id"], ["v"], bucket=bucket)
        assert rows(got, "id", "prev_v", "has_prev") == rows(want, "id", "p", "h")


def test_on_change_keeps_first_and_changes(spark):
    data = [(1, "s", T0, 1.0), (2, "s", T0 + dt.timedelta(seconds=1), 1.0),
            (3, "s", T0 + dt.timedelta(days=2), 2.0), (4, "s", T0 + dt.timedelta(days=2, seconds=1), None),
            (5, "s", T0 + dt.timedelta(days=3), None), (6, "t", T0, None), (7, "t", T0 + dt.timedelta(seconds=5), 3.0)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, v double")
    got = series.on_change(df, "k", ["ts", "id"], "v")
    assert rows(got, "id") == [(1,), (3,), (4,), (7,)]


def test_segments_and_sample_gap(spark):
    data = [(1, "u", T0, 10.0, 20.0), (2, "u", T0 + dt.timedelta(seconds=2), 11.0, 21.0),
            (3, "u", T0 + dt.timedelta(days=1, seconds=2), 12.0, 22.0), (4, "w", T0, 0.0, 0.0)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, lat double, lon double")
    seg = series.segments(df, "k", ["ts", "id"])
    assert rows(seg, "id", "prev_lat", "prev_lon") == [(2, 10.0, 20.0), (3, 11.0, 21.0)]
    gaps = series.sample_gap(df, "k", ["ts", "id"], "ts")
    assert rows(gaps, "id", "gap_us") == [(1, None), (2, 2_000_000), (3, 86_400_000_000), (4, None)]


def test_last_k_latest_trailing(spark):
    df = _series(spark, 300)
    got = series.last_k(df.where("k = 'a'"), None, [F.col("ts").desc(), F.col("id").desc()], 5)
    want = df.where("k = 'a'").orderBy(F.col("ts").desc(), F.col("id").desc()).limit(5)
    assert rows(got, "id") == rows(want, "id")
    per_key = series.last_k(df, "k", [F.col("ts").desc(), F.col("id").desc()], 3)
    assert per_key.groupBy("k").count().where("count > 3").count() == 0
    latest = series.latest_by_key(df, "k", ["ts", "id"])
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("id").desc())
    want_latest = df.withColumn("rn", F.row_number().over(w)).where("rn = 1")
    assert rows(latest, "k", "id", "v") == rows(want_latest, "k", "id", "v")
    trail = series.trailing(df, "ts", "6 hours", by="k")
    mx = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("ts").alias("m")).collect()}
    for r in trail.collect():
        assert r["ts"] >= mx[r["k"]] - dt.timedelta(hours=6)


def test_unseen_first_last_bounds_delta(spark):
    df = _series(spark, 200).where("k is not null")
    seen = df.where("v = 1.0")
    got = series.unseen(df, seen, "k")
    keys_seen = {r[0] for r in seen.select("k").distinct().collect()}
    assert all(r["k"] not in keys_seen for r in got.collect())
    fl = series.first_last(df, "k", ["ts", "id"], "v").collect()
    assert {r["k"] for r in fl} == {"a", "b", "c"}
    b = series.time_bounds(df, "ts").first()
    assert b["n"] == df.count() and b["first_ts"] <= b["last_ts"]
    daily = df.groupBy("k", F.to_date("ts").alias("d")).agg(F.avg("v").alias("m"))
    d = series.delta(daily, "k", "d", "m")
    assert d.where("d_m is not null").count() == daily.count() - 3


def test_rebase_and_elapsed(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(microseconds=1500),), (T0 + dt.timedelta(seconds=2, microseconds=999),)],
                               "ts timestamp")
    r = rows(series.rebase_start(df, "ts", 1_700_000_000_000), "ts_rebased")
    assert r == [(dt.datetime(2023, 11, 14, 22, 13, 20),), (dt.datetime(2023, 11, 14, 22, 13, 21, 999000),)]
    e = rows(series.elapsed(df, "ts"), "elapsed_s")
    assert e == [(0.0,), (1.999499,)]
    end = rows(series.rebase_to_end(df, "ts", 1_700_000_000_000), "ts_rebased")
    assert end[-1] == (dt.datetime(2023, 11, 14, 22, 13, 20),)


def test_window_stats_and_half_second_quirk(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, 0)
    data = [(base, 1.0, 2.0), (base + dt.timedelta(milliseconds=400), 3.0, None),
            (base + dt.timedelta(seconds=1), 5.0, 6.0)]
    df = spark.createDataFrame(data, "zeit timestamp, gx double, absolute double")
    out = window_stats(df, "zeit", "1 second", ["gx", "absolute"], count_of="absolute")
    assert rows(out, "fenster_start", "avg_gx", "avg_absolute", "n_samples") == [
        (base, 2.0, 2.0, 1), (base + dt.timedelta(seconds=1), 5.0, 6.0, 1)]
    # second-resolution event time: 500 ms windows only ever fill [s, s + 0.5)
    secs = df.withColumn("zeit", F.date_trunc("second", "zeit"))
    half = window_stats(secs, "zeit", "500 milliseconds", count_of="gx")
    assert all(r["fenster_start"].microsecond == 0 for r in half.collect())
    summ = track_summary(out, ["avg_gx"]).first()
    assert (summ["n_windows"], summ["avg_gx_avg"], summ["avg_gx_weighted"]) == (2, 3.5, 3.5)


def test_ranges_of_a_burst_and_a_sparse_series(spark, monkeypatch):
    t0 = dt.datetime(2024, 1, 1)
    burst = spark.range(20_000).select(F.lit("burst").alias("k"), (F.lit(t0) + F.make_dt_interval(secs=F.col("id") / 20_000.0)).alias("ts"), F.col("id"))
    sparse = spark.range(900).select(F.lit("sparse").alias("k"), (F.lit(t0) + F.make_dt_interval(days=F.col("id").cast("int"))).alias("ts"), (F.col("id") + 100_000).alias("id"))
    none = spark.range(3).select(F.lit(None).cast("string").alias("k"), F.lit(None).cast("timestamp").alias("ts"), (F.col("id") + 200_000).alias("id"))
    df = burst.unionByName(sparse).unionByName(none).withColumn("v", F.col("id"))
    monkeypatch.setattr(series, "SPLIT_ROWS", 1000)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges stay apart
    try:
        keyed = df.withColumn(series._K, F.struct("k"))
        assert series.longest_series(keyed) == 20_000
        per = [r["n"] for r in series.with_ranges(keyed, ["ts", "id"]).groupBy(series._B).agg(F.count("*").alias("n")).collect()]
        assert len(per) == 8 and max(per) <= 2 * 20_903 / 8
        plain = series.lag_stitched(df, "k", ["ts", "id"], ["v"], bucket=None)
        got = series.lag_stitched(df, "k", ["ts", "id"], ["v"])
        assert rows(got, "id", "prev_v", "has_prev") == rows(plain, "id", "prev_v", "has_prev")
        assert rows(got, "id", "prev_v") == rows(got, "id", "prev_v")  # the same plan twice
        one = series.lag_stitched(df, None, ["ts", "id"], ["v", "k"])  # one series
        assert rows(one, "id", "prev_v", "prev_k", "has_prev") == rows(series.lag_stitched(df, None, ["ts", "id"], ["v", "k"], bucket=None), "id", "prev_v", "prev_k", "has_prev")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_order_key_with_null_times_and_extremes(spark):
    data = [(1, "a", None, 5, 1.0), (2, "a", T0, -(2 ** 63), 2.0), (3, "a", T0, 2 ** 63 - 1, 3.0),
            (4, "a", dt.datetime(9999, 12, 31, 23, 59, 59), 0, 4.0), (5, "a", dt.datetime(1, 1, 1), 0, 5.0)]
    df = spark.createDataFrame(data, "id int, k string, ts timestamp, tie bigint, v double")
    got = series.first_last(df, "k", ["ts", "tie"], "v").first()
    # NULL time sorts first, year 9999 last
    assert (got["first_v"], got["last_v"]) == (1.0, 4.0)
    w = Window.partitionBy("k").orderBy("ts", "tie")
    want = df.select("id", F.lag("v").over(w).alias("p"))
    got2 = series.lag_stitched(df, "k", ["ts", "tie"], ["v"], bucket="1 day")
    assert rows(got2, "id", "prev_v") == rows(want, "id", "p")


def test_order_key_sorts_like_the_columns(spark):
    rnd = random.Random(11)
    data = []
    for i in range(2000):
        ts = None if rnd.random() < 0.05 else dt.datetime(rnd.choice([1000, 1969, 1970, 2024, 9999]), 1, 2) \
            + dt.timedelta(microseconds=rnd.randint(0, 10 ** 12))
        tie = None if rnd.random() < 0.05 else rnd.choice([-(2 ** 63), 2 ** 63 - 1, rnd.randint(-5, 5)])
        data.append((i, ts if ts is None or ts.year <= 9999 else None, tie))
    df = spark.createDataFrame(data, "id int, ts timestamp, tie bigint")
    key = series.order_key(df, ["ts", "tie"])
    by_key = [r["id"] for r in df.orderBy(key, "id").collect()]
    by_cols = [r["id"] for r in df.orderBy(F.col("ts").asc_nulls_first(),
                                           F.col("tie").asc_nulls_first(), "id").collect()]
    assert by_key == by_cols


def test_window_mean_ordered(spark):
    from sensorflow.operators.windows import window_mean
    base = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(base + dt.timedelta(seconds=s), float(s)) for s in (3, 1, 2, 1)],
                               "zeit timestamp, absolute double")
    got = [(r["fenster_start"], r["avg_absolute"]) for r in window_mean(df, "zeit", "1 second",
                                                                         ["absolute"]).collect()]
    assert got == [(base + dt.timedelta(seconds=1), 1.0), (base + dt.timedelta(seconds=2), 2.0),
                   (base + dt.timedelta(seconds=3), 3.0)]
