"""Streams in event-time order: equal to the batch operators on shuffled input, across micro-batches and restarts."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sensorflow.operators import series
from sensorflow.streaming import ordered, streams

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
SCHEMA = "sensor string, ts timestamp, n long, v double, tag string, local timestamp_ntz"


def samples(seed=1, n=240):
    """Samples of three series (one without a name) with equal times, NULLs and repeated values, in order of time."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        t = T0 + dt.timedelta(milliseconds=rng.randrange(0, 60_000), microseconds=rng.choice([0, 1, 999]))
        out.append({"sensor": rng.choice(["a", "a", "a", "b", None]), "ts": t.isoformat(timespec="microseconds"), "n": i,
                    "v": rng.choice([1.0, 2.0, None, float(rng.randrange(9))]), "tag": rng.choice(["x", "é", None]),
                    "local": t.isoformat(timespec="microseconds")})
    return sorted(out, key=lambda r: r["ts"])


def shuffled(data, files, seed=2, jitter=12):
    """Files of rows, each row at most a few rows from its place in time."""
    rng = random.Random(seed)
    mixed = [r for _, r in sorted(((i + rng.uniform(0, jitter), r) for i, r in enumerate(data)), key=lambda x: x[0])]
    size = -(-len(mixed) // files)
    return [mixed[i:i + size] for i in range(0, len(mixed), size)]


def flush(at=T0 + dt.timedelta(hours=1)):
    """A row that moves the watermark past all others; nothing passes its own."""
    return [{"sensor": "end", "ts": at.isoformat(), "n": -1, "v": None, "tag": None, "local": None}]


def write(d, batches, first=0):
    os.makedirs(d, exist_ok=True)
    for i, b in enumerate(batches, first):
        p = os.path.join(d, f"b{i:03d}.json")
        with open(p, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in b)
        os.utime(p, (1_000_000 + i, 1_000_000 + i))


def source(spark, d):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(d)


def collect(spark, df, path, ck):
    streams.to_table(df, f"o{abs(hash(ck))}", path, available_now=True, checkpoint=ck).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def batch(spark, data):
    return spark.read.schema(SCHEMA).json(spark.sparkContext.parallelize([json.dumps(r) for r in data]))


def test_changes_equal_batch_on_shuffled_input(spark, tmp):
    data = samples()
    d = os.path.join(tmp, "in")
    write(d, [*shuffled(data, 5), flush()])
    out = ordered.on_change_ordered(source(spark, d), "sensor", ["ts", "n"], "v", delay="10 seconds")
    got = collect(spark, out, os.path.join(tmp, "out"), os.path.join(tmp, "ck"))
    want = series.on_change(batch(spark, data), "sensor", ["ts", "n"], "v")
    assert rows(got.where("not late").drop("late")) == rows(want)
    assert got.where("late").count() == 0


def test_segments_and_gaps_across_a_restart(spark, tmp):
    data = samples(3)
    files = shuffled(data, 6)
    want = series.segments(batch(spark, data), "sensor", ["ts", "n"], "n", "v")
    gaps = series.sample_gap(batch(spark, data), "sensor", ["ts", "n"])
    for name, make, right in [
            ("seg", lambda s: ordered.segments_stream(s, "sensor", ["ts", "n"], "10 seconds", "n", "v"), want),
            ("gap", lambda s: ordered.gap_stream(s, "sensor", ["ts", "n"], "10 seconds"), gaps)]:
        d, out, ck = (os.path.join(tmp, f"{name}-{x}") for x in ("in", "out", "ck"))
        write(d, files[:3])
        collect(spark, make(source(spark, d)), out, ck)
        write(d, [*files[3:], flush()], 3)
        got = collect(spark, make(source(spark, d)), out, ck).where("not late").drop("late")
        assert rows(got, *right.columns) == rows(right)


def test_one_micro_batch_and_buckets_of_any_width_give_the_same(spark, tmp):
    data = samples(5, 150)
    random.Random(1).shuffle(data)
    want = rows(series.on_change(batch(spark, data), [], ["ts", "n"], "tag"))
    for k, width in enumerate(["1 millisecond", "7 seconds", "1 day"]):
        d = os.path.join(tmp, f"in{k}")
        write(d, [data, flush(T0 + dt.timedelta(days=3))])
        out = ordered.on_change_ordered(source(spark, d), [], ["ts", "n"], "tag", delay="5 seconds", width=width)
        got = collect(spark, out, os.path.join(tmp, f"out{k}"), os.path.join(tmp, f"ck{k}"))
        assert rows(got.where("not late").drop("late")) == want


def test_late_rows_are_kept_beside(spark, tmp, monkeypatch):
    monkeypatch.setattr(ordered, "FLUSH", 3)
    d = os.path.join(tmp, "in")
    at = lambda s, n, sensor="a": {"sensor": sensor, "ts": (T0 + dt.timedelta(seconds=s)).isoformat(), "n": n, "v": float(n), "tag": None, "local": None}
    none = {**at(0, 9), "ts": None}
    write(d, [[at(0, 1), at(5, 2)], [at(60, 3)], [at(61, 5)], [at(3, 4), none, at(1, 6, "b")], [at(200, 7)]])
    out = ordered.segments_stream(source(spark, d), "sensor", ["ts", "n"], "10 seconds", "n", "v")
    kept, late = os.path.join(tmp, "kept"), os.path.join(tmp, "late")
    both = ordered.split_late(lambda b, e: b.write.mode("append").parquet(kept), lambda b, e: b.write.mode("append").parquet(late))
    streams.start(out, both, "split", mode="append", available_now=True, checkpoint=os.path.join(tmp, "ck")).awaitTermination()
    assert rows(spark.read.parquet(kept), "prev_n", "n") == [(1, 2), (2, 3), (3, 5)]
    # 4 came after its series went on, 9 has no time; 6 is old but the first of its series, and waits in order
    assert sorted(r["n"] for r in spark.read.parquet(late).collect()) == [4, 9]


@pytest.mark.parametrize("seed", [1, 2])
def test_trailing_view_equals_batch_after_every_batch(spark, tmp, seed):
    data = samples(seed, 120)
    files = shuffled(data, 4, seed)
    d, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    for i, part in enumerate(files):
        write(d, [part], i)
        changes = collect(spark, ordered.trailing_stream(source(spark, d), "sensor", "ts", "10 seconds"), out, ck)
        seen = batch(spark, [r for f in files[:i + 1] for r in f])
        # the watermark counts whole milliseconds
        ms = seen.withColumn("m", F.date_trunc("millisecond", "ts"))
        want = series.trailing(ms, "m", "10 seconds").drop("m")
        assert rows(ordered.in_view(changes)) == rows(want)
    assert changes.groupBy("n").agg(F.sum(F.when(F.col("op") == "enter", 1).otherwise(-1)).alias("x")).where("x not in (0, 1)").count() == 0
