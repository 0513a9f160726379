"""Streams in event-time order at scale: what the state costs, in rows and in bytes, and results over split buckets."""

from __future__ import annotations

import os
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from test_ordered import T0, batch, collect, flush, samples, source, write

from conftest import rows
from sensorflow.operators import series
from sensorflow.streaming import ordered, streams


def run(spark, tmp, make, data, files=2):
    """What the stream writes for ``data``, and the state rows that it wrote and removed on the way."""
    d, out, ck = (os.path.join(tmp, x) for x in ("in", "out", "ck"))
    write(d, [*(data[i::files] for i in range(files)), flush(T0.replace(year=2030))])
    df = make(source(spark, d))
    q = streams.to_table(df, f"o{abs(hash(ck))}", out, available_now=True, checkpoint=ck)
    q.awaitTermination()
    touched = sum(op["numRowsUpdated"] + op["numRowsRemoved"] for p in q.recentProgress for op in p["stateOperators"])
    return spark.read.schema(df.schema).parquet(out), touched


def many_series(n=3000):
    """Two rows for each of many series, at times of their own."""
    one = {"v": 1.0, "tag": None, "local": None}
    return [{"sensor": f"s{i % (n // 2)}", "ts": (T0.replace(microsecond=0)).isoformat()[:11] + f"{i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}",
             "n": i, **one} for i in range(n)]


def test_segments_of_many_series_cost_few_state_rows(spark, tmp):
    data = many_series()
    got, touched = run(spark, tmp, lambda s: ordered.segments_stream(s, "sensor", ["ts", "n"], "30 days", "n", "v"), data)
    assert rows(got.where("not late"), "sensor", "n", "prev_n") == rows(series.segments(batch(spark, data), "sensor", ["ts", "n"], "n", "v"), "sensor", "n", "prev_n")
    assert got.where("not late").count() == 1500
    assert touched < len(data)  # (each row alone was written, read and removed)


def test_a_trailing_view_of_many_times_costs_few_state_rows(spark, tmp):
    data = many_series()
    got, touched = run(spark, tmp, lambda s: ordered.trailing_stream(s, "sensor", "ts", "10 days"), data)
    assert got.where("op = 'enter'").count() == len(data) + 1 and got.where("op = 'leave'").count() == len(data)
    assert rows(ordered.in_view(got), "n") == [(-1,)]
    assert touched < len(data)


class Handle:
    """State of one group in memory, with the calls of a state store."""

    def __init__(self):
        self.timers, self.largest = set(), 0

    def getMapState(self, name, *_):  # noqa: N802
        rows = {}

        def put(k, v):
            rows[k] = v
            self.largest = max(self.largest, len(v[0]))
        return SimpleNamespace(getValue=rows.get, updateValue=put, removeKey=rows.pop, rows=rows)

    def getValueState(self, *_):  # noqa: N802
        held = []
        return SimpleNamespace(get=lambda: held[0] if held else None, update=lambda v: held.__setitem__(slice(None), [v]))

    registerTimer = lambda self, t: self.timers.add(t)  # noqa: E731, N815
    deleteTimer = lambda self, t: self.timers.remove(t)  # noqa: E731, N815


def test_a_hot_series_is_handed_over_in_pieces_of_bounded_size():
    rng = np.random.default_rng(1)
    handle, size = Handle(), 16 << 10
    step = ordered.InOrder(1000, [], [0], 500, size)
    step.init(handle)
    us = rng.permutation(20_000) * 250_000
    for part in np.array_split(us, 40):
        t = pa.table({"key": ["a"] * len(part), "us": part, "c0": part})
        assert list(step.handleInputRows((0,), iter([ordered._packed(t)]), None)) == []
    first = min(handle.timers)
    assert handle.timers == {first} and first == 1000
    end = SimpleNamespace(getExpiryTimeInMs=lambda: first, getCurrentWatermarkInMs=lambda: 4_000_500)
    out = [ordered._from_bytes(f["rows"][0]) for f in step.handleExpiredTimer((0,), end, end)]
    assert max(t.nbytes for t in out) <= 4 * size and len(out) > 10
    got = pa.concat_tables(out)
    assert got["c0"].to_pylist() == list(range(0, 4_000_000_000, 250_000))
    assert got["p0"].to_pylist() == [None, *got["c0"].to_pylist()[:-1]]
    assert handle.timers == {first, 4_001_000} and handle.largest <= 4 * size
    done = SimpleNamespace(getExpiryTimeInMs=lambda: 10**9, getCurrentWatermarkInMs=lambda: 10**9)
    assert sum(ordered._from_bytes(f["rows"][0]).num_rows for f in step.handleExpiredTimer((0,), done, done)) == 4000
    assert step.waiting.chunks.rows == {}


def test_rows_of_one_time_stay_together_and_splitting_them_ends():
    handle = Handle()
    held = ordered.Buckets(handle, "b", 2000)
    for i in range(30):
        held.add(pa.table({"due": [7] * 50 + [9], "n": list(range(i * 51, i * 51 + 51))}))
    assert [b[0] for b in held._open()[2]][0] == 7 and handle.timers == {7}
    sizes = [(t["due"][0].as_py(), t.num_rows) for t in held.take(8)]
    assert sizes == [(7, 1500)] and 9 in handle.timers
    assert sorted(x for t in held.take(9) for x in t["n"].to_pylist()) == list(range(50, 1530, 51))
    assert held.chunks.rows == {}


@pytest.mark.parametrize("seed", [1, 2])
def test_changes_of_one_series_over_split_buckets_equal_batch(spark, tmp, monkeypatch, seed):
    monkeypatch.setattr(ordered, "FLUSH", 20)
    monkeypatch.setattr(ordered, "BUCKET_BYTES", 4000)
    data = [{**r, "sensor": None} for r in samples(seed, 600)]
    random.Random(seed).shuffle(data)
    got, touched = run(spark, tmp, lambda s: ordered.lag_stream(s, "sensor", ["ts", "tag", "v", "n"], ["v", "tag"], "30 days", "7 milliseconds"), data, 3)
    want = series.lag_stitched(batch(spark, data), "sensor", ["ts", "tag", "v", "n"], ["v", "tag"])
    assert rows(got.where("not late and n >= 0"), "n", "prev_v", "prev_tag") == rows(want, "n", "prev_v", "prev_tag")
    assert rows(got, "n", "local", "ts") == rows(batch(spark, data), "n", "local", "ts")


def test_tie_breakers_sort_like_spark(spark, tmp):
    """NULL first and NaN last, lists too; whole numbers with gaps stay whole."""
    d = os.path.join(tmp, "in")
    big = 2**62 + 1
    values = [(float("nan"), None), (None, big), (1.5, None), (-1.0, big + 1), (float("inf"), 3), (None, None)]
    at = [(T0, i, v, [v, None], w) for i, (v, w) in enumerate(values)]
    sch = "ts timestamp, n int, v double, l array<double>, w long"
    spark.createDataFrame(at, sch).write.parquet(d)
    spark.createDataFrame([(T0.replace(year=2030), -1, None, None, None)], sch).write.mode("append").parquet(d)
    for k, by in enumerate([["ts", "v", "n"], ["ts", "l", "n"]]):
        df = ordered.lag_stream(spark.readStream.schema(sch).parquet(d), [], by, ["n", "w", "l"], "1 day")
        got = collect(spark, df, os.path.join(tmp, f"out{k}"), os.path.join(tmp, f"ck{k}"))
        chain = {r["n"]: r["prev_n"] for r in got.collect()}
        assert chain == {1: None, 5: 1, 3: 5, 2: 3, 4: 2, 0: 4}, by
        assert {r["n"]: r["w"] for r in got.collect()} == {i: w for i, (_, w) in enumerate(values)}
        assert {r["n"]: r["prev_w"] for r in got.collect()}[5] == big and isinstance(got.first()["l"], list)
