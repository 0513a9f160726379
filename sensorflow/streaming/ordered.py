"""Streams that see each series in event-time order (T5, T6; W1, W2, W5, F7).

Rows of a stream come in any order, within a micro-batch and across them.
:func:`lag_stream` lets them wait in state until the watermark has passed their
time, then hands them over in order with the values of the row before, so what
follows (changes, segments, gaps) is a plain column expression and equals the
batch operators of :mod:`operators.series` on the same rows.

Series are dealt over :data:`SHARDS` groups, so the cost of a micro-batch goes with
its rows and not with the number of series or of times. Rows travel as Arrow
tables (:func:`_pack`, :func:`_unpack`). State per group: the waiting rows in
buckets of event time that split as they grow, with one timer at the first row
that will be due; and of every series the last row handed over and how far it has
been handed over. A task holds one bucket at a time, never a whole series, nor the
micro-batch of a hot one. The state is in the state store, so a restarted query
goes on where it stopped.

A row older than what its series has handed over is late. Late rows (and rows
without a time) leave at once, marked ``late``: kept rows and late rows together
are the input (:func:`split_late` writes them to two places).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampNTZType, TimestampType

from ..functions.timestamps import as_instant
from ..operators.series import _names

#: Rows, and bytes, that a task collects before they go on to the shuffle or to the state.
FLUSH, FLUSH_BYTES = 50_000, 8 << 20
#: Groups of series, each with its own state; fixed by the first run of a query.
SHARDS = 64
#: A bucket of more bytes is split, into pieces of a quarter.
BUCKET_BYTES = 8 << 20


def _width_ms(width: str) -> int:
    n, unit = width.split()
    return int(float(n) * {"milli": 1, "secon": 1000, "minut": 60_000, "hour": 3_600_000, "day": 86_400_000}[unit.rstrip("s")[:5]])


def _rank(values: Sequence) -> tuple:
    """Sorts like Spark's ascending order: NULL first, NaN last."""
    values = [_rank(v.values() if isinstance(v, dict) else v) if isinstance(v, (dict, list, tuple)) else v for v in values]
    return tuple((v is not None, v != v, 0 if v is None or v != v else v) for v in values)


def _to_bytes(t: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t)
    return sink.getvalue().to_pybytes()


def _from_bytes(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(data).read_all()


def _gathered(tables: Iterator[pa.Table], rows: int) -> Iterator[pa.Table]:
    """The tables put together up to so many rows, or :data:`FLUSH_BYTES`."""
    held: list[pa.Table] = []
    n = size = 0
    for t in tables:
        held.append(t)
        n, size = n + t.num_rows, size + t.nbytes
        if n >= rows or size >= FLUSH_BYTES:
            yield pa.concat_tables(held).combine_chunks()
            held, n, size = [], 0, 0
    if n:
        yield pa.concat_tables(held).combine_chunks()


def _pack(flush: int) -> Callable:
    """Rows of a partition as tables of one group each: (shard, rows)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered((pa.Table.from_batches([b]) for b in batches), flush):
            t = t.take(pc.sort_indices(t["shard"]))
            shard = t["shard"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
            t = t.drop_columns(["shard"])
            for i, j in zip(cuts, [*cuts[1:], len(shard)], strict=True):
                yield pa.RecordBatch.from_arrays([pa.array([shard[i]], pa.int32()), pa.array([_to_bytes(t.slice(i, j - i))], pa.binary())], ["shard", "rows"])
    return pack


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for data in b.column(0):
            yield from _from_bytes(data.as_py()).to_batches()


def _packed(t: pa.Table) -> pd.DataFrame:
    return pd.DataFrame({"rows": [_to_bytes(t)]})


def _tables(frames: Iterator[pd.DataFrame], rows: int) -> Iterator[pa.Table]:
    return _gathered((_from_bytes(data) for f in frames for data in f["rows"]), rows)


def _ms(t: pa.Table) -> np.ndarray:
    """Whole milliseconds of the rows; 0 without a time."""
    return pc.fill_null(t["us"], 0).to_numpy() // 1000


class Buckets:
    """Rows with the time ``due``, in buckets of a map state in order of it, with one timer at the first.

    The index lists the buckets: first time, number, chunks, bytes, and the bytes at which the bucket is split. Rows
    with the same time stay in the same bucket.
    """

    def __init__(self, handle: StatefulProcessorHandle, name: str, size: int):
        self.handle, self.size = handle, size
        self.chunks = handle.getMapState(name, "bucket long, n int", "rows binary")
        self.index = handle.getValueState(name + "Index", "index binary")

    def _open(self) -> tuple[int | None, int, list[list]]:
        """The timer, the next number and the buckets."""
        old = self.index.get()
        return pickle.loads(old[0]) if old is not None else (None, 0, [])

    def _save(self, timer: int | None, number: int, buckets: list[list]) -> None:
        first = buckets[0][0] if buckets else None
        if timer is not None and timer != first:
            self.handle.deleteTimer(timer)
        if first is not None and timer != first:
            self.handle.registerTimer(first)
        self.index.update((pickle.dumps((first, number, buckets)),))

    def _append(self, bucket: list, t: pa.Table) -> None:
        data = _to_bytes(t)
        self.chunks.updateValue((bucket[1], bucket[2]), (data,))
        bucket[2], bucket[3] = bucket[2] + 1, bucket[3] + len(data)

    def _remove(self, bucket: list) -> pa.Table:
        """The rows of a bucket in order of ``due``, which the state then has no more."""
        keys = [(bucket[1], n) for n in range(bucket[2])]
        t = pa.concat_tables([_from_bytes(self.chunks.getValue(k)[0]) for k in keys])
        for k in keys:
            self.chunks.removeKey(k)
        return t.take(pc.sort_indices(t["due"])).combine_chunks()

    def add(self, t: pa.Table) -> None:
        if not t.num_rows:
            return
        timer, number, buckets = self._open()
        t = t.take(pc.sort_indices(t["due"]))
        due = t["due"].to_numpy()
        if buckets:
            buckets[0][0] = min(buckets[0][0], int(due[0]))
        else:
            buckets.append([int(due[0]), number, 0, 0, self.size])
            number += 1
        cuts = [0, *np.searchsorted(due, [b[0] for b in buckets[1:]]), len(due)]
        after: list[list] = []
        for bucket, i, j in zip(buckets, cuts, cuts[1:], strict=False):
            if j > i:
                self._append(bucket, t.slice(i, j - i))
            if bucket[3] <= bucket[4]:
                after.append(bucket)
                continue
            rows = self._remove(bucket)
            times = rows["due"].to_numpy()
            step = max(1, len(times) * self.size // 4 // bucket[3])
            starts = np.unique(np.searchsorted(times, times[::step]))
            for a, b in zip(starts, [*starts[1:], len(times)], strict=True):
                after.append([int(times[a]), number, 0, 0, self.size])
                self._append(after[-1], rows.slice(a, b - a))
                after[-1][4] = max(self.size, 2 * after[-1][3])
                number += 1
        self._save(timer, number, after)

    def take(self, end: int) -> Iterator[pa.Table]:
        """The rows that are due up to ``end``, in order of it, a bucket at a time; they are removed."""
        _, number, buckets = self._open()
        while buckets and buckets[0][0] <= end:
            t = self._remove(buckets.pop(0))
            n = int(np.searchsorted(t["due"].to_numpy(), end, "right"))
            if n < t.num_rows:
                rest = t.slice(n)
                buckets.insert(0, [rest["due"][0].as_py(), number, 0, 0, self.size])
                self._append(buckets[0], rest)
                number += 1
            yield t.slice(0, n)
        self._save(None, number, buckets)  # the engine removes the timer that has expired


def _sort_keys(col: pa.ChunkedArray) -> list[pa.Array]:
    """Columns that sort, NULL first, like Spark's ascending order of ``col`` (NaN last)."""
    if pa.types.is_floating(col.type):
        nan = pc.fill_null(pc.is_nan(col), False)
        return [nan, pc.if_else(nan, pa.scalar(0, col.type), col)]
    if pa.types.is_nested(col.type):
        ranks = [_rank([v]) for v in col.to_pylist()]
        place: list[int] = [0] * len(ranks)
        n, before = -1, None
        for i in sorted(range(len(ranks)), key=ranks.__getitem__):
            n, before = n + (ranks[i] != before), ranks[i]
            place[i] = n
        return [pa.array(place, pa.int64())]
    return [] if pa.types.is_null(col.type) else [col]


class InOrder(StatefulProcessor):
    """Rows ``(key, us, c0, c1 ...)`` of a group of series, each series in order of time, then of the columns ``order``."""

    def __init__(self, width_ms: int, order: Sequence[int], carried: Sequence[int], flush: int, size: int):
        self.width_ms, self.order, self.carried, self.flush, self.size = width_ms, list(order), list(carried), flush, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.waiting = Buckets(handle, "waiting", self.size)
        self.last = handle.getValueState("last", "rows binary")

    def _last(self) -> pa.Table | None:
        """Of every series that has been handed over: its key, up to where (``done``), and what is carried."""
        old = self.last.get()
        return _from_bytes(old[0]) if old is not None else None

    def _out(self, t: pa.Table, prev: list, has_prev: np.ndarray, late: bool) -> pd.DataFrame:
        cols = [c for c in t.column_names if c not in ("key", "us", "due")]
        names = [*cols, *[f"p{j}" for j in range(len(prev))], "has_prev", "late"]
        return _packed(pa.table([*[t[c] for c in cols], *prev, pa.array(has_prev), pa.array(np.full(t.num_rows, late))], names=names))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last = self._last()
        for t in _tables(rows, self.flush):
            ms = _ms(t)
            late = pc.is_null(t["us"]).to_numpy().copy()
            if last is not None:
                at = pc.fill_null(pc.index_in(t["key"], value_set=last["key"].combine_chunks()), -1).to_numpy()
                late |= (at >= 0) & (ms < last["done"].to_numpy()[at])
            if late.any():
                lost = t.filter(pa.array(late))
                yield self._out(lost, [pa.nulls(lost.num_rows, lost[f"c{j}"].type) for j in self.carried], np.zeros(lost.num_rows, bool), True)
            due = pa.array(ms - ms % self.width_ms + self.width_ms)
            self.waiting.add(t.append_column("due", due).filter(pa.array(~late)))

    def _linked(self, t: pa.Table, last: pa.Table | None) -> tuple[pd.DataFrame, pa.Table]:
        """The rows with what the row before carries, and the last row of every series after them."""
        coded = t["key"].combine_chunks().dictionary_encode()
        by = [coded.indices, t["us"], *[k for c in self.order for k in _sort_keys(t[f"c{c}"])]]
        names = [f"k{i}" for i in range(len(by))]
        place = pc.sort_indices(pa.table(by, names=names), sort_keys=[(n, "ascending") for n in names], null_placement="at_start")
        t, series = t.take(place), coded.indices.take(place).to_numpy()
        change = series[1:] != series[:-1]
        first, end = np.r_[True, change], np.r_[change, True]
        n = 0 if last is None else last.num_rows
        prev = np.arange(len(series)) + n - 1
        prev[first] = -1
        if last is not None:
            at = pc.fill_null(pc.index_in(coded.dictionary, value_set=last["key"].combine_chunks()), -1).to_numpy()
            prev[first] = at[series[first]]
        place = pa.array(prev, mask=prev < 0)
        carried = [pa.concat_tables([x.select([i]).rename_columns(["v"]) for x, i in ([] if last is None else [(last, f"v{j}")]) + [(t, f"c{c}")]])["v"]
                   .combine_chunks() for j, c in enumerate(self.carried)]
        out = self._out(t, [v.take(place) for v in carried], prev >= 0, False)
        ends = t.filter(pa.array(end))
        now = pa.table([ends["key"], ends["due"], *[ends[f"c{c}"] for c in self.carried]],
                       names=["key", "done", *[f"v{j}" for j in range(len(self.carried))]])
        if last is not None:
            now = pa.concat_tables([last.filter(pc.invert(pc.is_in(last["key"], value_set=coded.dictionary))), now]).combine_chunks()
        return out, now

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, some = self._last(), False
        for t in self.waiting.take(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())):
            out, last = self._linked(t, last)
            some = True
            yield out
        if some:
            self.last.update((_to_bytes(last),))

    def close(self) -> None:
        pass


_TIMES = (TimestampType, TimestampNTZType)


def _plain(df: DataFrame) -> list[Column]:
    """Times as microseconds, which no time zone of a worker touches."""
    return [F.unix_micros(as_instant(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, _TIMES) else F.col(f"`{f.name}`") for f in df.schema]


def _field(f: StructField, name: str) -> StructField:
    return StructField(name, LongType() if isinstance(f.dataType, _TIMES) else f.dataType, True)


def _back(f: StructField, name: str) -> Column:
    c = F.col(f"`{name}`")
    if isinstance(f.dataType, TimestampType):
        c = F.timestamp_micros(c)
    elif isinstance(f.dataType, TimestampNTZType):
        c = F.timestamp_micros(c).cast("timestamp_ntz")
    return c.alias(name)


def _grouped(df: DataFrame, by: Sequence[str], ts: str, delay: str):
    """The stream by groups of series, rows packed with their key and their time in microseconds; the watermark is that of ``ts``."""
    at = "__sf_at"
    marked = df.withColumn(at, as_instant(ts)).withWatermark(at, delay)
    # the time goes in as a number, so the engine does not drop late rows before the operator sees them
    key = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    flat = marked.select(key.alias("key"), F.unix_micros(at).alias("us"), *[c.alias(f"c{i}") for i, c in enumerate(_plain(df))])
    return flat.select(F.pmod(F.xxhash64("key"), F.lit(SHARDS)).cast("int").alias("shard"), "*").mapInArrow(_pack(FLUSH), "shard int, rows binary").groupBy("shard")


def lag_stream(df: DataFrame, by, order, cols, delay: str, width: str = "1 second",
               prefix: str = "prev_", has_prev: str = "has_prev", late: str = "late") -> DataFrame:
    """The rows of a stream with ``prev_<c>``, ``has_prev`` and ``late``; append mode.

    ``prev_<c>`` is the value of ``c`` in the previous row of the series by
    ``order`` (a time, then tie-breakers), as :func:`operators.series.lag_stitched`
    gives it over all rows that were not late. Rows come out when the watermark
    (``delay`` behind the newest time) has passed their bucket of ``width``.
    """
    by, order, cols = _names(by), _names(order), _names(cols)
    fields = {f.name: f for f in df.schema}
    place = {c: i for i, c in enumerate(df.columns)}
    schema = StructType([*[_field(f, f"c{i}") for i, f in enumerate(df.schema)], *[_field(fields[c], f"p{j}") for j, c in enumerate(cols)],
                         StructField("has_prev", BooleanType()), StructField("late", BooleanType())])
    step = InOrder(_width_ms(width), [place[c] for c in order[1:]], [place[c] for c in cols], FLUSH, BUCKET_BYTES)
    out = _grouped(df, by, order[0], delay).transformWithStateInPandas(step, "rows binary", "Append", "EventTime").mapInArrow(_unpack, schema)
    return out.select(*[_back(f, f"c{i}").alias(f.name) for i, f in enumerate(df.schema)],
                      *[_back(fields[c], f"p{j}").alias(prefix + c) for j, c in enumerate(cols)], F.col("has_prev").alias(has_prev), F.col("late").alias(late))


def on_change_ordered(df: DataFrame, by, order, col: str, delay: str, width: str = "1 second") -> DataFrame:
    """Readings that differ from the previous one of their series, in event-time order; late rows are marked.

    Equal to :func:`operators.series.on_change` over the rows that were not late.
    """
    out = lag_stream(df, by, order, [col], delay, width, prefix="__sf_lag_")
    prev = F.col("__sf_lag_" + col)
    return out.where(F.col("late") | ~F.col(col).eqNullSafe(prev)).drop("__sf_lag_" + col, "has_prev")


def segments_stream(df: DataFrame, by, order, delay: str, lat: str = "lat", lon: str = "lon", width: str = "1 second") -> DataFrame:
    """Path segments of every series, each once; late rows are marked and have no segment."""
    out = lag_stream(df, by, order, [lat, lon], delay, width)
    return out.where(F.col("late") | F.col("has_prev")).drop("has_prev")


def gap_stream(df: DataFrame, by, order, delay: str, width: str = "1 second") -> DataFrame:
    """``gap_us`` to the previous sample of the series (NULL for the first and for late rows)."""
    us = "__sf_us"
    timed = df.withColumn(us, F.unix_micros(as_instant(_names(order)[0])))
    out = lag_stream(timed, by, order, [us], delay, width, prefix="__sf_lag_")
    return out.withColumn("gap_us", F.col(us) - F.col("__sf_lag_" + us)).drop(us, "__sf_lag_" + us, "has_prev")


def split_late(kept: Callable[[DataFrame, int], None], late: Callable[[DataFrame, int], None], mark: str = "late") -> Callable[[DataFrame, int], None]:
    """T5: a batch callback that sends rows in time to ``kept`` and late rows to ``late``, without the mark."""
    def both(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()  # one run of the stateful operator feeds both
        try:
            kept(batch.where(~F.col(mark)).drop(mark), epoch_id)
            late(batch.where(F.col(mark)).drop(mark), epoch_id)
        finally:
            batch.unpersist()
    return both


class Trailing(StatefulProcessor):
    """Rows enter a view on arrival and leave it when the watermark has moved ``interval_ms`` past them."""

    def __init__(self, interval_ms: int, width_ms: int, flush: int, size: int):
        self.interval_ms, self.width_ms, self.flush, self.size = interval_ms, width_ms, flush, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.shown = Buckets(handle, "shown", self.size)

    def _out(self, t: pa.Table, op: str) -> pd.DataFrame:
        return _packed(t.drop_columns(["key", "us", "due"]).append_column("op", pa.array([op] * t.num_rows, pa.string())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for t in _tables(rows, self.flush):
            # a row leaves in the first millisecond after its bucket in which it is out of the range
            ms = _ms(t)
            due = ms - ms % self.width_ms + self.width_ms + self.interval_ms
            fresh = t.append_column("due", pa.array(due)).filter(pa.array((due > now) & pc.is_valid(t["us"]).to_numpy()))
            if fresh.num_rows:
                yield self._out(fresh, "enter")
                self.shown.add(fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for t in self.shown.take(max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())):
            yield self._out(t, "leave")

    def close(self) -> None:
        pass


def trailing_stream(df: DataFrame, by, ts: str, interval: str, delay: str = "0 seconds", width: str = "1 millisecond") -> DataFrame:
    """F7 as a stream of changes: rows with ``op`` ``enter`` or ``leave``; append mode.

    The watermark is the moving maximum of all series, ``delay`` behind the
    newest time. A row enters when it comes in and leaves by a timer, once the
    watermark is ``interval`` past its bucket of ``width``; rows that come in after
    that never enter. State holds the rows of the range only. ``by`` spreads
    the rows over tasks; it does not change the range.
    """
    schema = StructType([*[_field(f, f"c{i}") for i, f in enumerate(df.schema)], StructField("op", StringType())])
    step = Trailing(_width_ms(interval), _width_ms(width), FLUSH, BUCKET_BYTES)
    out = _grouped(df, _names(by), ts, delay).transformWithStateInPandas(step, "rows binary", "Append", "EventTime").mapInArrow(_unpack, schema)
    return out.select(*[_back(f, f"c{i}").alias(f.name) for i, f in enumerate(df.schema)], "op")


def in_view(changes: DataFrame) -> DataFrame:
    """The rows of a table of changes (:func:`trailing_stream`) that entered and have not left, as often as they did."""
    cols = [c for c in changes.columns if c != "op"]
    n = F.sum(F.when(F.col("op") == "enter", 1).otherwise(-1))
    left = changes.groupBy(*cols).agg(n.alias("__sf_n")).where(F.col("__sf_n") > 0)
    return left.withColumn("__sf_n", F.explode(F.sequence(F.lit(1), F.col("__sf_n").cast("int")))).drop("__sf_n")
