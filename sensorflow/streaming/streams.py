"""Structured Streaming: sinks, triggers, checkpoints, lifecycle.

* Windowed aggregation with a watermark is :func:`operators.windows.window_stats`
  with ``watermark=...`` (T1, T2).
* :func:`writer` wires output mode, trigger and a checkpoint under the shared
  ``spark.checkpoint.dir`` (T3, T4, T9). A restarted query resumes from its
  checkpoint instead of replaying the topic from the earliest offset.
* Late rows (T5): in ``update`` and ``append`` mode rows older than the
  watermark are dropped (``numRowsDroppedByWatermark`` in the progress); in
  ``complete`` mode every row is merged and state is never evicted, so
  ``complete`` is for small bounded results only.
* :func:`upsert_stream` is the keyed latest-window sink (K3): each micro-batch
  is written by the executors as its own version, idempotent per epoch.
* The shuffle width of a stateful query (``spark.sql.shuffle.partitions`` at
  its first start) is stored in its checkpoint and cannot change later: size
  it for the expected number of series before the first run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from ..session import checkpoint_path
from ..sinks.tables import fan_out, upsert_batch


def writer(df: DataFrame, name: str, mode: str = "update",
           trigger: str | None = "1 second", available_now: bool = False,
           checkpoint: str | None = None) -> DataStreamWriter:
    """A stream writer with output mode, trigger and checkpoint set.

    ``trigger`` is a processing-time interval; ``available_now`` processes
    what is there in as many micro-batches as the source limits allow and
    stops (tests, backfills).
    """
    count_late_rows(df.sparkSession)
    w = df.writeStream.queryName(name).outputMode(mode)
    w = w.option("checkpointLocation", checkpoint or checkpoint_path(df.sparkSession, name))
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w


def to_memory(df: DataFrame, name: str, mode: str = "complete", trigger: str | None = "5 seconds",
              available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """K2: named in-memory result table, queryable with ``spark.sql``.

    The memory sink keeps every row on the driver: only for small results
    (window tables of one device, dashboards).
    """
    return writer(df, name, mode, trigger, available_now, checkpoint).format("memory").start()


def to_table(df: DataFrame, name: str, path: str, mode: str = "append",
             trigger: str | None = "1 second", available_now: bool = False,
             partition_by: Sequence[str] = (), checkpoint: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet folder (exactly-once via the file sink log)."""
    w = writer(df, name, mode, trigger, available_now, checkpoint).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path)


def for_each_batch(df: DataFrame, name: str, fn: Callable[[DataFrame, int], None],
                   mode: str = "update", trigger: str | None = "1 second",
                   available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """Call ``fn(batch_df, epoch_id)`` per micro-batch (runs on the driver,
    the work inside stays distributed). Empty batches are skipped (F14)."""
    def guarded(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        fn(batch, epoch_id)
    return writer(df, name, mode, trigger, available_now, checkpoint).foreachBatch(guarded).start()


def run_start() -> int:
    """Start of a run in epoch milliseconds, the first part of the versions it writes."""
    return time.time_ns() // 1_000_000


def upsert_stream(df: DataFrame, name: str, path: str, key_prefix: str, ttl_s: int | None = 120,
                  now: Column | None = None, trigger: str | None = "1 second",
                  available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """K3 + K4: changed windows of every micro-batch -> keyed latest-window table.

    The run's start is the first part of the version: after a restart with a
    new checkpoint, whose epochs begin at 0 again, the new windows still win.
    """
    run_id = run_start()
    return for_each_batch(
        df, name, lambda b, e: upsert_batch(b, e, path, key_prefix, ttl_s, now, run_id),
        mode="update", trigger=trigger, available_now=available_now, checkpoint=checkpoint)


def fan_out_stream(df: DataFrame, name: str, sinks: Sequence[Callable[[DataFrame, int], None]],
                   mode: str = "append", trigger: str | None = "1 second",
                   available_now: bool = False, checkpoint: str | None = None) -> StreamingQuery:
    """K7: every micro-batch to several sinks; all are tried, failures raised after."""
    def each(batch: DataFrame, epoch_id: int) -> None:
        fan_out(batch, [lambda d, s=s: s(d, epoch_id) for s in sinks])
    return for_each_batch(df, name, each, mode, trigger, available_now, checkpoint)


def start(df: DataFrame, sink, name: str, mode: str = "update",
          trigger: str | None = "1 second", checkpoint: str | None = None,
          path: str | None = None, available_now: bool = False,
          options: dict[str, str] | None = None) -> StreamingQuery:
    """T3-T5, T7, T9 in one call: ``sink`` is 'memory', 'parquet' (needs
    ``path``), 'kafka' (``options`` carry the servers and topic), 'noop', or a
    ``fn(batch_df, epoch_id)`` callable run per micro-batch."""
    if callable(sink):
        return for_each_batch(df, name, sink, mode, trigger, available_now, checkpoint)
    if sink == "memory":
        return to_memory(df, name, mode, trigger, available_now, checkpoint)
    if sink == "parquet":
        if path is None:
            raise ValueError("sink 'parquet' needs path")
        return to_table(df, name, path, mode, trigger, available_now, checkpoint=checkpoint)
    w = writer(df, name, mode, trigger, available_now, checkpoint).format(sink)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start()


def drop_repeated(df: DataFrame, keys: Sequence[str], ts: str, watermark: str) -> DataFrame:
    """Q7 option: drop repeated samples (same keys and instant) of a stream.

    State per key lives until the watermark passes it, so it stays bounded.
    """
    return df.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([*keys, ts])


def run_stream(query: StreamingQuery, on_stop: Callable[[], None] | None = None,
               timeout_s: float | None = None) -> None:
    """Wait for the query (or ``timeout_s``); always stop it and run ``on_stop``."""
    try:
        if timeout_s is None:
            query.awaitTermination()
        else:
            query.awaitTermination(timeout_s)
    except KeyboardInterrupt:
        pass
    finally:
        try:
            query.stop()
        finally:
            if on_stop is not None:
                on_stop()


class LateRows(StreamingQueryListener):
    """Rows dropped by the watermark, per query run and micro-batch, from every progress report."""

    def __init__(self) -> None:
        self.dropped: dict[str, dict[int, int]] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's interface
        self.dropped.setdefault(str(event.runId), {})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        n = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators)
        batches = self.dropped.setdefault(str(p.runId), {})
        batches[p.batchId] = max(n, batches.get(p.batchId, 0))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


_late: dict[int, LateRows] = {}


def count_late_rows(spark: SparkSession) -> LateRows:
    """The session's counter of late rows; queries started after its first use are counted."""
    key = id(spark._jsparkSession)
    if key not in _late:
        _late[key] = LateRows()
        spark.streams.addListener(_late[key])
    return _late[key]


def dropped_late_rows(query: StreamingQuery) -> int:
    """T5: rows dropped by the watermark since this run of the query began.

    :func:`writer` counts every progress report from the start; the retained
    reports add those that the listener has not been told of yet.
    """
    run = str(query.runId)
    seen: dict[int, int] = {}
    for counter in _late.values():
        seen |= counter.dropped.get(run, {})
    for p in query.recentProgress:
        ops = p.get("stateOperators", []) if isinstance(p, dict) else p.stateOperators
        batch = p["batchId"] if isinstance(p, dict) else p.batchId
        n = sum(int((op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark) or 0) for op in ops)
        seen[batch] = max(n, seen.get(batch, 0))
    return sum(seen.values())
