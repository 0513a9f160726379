"""Custom stateful streaming operators (T6), keyed by series.

Both operators keep one small state row per key in the state store (RocksDB
provider, see :mod:`sensorflow.session`), so state scales with the number of
series, not with the rows; a fleet of sensors spreads over all tasks.

Inside a micro-batch the rows of a key are put in event-time order first,
so the result of a stream equals the batch operators
(:func:`operators.series.on_change`, :func:`operators.series.unseen`) when
rows of one key arrive in time order across batches.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.series import _names


def _changed(values: pd.Series, prev0) -> pd.Series:
    """Row differs from its predecessor (``prev0`` before the first row).

    Missing values are equal to each other. pandas shows both NULL and NaN of
    a double column as NaN, so a NULL <-> NaN transition is not a change here
    (it is one in Spark SQL); every other case follows ``NOT (a <=> b)``.
    """
    prev = values.shift(1)
    if len(values):
        prev.iloc[0] = prev0
    both_missing = values.isna() & prev.isna()
    equal = (values == prev).fillna(False).astype(bool)
    return ~(both_missing | equal)


def on_change_stream(df: DataFrame, by: str | Sequence[str], order: str | Sequence[str],
                     col: str) -> DataFrame:
    """Emit a reading only when ``col`` differs from the previous
    reading of its series (across micro-batches). Output mode: append."""
    by, order = _names(by), _names(order)
    schema = df.schema
    dtype = dict(df.dtypes)[col]
    state_schema = f"prev {dtype}"

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        prev0 = state.get[0] if state.exists else None
        pdf = pd.concat(list(pdfs), ignore_index=True).sort_values(order, kind="stable")
        pdf = pdf.reset_index(drop=True)
        keep = _changed(pdf[col], prev0)
        last = pdf[col].iloc[-1]
        state.update((None if pd.isna(last) else last.item() if hasattr(last, "item") else last,))
        if keep.any():
            yield pdf[keep.to_numpy()]

    return df.groupBy(*by).applyInPandasWithState(
        fn, outputStructType=schema, stateStructType=state_schema,
        outputMode="append", timeoutConf=GroupStateTimeout.NoTimeout)


def first_seen_stream(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                      expire_after_ms: int | None = None) -> DataFrame:
    """The first row of every key, emitted once; later rows of a seen
    key are never re-emitted (the first value stays).

    With ``expire_after_ms`` (and a watermark on the input) a key is
    forgotten once the watermark passes its last row by that much, bounding
    the state; without it every key is remembered.
    """
    key, order = _names(key), _names(order)
    schema = df.schema
    ts = order[0]
    timeout = (GroupStateTimeout.EventTimeTimeout if expire_after_ms
               else GroupStateTimeout.NoTimeout)

    def fn(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        pdf = pd.concat(list(pdfs), ignore_index=True)
        if not state.exists:
            first = pdf.sort_values(order, kind="stable").head(1)
            yield first
        before = state.get[0] if state.exists else None
        last = pdf[ts].max()
        newest = before if pd.isna(last) else int(pd.Timestamp(last).timestamp() * 1000)
        if before is not None:  # a late batch never shortens the life of a key
            newest = max(newest, before)
        state.update((newest,))
        if expire_after_ms:
            wanted = (newest or 0) + expire_after_ms
            # a timeout must lie after the current watermark
            state.setTimeoutTimestamp(max(wanted, state.getCurrentWatermarkMs() + 1))

    return df.groupBy(*key).applyInPandasWithState(
        fn, outputStructType=schema, stateStructType="newest_ms long",
        outputMode="append", timeoutConf=timeout)
