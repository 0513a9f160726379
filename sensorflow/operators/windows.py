"""Tumbling-window aggregates, batch and streaming.

``groupBy(window(...))`` is a hash aggregate with a partial (map-side) step:
each task ships one partial row per (key, window) it saw, so a hot sensor or a
busy second costs no more shuffle than a quiet one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import _names


def flatten_window(df: DataFrame, window: str = "window", start: str = "fenster_start",
                   end: str | None = "fenster_ende") -> DataFrame:
    """``window`` struct -> start (and end) columns, placed first."""
    cols = [F.col(f"{window}.start").alias(start)]
    if end:
        cols.append(F.col(f"{window}.end").alias(end))
    rest = [c for c in df.columns if c != window]
    return df.select(*cols, *rest)


def window_stats(
    df: DataFrame,
    ts: str,
    size: str,
    means: Sequence[str] | Mapping[str, str] = (),
    count_of: str | None = None,
    by: str | Sequence[str] | None = None,
    watermark: str | None = None,
    slide: str | None = None,
    start: str = "fenster_start",
    end: str | None = "fenster_ende",
    count_name: str = "n_samples",
    extra: Sequence[Column] = (),
    counts: bool = False,
) -> DataFrame:
    """A1-A4: per tumbling window (and per ``by`` series), the mean of each column
    in ``means`` and the non-NULL count of ``count_of``.

    ``means`` is a list (output ``avg_<c>``) or a mapping output -> column. With
    ``watermark`` the frame must be streaming-capable: ``ts`` is TIMESTAMP and
    late rows beyond the watermark are dropped (update/append modes).
    ``counts`` adds ``n_<mean>``, the non-NULL values behind each mean (the
    weights of :func:`track_summary`).
    """
    if watermark:
        df = df.withWatermark(ts, watermark)
    pairs = (list(means.items()) if isinstance(means, Mapping)
             else [(f"avg_{c}", c) for c in means])
    aggs = [F.avg(c).alias(out) for out, c in pairs]
    if counts:
        aggs += [F.count(c).alias(f"n_{out}") for out, c in pairs]
    if count_of is not None:
        aggs.append(F.count(count_of).alias(count_name))
    aggs.extend(extra)
    win = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(win.alias("window"), *_names(by)).agg(*aggs)
    return flatten_window(grouped, "window", start, end)


def window_mean(df: DataFrame, ts: str, size: str, cols: Sequence[str]) -> DataFrame:
    """A1 / A2: batch window means ordered by window (the chart table)."""
    return window_stats(df, ts, size, cols).orderBy("fenster_start")


def track_summary(df: DataFrame, cols: Sequence[str], n: str = "n_samples") -> DataFrame:
    """Mean of window means per column, unweighted (as the surveyed map
    summary does) and weighted by the values behind each mean: ``n_<column>``
    where the windows have it, else ``n`` (right when no value is NULL)."""
    aggs = [F.count(F.lit(1)).alias("n_windows")]
    for c in cols:
        weight = F.col(f"n_{c}" if f"n_{c}" in df.columns else n)
        w = F.when(F.col(c).isNotNull(), weight)
        aggs.append(F.avg(c).alias(f"{c}_avg"))
        aggs.append((F.sum(F.col(c) * weight) / F.sum(w)).alias(f"{c}_weighted"))
    return df.agg(*aggs)
