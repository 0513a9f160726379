"""Row filters and cleaning.

Every filter is a column predicate Catalyst can push toward the scan. Filters
that drop input because it is malformed return the rejected rows too, so
counts of skipped rows are computed by Spark, not by a driver loop.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import compute_once
from ..functions.text import normalise_line
from .series import _names


def coords_ok(lat: str = "lat", lon: str = "lon") -> Column:
    """F1 predicate: lat in [-90, 90] and lon in [-180, 180], inclusive.

    NULL fails; NaN fails too (NaN sorts above every number in Spark).
    """
    # NaN > every number in Spark, so ``NaN <= 90`` is false: no isnan needed,
    # and plain range comparisons stay pushable to the scan.
    return F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)


def valid_coords(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """keep rows with valid coordinates."""
    return df.where(coords_ok(lat, lon))


def drop_missing(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """rows with any of ``cols`` NULL or NaN go to the rejects.

    Returns ``(kept, rejected)``; ``rejected`` carries a ``reason`` column.
    """
    dtypes = dict(df.dtypes)
    bad = F.lit(False)
    for c in cols:
        m = F.col(c).isNull()
        if dtypes.get(c) in ("double", "float"):
            m = m | F.isnan(F.col(c))
        bad = bad | m
    kept = df.where(~bad)
    rejected = df.where(bad).withColumn("reason", F.lit("missing:" + ",".join(cols)))
    return kept, rejected


def min_fields(df: DataFrame, fields: str, n: int) -> tuple[DataFrame, DataFrame]:
    """split messages with fewer than ``n`` fields off as rejects."""
    short = F.size(F.col(fields)) < F.lit(n)
    return (df.where(~short),
            df.where(short).withColumn("reason", F.lit(f"fields<{n}")))


def flag_rejects(df: DataFrame, typed: Mapping[str, str]) -> DataFrame:
    """F4, one pass: add ``reason`` (NULL when the row is fine). ``typed`` maps
    typed column -> raw text column; non-blank text that did not parse gives
    ``reason='bad:<col>'``."""
    reason = None
    for out, raw in typed.items():
        r = F.col(raw)
        bad = r.isNotNull() & (F.trim(r) != F.lit("")) & F.col(out).isNull()
        hit = F.when(bad, F.lit("bad:" + out))
        reason = hit if reason is None else F.coalesce(reason, hit)
    return df.withColumn("reason", reason)


def split_rejects(df: DataFrame, typed: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """``(kept rows, rejects with reason)`` -- see :func:`flag_rejects`."""
    flagged = flag_rejects(df, typed)
    return (flagged.where(F.col("reason").isNull()).drop("reason"),
            flagged.where(F.col("reason").isNotNull()))


def normalise_lines(df: DataFrame, line: str, sep: str = ";", decimal: str = ",",
                    out_sep: str = ",") -> tuple[DataFrame, DataFrame]:
    """P26 with rejects: ``(rows with the line rewritten, rejects)``; a line with a
    field that is no number is a reject (``bad:number``), a NULL line ``empty``."""
    out = "__sf_line"
    flagged = compute_once(df, **{out: normalise_line(line, sep, decimal, out_sep)})
    kept = flagged.where(F.col(out).isNotNull()).withColumn(line, F.col(out)).drop(out)
    rejects = flagged.where(F.col(out).isNull()).drop(out).withColumn(
        "reason", F.when(F.col(line).isNull(), F.lit("empty")).otherwise(F.lit("bad:number")))
    return kept, rejects


def skip_warmup(df: DataFrame, t: str, seconds: int = 1) -> DataFrame:
    """keep ``int(t) >= seconds`` (relative seconds, truncated toward zero).

    The comparison is on the column itself, so it reaches the scan. NaN and
    NULL times are dropped.
    """
    enough = F.col(t) >= F.lit(seconds) if seconds > 0 else F.col(t) > F.lit(seconds - 1)
    return df.where(enough & (F.col(t) <= F.lit(float("inf"))))


def skip_zero(df: DataFrame, raw: str) -> DataFrame:
    """drop rows whose raw first field is exactly the text ``0`` (``0.0`` stays)."""
    return df.where(F.col(raw) != F.lit("0"))


def fill_zero(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL / NaN numerics -> 0.0 (parity with producers that send 0)."""
    out = df
    for c in _names(cols):
        out = out.withColumn(
            c, F.when(F.col(c).isNull() | F.isnan(F.col(c)), F.lit(0.0)).otherwise(F.col(c)))
    return out


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """drop result rows lacking any of ``cols`` (e.g. mean lat / lon)."""
    return df.dropna(subset=list(cols))


def is_empty(df: DataFrame) -> bool:
    """cheap emptiness test (one row fetched at most)."""
    return df.isEmpty()
