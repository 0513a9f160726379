"""Wide -> long reshaping into points.

The mapping of wide columns to (measurement, field) is a short fixed list, so
it is applied with ``stack`` inside the projection: one generator node, no
join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timestamps import as_instant

# The surveyed gyroscope upload maps its four CSV columns
# (by position after the time column) to these measurements and fields.
GYRO_POINT_MAPPING: list[tuple[str, str, str]] = [
    ("gyro_x", "lx", "gx"),
    ("gyro_y", "ly", "gy"),
    ("gyro_z", "lz", "gz"),
    ("gyro_abs", "abs", "absolute"),
]


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def to_points(df: DataFrame, mapping: Sequence[tuple[str, str, str]], time: str,
              keep: Sequence[str] = (), precision: str = "us") -> DataFrame:
    """Wide rows -> (measurement, field, value, time[, time_ns]).

    ``mapping`` lists (measurement, field, source column). ``precision`` 'ms'
    truncates the time to milliseconds (the ms write precision); 'us' keeps it.
    A ``time_ns`` BIGINT is added for ns-precision consumers.
    """
    parts = []
    for measurement, fld, src in mapping:
        parts += [_sql_str(measurement), _sql_str(fld), f"CAST(`{src}` AS DOUBLE)"]
    gen = f"stack({len(mapping)}, {', '.join(parts)}) AS (measurement, field, value)"
    t = as_instant(time)
    if precision == "ms":
        t = F.timestamp_millis(F.unix_millis(t))
    elif precision == "s":
        t = F.timestamp_seconds(F.unix_seconds(t))
    long = df.select(*keep, t.alias("time"), F.expr(gen))
    return long.select(*keep, "measurement", "field", "value", "time",
                       (F.unix_micros("time") * F.lit(1000)).alias("time_ns"))


def points_flat(df: DataFrame) -> DataFrame:
    """R2: result tables -> (time, value) rows."""
    return df.select("time", "value")
