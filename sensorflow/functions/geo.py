"""Geometry column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, _col

# Fixed value: a semicircle is 180 / 2^31 degrees.
DEGREES_PER_SEMICIRCLE = 180.0 / 2 ** 31


def semicircles_to_deg(c: ColumnOrName) -> Column:
    """Integer semicircles -> degrees (1073741824 -> 90.0)."""
    return _col(c).cast("double") * F.lit(DEGREES_PER_SEMICIRCLE)


def magnitude(*axes: ColumnOrName) -> Column:
    """P10: Euclidean norm sqrt(x² + y² + z²), summed left to right."""
    total = None
    for a in axes:
        sq = _col(a).cast("double") * _col(a).cast("double")
        total = sq if total is None else total + sq
    return F.sqrt(total)
