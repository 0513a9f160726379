"""Column functions that turn message text into typed columns.

All of them are plain Catalyst expressions: they stay inside whole-stage
codegen and never fail a query on a malformed value (``get`` and
``try_cast`` return NULL instead of raising under ANSI mode).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_fields(value: ColumnOrName, sep: str = ",") -> Column:
    """binary/text message -> array of field strings."""
    return F.split(_col(value).cast("string"), sep)


def field(fields: ColumnOrName, i: int, dtype: str = "double") -> Column:
    """Field ``i`` of a split message, typed; NULL when absent or bad."""
    raw = F.get(_col(fields), F.lit(i))
    return F.trim(raw).try_cast(dtype)


def raw_field(fields: ColumnOrName, i: int) -> Column:
    """Field ``i`` as text (NULL when the message is too short)."""
    return F.get(_col(fields), F.lit(i))


def event_time(ms: ColumnOrName, resolution: str = "second") -> Column:
    """Epoch milliseconds -> TIMESTAMP.

    ``resolution='second'`` truncates toward zero to whole seconds, the way the
    surveyed jobs build their event time; ``'ms'`` keeps the milliseconds.
    """
    # an instant outside the calendar (e.g. nanoseconds sent as milliseconds)
    # is NULL, which the parsers reject; the conversion itself would abort
    ms = within_calendar(_col(ms).try_cast("bigint"), 1000)
    if resolution == "second":
        # Integer division truncates toward zero, also for negative values.
        return F.timestamp_seconds(_div_trunc(ms, 1000))
    if resolution == "ms":
        return F.timestamp_millis(ms)
    raise ValueError(f"unknown resolution {resolution!r}")


# Seconds of 0001-01-01 and 9999-12-31 23:59:59 UTC.
FIRST_SECOND, LAST_SECOND = -62_135_596_800, 253_402_300_799


def within_calendar(v: Column, per_second: int = 1) -> Column:
    """``v`` (an epoch in units of 1/``per_second`` s) if it lies in years 1 to 9999, else NULL.

    NaN sorts above every number, so it is NULL too.
    """
    return F.when(v.between(FIRST_SECOND * per_second, LAST_SECOND * per_second), v)


def _div_trunc(c: Column, d: int) -> Column:
    # ``(c / d).cast('bigint')`` truncates toward zero, like Python's int().
    return (c / F.lit(d)).cast("bigint")


def event_time_s(seconds: ColumnOrName) -> Column:
    """Float epoch seconds -> TIMESTAMP truncated to whole seconds; NULL when not finite or out of range."""
    return F.timestamp_seconds(within_calendar(_col(seconds).try_cast("double")).cast("bigint"))


def with_default(c: ColumnOrName, default) -> Column:
    """Value, or ``default`` when the value is absent or NULL."""
    d = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(_col(c), d)


def to_number(c: ColumnOrName, decimal: str = ".") -> Column:
    """Text -> double; ``decimal=','`` reads the decimal comma."""
    text = F.trim(_col(c))
    if decimal != ".":
        text = F.translate(text, decimal, ".")
    return text.try_cast("double")


def is_bad_number(raw: ColumnOrName, typed: ColumnOrName) -> Column:
    """True when a non-blank text did not parse into a number."""
    raw_c = _col(raw)
    return (raw_c.isNotNull() & (F.trim(raw_c) != F.lit("")) & _col(typed).isNull())


def compute_once(df, **exprs: Column):
    """Evaluate expensive per-row expressions exactly once.

    Catalyst pushes filters below projections by substituting the projected
    expression into the condition, and a Filter does no common-subexpression
    elimination: a validity check that looks at a split message ten times
    splits it ten times. Producing the values from a one-row generator
    (``inline(array(struct(...)))``) stores them once per input row; filters
    and projections above refer to the stored columns. The generator stays in
    the same whole-stage-codegen span as the scan.
    """
    from pyspark.sql import functions as F_
    packed = F_.struct(*[e.alias(n) for n, e in exprs.items()])
    return df.select("*", F_.inline(F_.array(packed)))
