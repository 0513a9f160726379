"""Time column functions.

Timestamps are Spark TIMESTAMP (µs, UTC session). Nanoseconds exist only as
BIGINT columns next to them. All conversions are integer arithmetic where
the surveyed code would lose digits through float seconds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, _col, within_calendar

_UNIT_PER_SECOND = {"s": 1, "ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}


def floor_div(c: ColumnOrName, d: int) -> Column:
    """Exact floor division of a BIGINT (no detour through double, which
    drops digits of ns epochs above 2^53)."""
    v = _col(c).cast("bigint")
    exact = (v - F.pmod(v, F.lit(d))).cast("decimal(20,0)") / F.lit(d)
    return exact.cast("bigint")


def as_instant(ts: ColumnOrName) -> Column:
    """TIMESTAMP_NTZ (as stored in parquet) -> TIMESTAMP at the same UTC wall time."""
    return _col(ts).cast("timestamp")


def as_wall_clock(ts: ColumnOrName) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ, for results compared with zone-less engines."""
    return _col(ts).cast("timestamp_ntz")


def to_epoch(ts: ColumnOrName, unit: str = "ms") -> Column:
    """TIMESTAMP -> integer epoch in ``unit`` (ns is µs * 1000)."""
    c = as_instant(ts)
    if unit == "s":
        return F.unix_seconds(c)
    if unit == "ms":
        return F.unix_millis(c)
    if unit == "us":
        return F.unix_micros(c)
    if unit == "ns":
        return F.unix_micros(c) * F.lit(1000)
    raise ValueError(f"unknown unit {unit!r}")


def from_epoch(value: ColumnOrName, unit: str = "ms") -> Column:
    """Integer epoch in ``unit`` -> TIMESTAMP (ns truncated to µs); NULL outside years 1 to 9999."""
    if unit not in _UNIT_PER_SECOND:
        raise ValueError(f"unknown unit {unit!r}")
    v = _col(value).try_cast("bigint")
    if unit != "ns":  # every BIGINT of nanoseconds is in range
        v = within_calendar(v, _UNIT_PER_SECOND[unit])
    if unit == "s":
        return F.timestamp_seconds(v)
    if unit == "ms":
        return F.timestamp_millis(v)
    if unit == "us":
        return F.timestamp_micros(v)
    if unit == "ns":
        # Floor to the microsecond: ns values before 1970 round down too.
        return F.timestamp_micros(floor_div(v, 1000))
    raise ValueError(f"unknown unit {unit!r}")


def detect_unit(value: ColumnOrName) -> Column:
    """Guess the unit of an epoch integer from its magnitude.

    Spark accepts a millisecond value as seconds without complaint (year
    56858), so callers check the unit before converting.
    """
    a = F.abs(_col(value).try_cast("double"))
    return (F.when(a > F.lit(1e17), F.lit("ns"))
            .when(a > F.lit(1e14), F.lit("us"))
            .when(a > F.lit(1e11), F.lit("ms"))
            .when(a.isNotNull(), F.lit("s")))


def rebase(time_s: ColumnOrName, start_s: float | int, out: str = "ms") -> Column:
    """P5: relative seconds + start instant -> integer epoch (truncated).

    ``start_s`` is a parameter (never the wall clock), so a rerun gives the
    same instants. A time that is not finite, or too large, gives NULL.
    """
    scale = _UNIT_PER_SECOND[out]
    return ((F.lit(float(start_s)) + _col(time_s).try_cast("double")) * F.lit(scale)).try_cast("bigint")


def rebase_us(offset_us: ColumnOrName, start_us: int, out: str = "ms") -> Column:
    """P5, exact form: integer µs offset + start µs -> TIMESTAMP truncated to ``out``."""
    step = 1_000_000 // _UNIT_PER_SECOND[out] if out != "ns" else 1
    us = F.lit(start_us) + floor_div(_col(offset_us), step) * F.lit(step)
    return F.timestamp_micros(us)


def day_bucket(ts: ColumnOrName) -> Column:
    """UTC calendar day of an instant (session time zone is UTC)."""
    return F.to_date(as_instant(ts))


def window_key(prefix: str, start: ColumnOrName) -> Column:
    """``<prefix>:<window start in epoch ms>``."""
    return F.concat(F.lit(prefix + ":"), F.unix_millis(as_instant(start)).cast("string"))


def fmt_date(ts: ColumnOrName, pattern: str = "dd.MM.yyyy") -> Column:
    """Date text, e.g. ``dd.MM.yyyy`` or ``dd.MMMM yyyy`` (English month names)."""
    return F.date_format(_col(ts), pattern)


def rfc3339(ts: ColumnOrName) -> Column:
    """P20: RFC 3339 UTC text with microseconds, e.g. 2024-01-05T14:41:33.000000Z.

    Relies on the UTC session time zone (see ``session.use_utc``).
    """
    return F.concat(F.date_format(as_instant(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))


def to_zone(ts: ColumnOrName, zone: str) -> Column:
    """UTC instant -> wall-clock time in ``zone`` (TIMESTAMP_NTZ)."""
    return as_wall_clock(F.from_utc_timestamp(as_instant(ts), zone))


def zone_offset_minutes(ts: ColumnOrName, zone: str) -> Column:
    """Offset of ``zone`` from UTC at the instant, in minutes (e.g. 60 for CET)."""
    inst = as_instant(ts)
    local = F.from_utc_timestamp(inst, zone)
    return ((F.unix_micros(local) - F.unix_micros(inst)) / F.lit(60_000_000)).cast("int")


def offset_text(minutes: ColumnOrName) -> Column:
    """Minutes east of UTC -> ``+HH:MM`` text."""
    m = _col(minutes)
    sign = F.when(m < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(m)
    return F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((a % 60).cast("string"), 2, "0"))


def now_ns() -> Column:
    """Current instant in ns (µs precision; the JVM clock offers no more)."""
    return F.unix_micros(F.current_timestamp()) * F.lit(1000)


def session_zone() -> Column:
    """The session time zone as text (UTC for sensorflow sessions)."""
    return F.current_timezone()
