"""Message parsing with layout dispatch and rejects.

A message row carries CSV text in ``value`` (binary or string). Gyroscope
messages have 5 fields; the location topic carries walk messages (5 fields:
ts, lat, lon, alt, speed) and fitness messages (6 fields: ts, lat, lon, alt,
hr, temp). Parsing dispatches on the field count instead of trusting a fixed
position, and every row that cannot be typed lands in the rejects with a
reason, so the job never fails on one bad message.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.geo import magnitude
from ..functions.parse import compute_once, event_time, field, raw_field, split_fields

GYRO_FIELDS = ("gx", "gy", "gz", "absolute")


def _bad_any(fields: str, positions: list[int]) -> Column:
    bad = F.lit(False)
    for i in positions:
        raw = raw_field(fields, i)
        bad = bad | (raw.isNotNull() & (F.trim(raw) != F.lit("")) & field(fields, i).isNull())
    return bad


def parse_gyro(df: DataFrame, value: str = "value", resolution: str = "second",
               keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Gyroscope messages ``ts_ms,gx,gy,gz,abs`` -> (zeit, gx, gy, gz, absolute).

    Returns ``(parsed, rejects)``; rejects keep the raw text and a reason.
    """
    f = "__sf_f"
    split = compute_once(df.select(*keep, F.col(value).cast("string").alias("raw")),
                         **{f: split_fields("raw")})
    reason = (F.when(F.col("raw").isNull() | (F.trim("raw") == F.lit("")), F.lit("empty"))
              .when(F.size(f) < F.lit(5), F.lit("fields<5"))
              .when(event_time(field(f, 0, "bigint"), resolution).isNull(), F.lit("bad:time"))
              .when(_bad_any(f, [1, 2, 3, 4]), F.lit("bad:number")))
    flagged = split.withColumn("reason", reason)
    parsed = flagged.where(F.col("reason").isNull()).select(
        *keep,
        event_time(field(f, 0, "bigint"), resolution).alias("zeit"),
        *[field(f, i + 1).alias(c) for i, c in enumerate(GYRO_FIELDS)],
    )
    rejects = flagged.where(F.col("reason").isNotNull()).select(*keep, "raw", "reason")
    return parsed, rejects


def flag_location(df: DataFrame, value: str = "value", resolution: str = "second",
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """Location messages of both layouts, one pass, every row kept:
    (keep..., kind, zeit, lat, lon, alt, speed, hr, temp, raw, reason).

    5 fields -> ``kind='walk'`` with speed; 6 fields -> ``kind='fitness'`` with
    hr and temp; any other count, a bad time or a non-numeric field -> ``reason``
    is set and kind / values are NULL.
    """
    f = "__sf_f"
    split = compute_once(df.select(*keep, F.col(value).cast("string").alias("raw")),
                         **{f: split_fields("raw")})
    n = F.size(f)
    kind = F.when(n == 5, F.lit("walk")).when(n == 6, F.lit("fitness"))
    reason = (F.when(F.col("raw").isNull() | (F.trim("raw") == F.lit("")), F.lit("empty"))
              .when(kind.isNull(), F.format_string("fields=%d", n))
              .when(event_time(field(f, 0, "bigint"), resolution).isNull(), F.lit("bad:time"))
              .when(_bad_any(f, [1, 2, 3, 4]) | ((n == 6) & _bad_any(f, [5])),
                    F.lit("bad:number")))
    # stored once per row: filters on the values below (e.g. coordinates)
    # then read a column instead of re-deriving the reason each time
    flagged = compute_once(split, kind=kind, reason=reason)
    ok = F.col("reason").isNull()
    walk = F.col("kind") == F.lit("walk")

    def v(c):
        return F.when(ok, c)
    return flagged.select(
        *keep,
        v(F.col("kind")).alias("kind"),
        v(event_time(field(f, 0, "bigint"), resolution)).alias("zeit"),
        v(field(f, 1)).alias("lat"),
        v(field(f, 2)).alias("lon"),
        v(field(f, 3)).alias("alt"),
        v(F.when(walk, field(f, 4))).alias("speed"),
        v(F.when(~walk, field(f, 4))).alias("hr"),
        v(F.when(~walk, field(f, 5))).alias("temp"),
        "raw", "reason",
    )


def parse_location(df: DataFrame, value: str = "value", resolution: str = "second",
                   keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Location messages of both layouts -> ``(rows, rejects)`` (see :func:`flag_location`)."""
    flagged = flag_location(df, value, resolution, keep)
    parsed = flagged.where(F.col("reason").isNull()).drop("raw", "reason")
    rejects = flagged.where(F.col("reason").isNotNull()).select(*keep, "raw", "reason")
    return parsed, rejects


_PAYLOADS = {
    "gyro": (schemas.GYRO_PAYLOAD, {"x": "gx", "y": "gy", "z": "gz"}),
    "location": (schemas.LOCATION_PAYLOAD, {"lat": "lat", "lon": "lon", "altitude": "alt", "speed": "speed"}),
    "reading": (schemas.READING_PAYLOAD, {"time_sec": "time_sec", "lx": "lx"}),
}


def flag_payload(df: DataFrame, kind: str, body: str = "body", now: Column | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """S6 / P11, one pass: JSON request bodies -> typed rows, all kept, with ``raw`` and ``reason``.

    ``kind`` is 'gyro' (time, x, y, z; default now, 0, 0, 0, plus the
    magnitude), 'location' (time, lat, lon, altitude, speed) or 'reading'
    (id default 'light', time_sec, lx: both required). A default stands for an
    absent field or an explicit JSON null only. A body that is no JSON object
    (``bad:json``; ``empty`` when blank), a value that is no finite number and
    a time outside the calendar (``bad:<field>``) give a reason and NULL
    values. Numbers may arrive as text. Each body is parsed once.
    """
    if kind not in _PAYLOADS:
        raise ValueError(f"unknown payload kind {kind!r}")
    schema, fields = _PAYLOADS[kind]
    corrupt = "__sf_corrupt"
    parsed = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    j = "__sf_j"
    staged = compute_once(
        df.select(*keep, F.col(body).cast("string").alias("raw")),
        **{j: F.from_json("raw", parsed, {"columnNameOfCorruptRecord": corrupt})})

    def given(name: str) -> Column:
        return F.col(f"{j}.{name}").cast("string")

    def number(name: str) -> Column:
        v = given(name).try_cast("double")
        return F.when(F.abs(v) < F.lit(float("inf")), v)

    blank = F.col("raw").isNull() | (F.trim("raw") == F.lit(""))
    reason = (F.when(blank, F.lit("empty"))
              .when(~F.ltrim("raw").startswith("{") | F.col(j).isNull()
                    | F.col(f"{j}.{corrupt}").isNotNull(), F.lit("bad:json")))
    if kind != "reading":
        t = F.coalesce(event_time(given("time"), "ms"), event_time(F.floor(number("time")), "ms"))
        reason = reason.when(given("time").isNotNull() & t.isNull(), F.lit("bad:time"))
    for name in fields:
        missing = number(name).isNull() if kind == "reading" else given(name).isNotNull() & number(name).isNull()
        reason = reason.when(missing, F.lit(f"bad:{name}"))
    flagged = compute_once(staged, reason=reason)
    ok = F.col("reason").isNull()

    def v(c: Column) -> Column:
        return F.when(ok, c)

    if kind == "reading":
        values = [v(F.coalesce(given("id"), F.lit("light"))).alias("sensor_id"),
                  *[v(number(n)).alias(o) for n, o in fields.items()]]
    else:
        stamp = F.coalesce(t, now if now is not None else F.current_timestamp())
        numbers = {o: F.coalesce(number(n), F.lit(0.0)) for n, o in fields.items()}
        values = [v(stamp).alias("zeit"), *[v(c).alias(o) for o, c in numbers.items()]]
        if kind == "gyro":
            values.append(v(magnitude(*numbers.values())).alias("absolute"))
    return flagged.select(*keep, *values, "raw", "reason")


def parse_payload(df: DataFrame, kind: str, body: str = "body",
                  now: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The usable rows of :func:`flag_payload`."""
    return flag_payload(df, kind, body, now, keep).where(F.col("reason").isNull()).drop("raw", "reason")


def payload_rejects(df: DataFrame, kind: str, body: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Bodies that give no row, as ``raw`` and ``reason``."""
    return flag_payload(df, kind, body, None, keep).where(F.col("reason").isNotNull()).select(*keep, "raw", "reason")


def json_field(c: str | Column, name: str, dtype: str = "int") -> Column:
    """Typed top-level field of a JSON text column (NULL when absent or bad)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.get_json_object(col, f"$.{name}").try_cast(dtype)
