"""File scans (S1-S3, S7) with explicit string schemas and reject outputs.

Every scan reads text columns and types them with ``try_cast`` so a bad
value produces a reject row (with a reason) instead of failing the job or
silently turning into NULL. Files are split by Spark's file source: many
tasks per large file, header handled per file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.parse import to_number
from ..functions.text import split_lines

# Tokens that mean "no value" in the walk export (after trim).
WALK_NULL_TOKENS = ("", "NaN", "nan", "null")


def _reason_any(checks: Sequence[tuple[Column, str]]) -> Column:
    reason = None
    for cond, why in checks:
        reason = F.when(cond, F.lit(why)) if reason is None else reason.when(cond, F.lit(why))
    return reason


def _finite(v: Column) -> Column:
    """NULL for NaN and infinities: they are no readings, and one would spoil every mean."""
    return F.when(F.abs(v) < F.lit(float("inf")), v)


def read_sensor_csv(spark: SparkSession, path: str, columns: Sequence[str] = schemas.GYRO_COLUMNS,
                    sep: str = ";", decimal: str = ",") -> tuple[DataFrame, DataFrame]:
    """Positional CSV with decimal comma -> ``(typed rows, rejects)``.

    The header line is skipped and never trusted for names: columns are named
    by position. Numbers may use an exponent (``1,25E-2``). A row with a
    non-blank field that is not a finite number is a reject.
    """
    raw = (spark.read.schema(schemas.all_strings(*columns))
           .option("header", True).option("sep", sep).csv(path))
    typed = raw.select(*[F.col(c).alias(f"__raw_{c}") for c in columns],
                       *[_finite(to_number(c, decimal)).alias(c) for c in columns])
    checks = [(F.col(f"__raw_{c}").isNotNull() & (F.trim(f"__raw_{c}") != "") & F.col(c).isNull(),
               f"bad:{c}") for c in columns]
    flagged = typed.withColumn("reason", _reason_any(checks))
    rejects = flagged.where(F.col("reason").isNotNull()).select(
        F.concat_ws(sep, *[F.coalesce(F.col(f"__raw_{c}"), F.lit("")) for c in columns]).alias("raw"),
        "reason")
    kept = flagged.where(F.col("reason").isNull()).select(*columns)
    return kept, rejects


def read_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Raw text lines of delimited files; the header line of every file is dropped.

    The CSV reader with quoting off and a separator that never occurs yields
    one string column per line, and it knows which split holds a file's
    header, so large files still read in parallel.
    """
    return (spark.read.schema("line string").option("header", header)
            .option("sep", "\u0001").option("quote", "").option("escape", "")
            .csv(path))


def read_walk_csv(spark: SparkSession, path: str,
                  null_tokens: Sequence[str] = WALK_NULL_TOKENS,
                  min_fields: int = 6) -> tuple[DataFrame, DataFrame]:
    """Walk export -> ``(rows, rejects)``.

    Columns 0, 1, 2, 3, 5 (time_s, lat, lon, alt, speed) are used. Rows with
    fewer than ``min_fields`` fields, a non-numeric value (reason ``bad:*``),
    or without time / lat / lon (reason ``missing``) are rejects; only the
    last kind counts as "skipped" in the surveyed producer.
    """
    tokens = list(null_tokens)
    lines = read_lines(spark, path)
    f = F.split(F.col("line"), ",")
    used = {"time_s": 0, "lat": 1, "lon": 2, "alt": 3, "speed": 5}

    def raw(i):
        v = F.trim(F.get(f, F.lit(i)))
        return F.when(~v.isin(*tokens), v)

    staged = lines.select("line", F.size(f).alias("n_fields"),
                          *[raw(i).alias(f"__raw_{c}") for c, i in used.items()])
    typed = staged.select("line", "n_fields", *[f"__raw_{c}" for c in used],
                          *[F.col(f"__raw_{c}").try_cast("double").alias(c) for c in used])
    checks = [(F.col("n_fields") < min_fields, f"fields<{min_fields}")]
    checks += [(F.col(f"__raw_{c}").isNotNull() & F.col(c).isNull(), f"bad:{c}") for c in used]
    checks += [(F.col("time_s").isNull() | F.col("lat").isNull() | F.col("lon").isNull(),
                "missing")]
    flagged = typed.withColumn("reason", _reason_any(checks))
    kept = flagged.where(F.col("reason").isNull()).select(*used)
    rejects = flagged.where(F.col("reason").isNotNull()).select(F.col("line").alias("raw"), "reason")
    return kept, rejects


def read_light_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``(time_ns, lx)`` light export -> ``(rows, rejects)``.

    Rows whose time field is exactly the text ``0`` are skipped (``0.0`` is
    kept: the check is on the text). ``time_ns`` stays an exact BIGINT;
    ``time`` is the µs timestamp next to it.
    """
    raw = spark.read.schema(schemas.LIGHT_CSV).option("header", True).csv(path)
    raw = raw.where(F.col("time_raw").isNull() | (F.col("time_raw") != F.lit("0")))
    t = F.trim("time_raw")
    ns = F.coalesce(t.try_cast("bigint"), t.try_cast("double").try_cast("bigint"))
    typed = raw.select("time_raw", "lx_raw", ns.alias("time_ns"),
                       _finite(F.trim("lx_raw").try_cast("double")).alias("lx"))
    checks = [(F.col("time_ns").isNull(), "bad:time"),
              (F.col("lx").isNull() & F.col("lx_raw").isNotNull(), "bad:lx")]
    flagged = typed.withColumn("reason", _reason_any(checks))
    from ..functions.timestamps import from_epoch
    kept = flagged.where(F.col("reason").isNull()).select(
        "time_ns", from_epoch("time_ns", "ns").alias("time"), "lx")
    rejects = flagged.where(F.col("reason").isNotNull()).select(
        F.concat_ws(",", F.coalesce("time_raw", F.lit("")), F.coalesce("lx_raw", F.lit(""))).alias("raw"),
        "reason")
    return kept, rejects


def read_dumps(spark: SparkSession, path: str) -> DataFrame:
    """One text dump per file -> ``(dump_id, text, modified)``.

    ``dump_id`` is the file path, ``modified`` the file's modification time.
    """
    return (spark.read.text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("dump_id"), F.col("value").alias("text"),
                    F.col("_metadata.file_modification_time").alias("modified")))


def read_dump_lines(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """S7 table form: ``(dump_id, line_no, line)`` for the long extraction.

    Lines are read with the plain text source, so one large dump is split over
    many tasks; exact 0-based line numbers come from the row position inside
    each (file, input partition) plus the line counts of the file's earlier
    partitions (a running sum over a table of one row per file split). Line
    breaks are ``\\n``, ``\\r\\n`` and ``\\r``. ``whole_files=True`` reads each file as
    one row instead (all ``splitlines`` breaks; for dumps of bounded size).
    """
    if whole_files:
        return read_dumps(spark, path).select(
            "dump_id", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))
    from pyspark.sql import Window
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("dump_id"), F.col("value").alias("line"),
        F.monotonically_increasing_id().alias("__sf_id"))
    raw = raw.withColumn("__sf_part", F.shiftright("__sf_id", 33))
    splits = raw.groupBy("dump_id", "__sf_part").agg(
        F.min("__sf_id").alias("__sf_first"), F.count(F.lit(1)).alias("__sf_n"))
    before = Window.partitionBy("dump_id").orderBy("__sf_part").rowsBetween(
        Window.unboundedPreceding, -1)
    splits = splits.withColumn("__sf_before", F.coalesce(F.sum("__sf_n").over(before), F.lit(0)))
    numbered = raw.join(splits, on=["dump_id", "__sf_part"])
    return numbered.select(
        "dump_id",
        (F.col("__sf_before") + F.col("__sf_id") - F.col("__sf_first")).alias("line_no"),
        "line")
