"""Loading the shared test tables and deriving the sensor views from them.

The generated ``events`` table stands in for a sensor stream: series key =
``event_type`` or ``user_id``, reading = ``value``, second axis =
``user_id``, ``event_id`` breaks ties. Coordinates are derived from integers
so every engine computes the same doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import use_utc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def lat_of(event_id: str = "event_id"):
    # Integer rule giving a latitude in [-100, 100), part of it
    # out of range on purpose.
    return (F.col(event_id) * F.lit(7919) % F.lit(20000)) / F.lit(100.0) - F.lit(100.0)


def lon_of(event_id: str = "event_id"):
    return (F.col(event_id) * F.lit(104729) % F.lit(40000)) / F.lit(100.0) - F.lit(200.0)


def geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, user_id, ts, lat, lon, alt)`` derived from events."""
    return events(spark, sf_dir).select(
        "event_id", "user_id", "ts",
        lat_of().alias("lat"), lon_of().alias("lon"), F.col("value").alias("alt"))


# The same derivation for the SQL oracle.
GEO_SQL = (
    "(select event_id, user_id, ts, "
    "(event_id*7919)%20000/100.0::double - 100.0::double as lat, "
    "(event_id*104729)%40000/100.0::double - 200.0::double as lon, "
    "value as alt from events)"
)
