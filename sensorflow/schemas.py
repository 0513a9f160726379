"""Explicit schemas of every dataset the library reads or writes.

Text inputs are scanned as strings and typed with ``try_cast`` afterwards, so
one malformed value produces a reject row instead of a failed job.
"""

from __future__ import annotations

from pyspark.sql import types as T


def all_strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Gyroscope CSV, positional columns (header names are not trusted).
GYRO_COLUMNS = ("time_s", "gx", "gy", "gz", "absolute")
GYRO_CSV = all_strings(*GYRO_COLUMNS)

# Walk CSV, 11 columns in file order; columns 0, 1, 2, 3, 5 are used.
WALK_COLUMNS = (
    "time_s", "lat", "lon", "alt", "alt_wgs84", "speed", "direction",
    "distance_km", "h_accuracy", "v_accuracy", "satellites",
)
WALK_CSV = all_strings(*WALK_COLUMNS)
WALK_USED = ("time_s", "lat", "lon", "alt", "speed")

# D3: light CSV.
LIGHT_CSV = all_strings("time_raw", "lx_raw")

# Kafka-shaped message rows (S4 / K1); the offline stand-in uses the same.
MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("timestampType", T.IntegerType(), True),
])

# Decoded fitness records (positions in semicircles).
FIT_RECORD = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("position_lat", T.LongType(), True),
    T.StructField("position_long", T.LongType(), True),
    T.StructField("enhanced_altitude", T.DoubleType(), True),
    T.StructField("heart_rate", T.IntegerType(), True),
    T.StructField("temperature", T.IntegerType(), True),
])

# JSON payloads; numbers may arrive as text, so all fields are read
# as strings and typed afterwards.
GYRO_PAYLOAD = all_strings("time", "x", "y", "z")
LOCATION_PAYLOAD = all_strings("time", "lat", "lon", "altitude", "speed")
READING_PAYLOAD = all_strings("id", "time_sec", "lx")

# Parsed streams.
GYRO_ROW = T.StructType([
    T.StructField("zeit", T.TimestampType(), True),
    *[T.StructField(c, T.DoubleType(), True) for c in ("gx", "gy", "gz", "absolute")],
])
LOCATION_ROW = T.StructType([
    T.StructField("zeit", T.TimestampType(), True),
    *[T.StructField(c, T.DoubleType(), True)
      for c in ("lat", "lon", "alt", "speed", "hr", "temp")],
])

# Long-form points.
POINT = T.StructType([
    T.StructField("measurement", T.StringType(), False),
    T.StructField("field", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("time", T.TimestampType(), False),
    T.StructField("time_ns", T.LongType(), True),
])

# Readings table, key ((sensor_id, day_bucket), ts).
READING = T.StructType([
    T.StructField("sensor_id", T.StringType(), False),
    T.StructField("day_bucket", T.DateType(), False),
    T.StructField("ts", T.TimestampType(), False),
    T.StructField("lx", T.DoubleType(), True),
])

# Latest-window table (keyed cache); epoch_id and expires_at are ours.
LATEST = T.StructType([
    T.StructField("key", T.StringType(), False),
    T.StructField("fenster_start", T.TimestampType(), True),
    T.StructField("fenster_ende", T.TimestampType(), True),
    T.StructField("avg_absolute", T.DoubleType(), True),
    T.StructField("avg_gx", T.DoubleType(), True),
    T.StructField("avg_gy", T.DoubleType(), True),
    T.StructField("avg_gz", T.DoubleType(), True),
    T.StructField("n_samples", T.LongType(), True),
    T.StructField("epoch_id", T.LongType(), False),
    T.StructField("expires_at", T.TimestampType(), True),
])

# Word-count table.
WORTE = T.StructType([
    T.StructField("wort", T.StringType(), False),
    T.StructField("anz", T.IntegerType(), True),
])

# Rejected input rows: the raw text and why it was rejected.
REJECT = T.StructType([
    T.StructField("raw", T.StringType(), True),
    T.StructField("reason", T.StringType(), False),
])
