"""Parity queries: every operator run over the whole shared tables.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching SQL in :mod:`sensorflow.plans.oracle`.
Averages are rounded to 6 decimals, timestamps are returned as
TIMESTAMP_NTZ (UTC wall time), orderings always carry a tie-breaker.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.formats import encode, fixed, fmt_num
from ..functions.geo import magnitude
from ..functions.parse import event_time_s
from ..functions.text import normalise_line
from ..functions.timestamps import (as_instant, as_wall_clock, day_bucket, detect_unit,
                                    fmt_date, from_epoch, offset_text, rebase, rfc3339, to_zone,
                                    window_key, zone_offset_minutes)
from ..operators import clean, series
from ..operators.extract import with_dump_value
from ..operators.messages import (flag_location, flag_payload, json_field, parse_gyro,
                                  parse_payload)
from ..operators.reshape import to_points
from ..operators.windows import track_summary, window_stats
from ..sinks.tables import not_expired, with_ttl
from ..operators.counts import outcome_counts
from ..sources.tables import flag_fit, time_range
from .dumps import dumps_from_events
from .tables import events, geo

ORDER = ["ts", "event_id"]
START_MS = 1_700_000_000_000


def _r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _day(c: str):
    # Days leave the parity queries as midnight TIMESTAMP_NTZ, the one temporal
    # type every result here uses (DATE converts differently per client).
    return F.col(c).cast("timestamp_ntz").alias(c)


def gyro_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events encoded as gyroscope messages (value = CSV text, as on the topic).

    Every axis is a sum of the 2-decimal ``value`` and the integer
    ``user_id``, so each one survives the ``%.6f`` text round trip exactly
    and window means have no rounding ties at 6 decimals for fewer than 32
    samples per window (a float-summation-order artefact otherwise).
    """
    ev = events(spark, sf_dir)
    msg = encode({
        "ts_ms": F.unix_millis(as_instant("ts")),
        "gx": F.col("value"),
        "gy": F.col("user_id").cast("double"),
        "gz": F.col("value") - F.col("user_id"),
        "absolute": F.col("value") + F.col("user_id"),
    }, "gyro")
    return ev.select("event_id", msg.cast("binary").alias("value"))


def window_stats_query(spark, sf_dir):
    """Flagship: encode -> parse -> 1 h tumbling windows, four means + count."""
    parsed, _ = parse_gyro(gyro_messages(spark, sf_dir))
    out = window_stats(parsed, "zeit", "1 hour", ["absolute", "gx", "gy", "gz"],
                       count_of="absolute")
    return out.select(
        as_wall_clock("fenster_start").alias("fenster_start"),
        as_wall_clock("fenster_ende").alias("fenster_ende"),
        *[_r6(f"avg_{c}").alias(f"avg_{c}") for c in ("absolute", "gx", "gy", "gz")],
        "n_samples")


def half_second_windows(spark, sf_dir):
    """500 ms windows over second-truncated event time: only [s, s+0.5) fills."""
    parsed, _ = parse_gyro(gyro_messages(spark, sf_dir))
    out = window_stats(parsed, "zeit", "500 milliseconds", count_of="gx")
    return out.select(as_wall_clock("fenster_start").alias("fenster_start"),
                      as_wall_clock("fenster_ende").alias("fenster_ende"), "n_samples")


def valid_coords_query(spark, sf_dir):
    return clean.valid_coords(geo(spark, sf_dir)).select("event_id", "lat", "lon")


def segments_query(spark, sf_dir):
    out = series.segments(geo(spark, sf_dir), "user_id", ORDER)
    return out.select("user_id", "event_id", "prev_lat", "prev_lon", "lat", "lon")


def on_change_query(spark, sf_dir):
    out = series.on_change(events(spark, sf_dir), "event_type", ORDER, "value")
    return out.select("event_type", "event_id", "ts", "value")


def sample_gap_query(spark, sf_dir):
    out = series.sample_gap(events(spark, sf_dir), "user_id", ORDER, "ts", factor=5.0)
    # gap_us is NULL for a user's first event: returned as DOUBLE, since a nullable
    # BIGINT converts to different client types per engine
    return out.select("event_id", "user_id", F.col("gap_us").cast("double").alias("gap_us"),
                      _r6("gap_s").alias("gap_s"),
                      _r6("pause_s").alias("pause_s"))


def last_k_query(spark, sf_dir):
    clicks = events(spark, sf_dir).where(F.col("event_type") == "click")
    return series.last_k(clicks, None, [F.col("ts").desc(), F.col("event_id").desc()], 200).select("event_id", "ts", "value")


def trailing_query(spark, sf_dir):
    return series.trailing(events(spark, sf_dir), "ts", "2 hours").select("event_id", "ts", "value")


def time_range_query(spark, sf_dir):
    out = time_range(events(spark, sf_dir), "ts", dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6),
                     equals={"event_type": "click"})
    return out.select("event_id", "ts", "value")


def time_bounds_query(spark, sf_dir):
    return series.time_bounds(events(spark, sf_dir), "ts")


def to_points_query(spark, sf_dir):
    mapping = [("reading", "value", "value"), ("user", "id", "user_id")]
    return to_points(events(spark, sf_dir), mapping, "ts", keep=["event_id"]).select(
        "event_id", "measurement", "field", "value",
        as_wall_clock("time").alias("time"), "time_ns")


def day_bucket_last(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("day_bucket", day_bucket("ts"))
    out = series.first_last(ev, ["event_type", "day_bucket"], ORDER, "value")
    return out.select("event_type", _day("day_bucket"), "n",
                      F.col("first_value").alias("first_v"), F.col("last_value").alias("last_v"))


def latest_by_key_query(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", "event_id", "ts", "event_type", "value")
    return series.latest_by_key(ev, "user_id", ORDER)


def magnitude_query(spark, sf_dir):
    m = magnitude("value", "user_id", F.col("event_id") % 10)
    return events(spark, sf_dir).select("event_id", _r6(m).alias("magnitude"))


def track_summary_query(spark, sf_dir):
    hourly = window_stats(events(spark, sf_dir), "ts", "1 hour",
                          {"hr_mean": "value", "alt_mean": "user_id"}, count_of="value")
    out = track_summary(hourly, ["hr_mean", "alt_mean"])
    return out.select("n_windows", *[_r6(c).alias(c) for c in out.columns if c != "n_windows"])


def json_field_query(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", json_field("props", "k", "int").alias("k"))


def window_key_query(spark, sf_dir):
    parsed, _ = parse_gyro(gyro_messages(spark, sf_dir))
    out = window_stats(parsed, "zeit", "1 second", count_of="gx", end=None)
    return out.select(window_key("sensor:gyro", "fenster_start").alias("key"), "n_samples")


def date_formats(spark, sf_dir):
    return events(spark, sf_dir).select(
        "event_id",
        fmt_date(as_instant("ts"), "dd.MM.yyyy").alias("d_dot"),
        fmt_date(as_instant("ts"), "dd.MMMM yyyy").alias("d_long"),
        rfc3339("ts").alias("iso"))


def to_zone_query(spark, sf_dir):
    minutes = zone_offset_minutes("ts", "Europe/Zurich")
    return events(spark, sf_dir).select(
        "event_id", to_zone("ts", "Europe/Zurich").alias("local_ts"),
        minutes.alias("offset_min"), offset_text(minutes).alias("utc_offset"))


def fixed_decimals(spark, sf_dir):
    msg = encode({"ts_ms": F.unix_millis(as_instant("ts")), "lat": "lat", "lon": "lon",
                  "alt": "alt", "hr": "user_id", "temp": F.col("user_id") % 40}, "fitness")
    return geo(spark, sf_dir).select("event_id", fixed("alt", 6).alias("txt"),
                                     msg.alias("message"))


def extract_readings_query(spark, sf_dir):
    dumps = dumps_from_events(events(spark, sf_dir))
    return with_dump_value(dumps, "text", "lx").select("event_id", "lx")


def location_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both layouts on one topic, plus broken messages; the layout follows event_id."""
    ev = events(spark, sf_dir)
    ts_ms = F.unix_millis(as_instant("ts")).cast("string")
    k = F.col("event_id") % 3
    walk = encode({"ts_ms": F.unix_millis(as_instant("ts")), "lat": F.lit(47.5), "lon": F.lit(8.5),
                   "alt": F.col("value"), "speed": F.col("value")}, "walk")
    fit = encode({"ts_ms": F.unix_millis(as_instant("ts")), "lat": F.lit(47.5), "lon": F.lit(8.5),
                  "alt": F.col("value"), "hr": F.col("user_id"), "temp": F.col("user_id") % 40},
                 "fitness")
    bad = F.when(F.col("event_id") % 2 == 0, F.concat_ws(",", ts_ms, F.lit("47.5"), F.lit("8.5")))\
        .otherwise(F.concat_ws(",", ts_ms, F.lit("47.5"), F.lit("x"), F.lit("1.0"), F.lit("2.0")))
    text = F.when(k == 0, walk).when(k == 1, fit).otherwise(bad)
    return ev.select("event_id", text.cast("binary").alias("value"))


def layout_dispatch(spark, sf_dir):
    out = flag_location(location_messages(spark, sf_dir), keep=("event_id",))
    return out.select("event_id", F.coalesce("kind", F.lit("reject")).alias("kind"),
                      as_wall_clock("zeit").alias("zeit"), "speed", "hr", "temp")


def rebase_query(spark, sf_dir):
    out = series.rebase_start(events(spark, sf_dir), "ts", START_MS)
    return out.select("event_id", as_wall_clock("ts_rebased").alias("ts_rebased"))


def rebase_to_end_query(spark, sf_dir):
    out = series.rebase_to_end(events(spark, sf_dir), "ts", START_MS)
    return out.select("event_id", as_wall_clock("ts_rebased").alias("ts_rebased"))


def elapsed_query(spark, sf_dir):
    out = series.elapsed(events(spark, sf_dir), "ts")
    return out.select("event_id", _r6("elapsed_s").alias("elapsed_s"))


def skip_warmup_query(spark, sf_dir):
    return series.after_warmup(events(spark, sf_dir), "ts", 1).select("event_id", "ts")


def skip_zero_query(spark, sf_dir):
    raw = events(spark, sf_dir).withColumn("time_raw", F.col("event_id").cast("string"))
    return clean.skip_zero(raw, "time_raw").select("event_id", "ts")


def rejects_query(spark, sf_dir):
    ev = events(spark, sf_dir)
    raw = ev.select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit("x"))
                    .otherwise(F.col("value").cast("string")).alias("raw"))
    typed = raw.withColumn("value", F.col("raw").try_cast("double"))
    return clean.flag_rejects(typed, {"value": "raw"}).select("event_id", "value", "reason")


def unseen_query(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("day_bucket", day_bucket("ts"))
    new = ev.where(F.col("event_type") != "click")
    seen = ev.where(F.col("event_type") == "click")
    out = series.unseen(new, seen, ["user_id", "day_bucket"])
    return out.select("event_id", "user_id", _day("day_bucket"), "event_type")


def ttl_query(spark, sf_dir):
    ev = events(spark, sf_dir).select("user_id", "event_id", "ts")
    latest = series.latest_by_key(ev, "user_id", ORDER)
    live = not_expired(with_ttl(latest, "ts", 6 * 3600),
                       dt.datetime(2024, 1, 30, 23, 0, 0))
    return live.select("user_id", "event_id", "ts", as_wall_clock("expires_at").alias("expires_at"))


def altitude_delta(spark, sf_dir):
    daily = (events(spark, sf_dir).withColumn("day_bucket", day_bucket("ts"))
             .groupBy("user_id", "day_bucket").agg(F.avg("value").alias("alt_mean")))
    out = series.delta(daily, "user_id", "day_bucket", "alt_mean", out="d_alt")
    return out.select("user_id", _day("day_bucket"), _r6("alt_mean").alias("alt_mean"),
                      _r6("d_alt").alias("d_alt"))


def lag_stitched_query(spark, sf_dir):
    out = series.lag_stitched(events(spark, sf_dir), "event_type", ORDER, ["value"],
                              bucket="auto")
    return out.select("event_type", "event_id", "value", "prev_value")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "window_stats": window_stats_query,
    "half_second_windows": half_second_windows,
    "valid_coords": valid_coords_query,
    "segments": segments_query,
    "on_change": on_change_query,
    "sample_gap": sample_gap_query,
    "last_k": last_k_query,
    "trailing": trailing_query,
    "time_range": time_range_query,
    "time_bounds": time_bounds_query,
    "to_points": to_points_query,
    "day_bucket_last": day_bucket_last,
    "latest_by_key": latest_by_key_query,
    "magnitude": magnitude_query,
    "track_summary": track_summary_query,
    "json_field": json_field_query,
    "window_key": window_key_query,
    "date_formats": date_formats,
    "to_zone": to_zone_query,
    "fixed_decimals": fixed_decimals,
    "extract_readings": extract_readings_query,
    "layout_dispatch": layout_dispatch,
    "rebase": rebase_query,
    "rebase_to_end": rebase_to_end_query,
    "elapsed": elapsed_query,
    "skip_warmup": skip_warmup_query,
    "skip_zero": skip_zero_query,
    "rejects": rejects_query,
    "unseen": unseen_query,
    "ttl": ttl_query,
    "altitude_delta": altitude_delta,
    "lag_stitched": lag_stitched_query,
}


# -- further operator groups --------------------------------------------------------

def last_k_per_key(spark, sf_dir):
    """W3 per series: newest 3 events of every user (window group limit)."""
    out = series.last_k(events(spark, sf_dir), "user_id",
                        [F.col("ts").desc(), F.col("event_id").desc()], 3)
    return out.select("user_id", "event_id", "ts", "value")


def trailing_per_key(spark, sf_dir):
    """F7 per series: events within 6 hours of their type's newest event."""
    out = series.trailing(events(spark, sf_dir), "ts", "6 hours", by="event_type")
    return out.select("event_type", "event_id", "ts")


def fit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded fitness records derived from events: positions in semicircles."""
    g = geo(spark, sf_dir)
    sc = F.lit(float(2 ** 31)) / F.lit(180.0)
    return g.select(
        "event_id", F.col("ts").alias("timestamp"),
        (F.col("lat") * sc).cast("bigint").alias("position_lat"),
        (F.col("lon") * sc).cast("bigint").alias("position_long"),
        F.col("alt").alias("enhanced_altitude"),
        (F.col("user_id") % 200).cast("int").alias("heart_rate"),
        (F.col("event_id") % 40).cast("int").alias("temperature"))


def semicircles_query(spark, sf_dir):
    """Fitness records -> degrees, out-of-range positions rejected."""
    return flag_fit(fit_records(spark, sf_dir), keep=("event_id",)).select(
        "event_id", "lat", "lon", "reason")


def load_counts_query(spark, sf_dir):
    """Outcome counts of a load with rejected values."""
    ev = events(spark, sf_dir)
    raw = ev.select("event_id", F.when(F.col("event_id") % 7 == 0, F.lit("x"))
                    .otherwise(F.col("value").cast("string")).alias("raw"))
    typed = raw.withColumn("value", F.col("raw").try_cast("double"))
    return outcome_counts(clean.flag_rejects(typed, {"value": "raw"}))


def points_range(spark, sf_dir):
    """R1 -> S11 / R2: one measurement's (time, value) in a time range of the points."""
    mapping = [("reading", "value", "value"), ("user", "id", "user_id")]
    pts = to_points(events(spark, sf_dir), mapping, "ts").withColumn(
        "time", as_wall_clock("time"))
    out = time_range(pts, "time", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 12),
                     equals={"measurement": "reading", "field": "value"})
    return out.select("time", "value")


def detect_unit_query(spark, sf_dir):
    """Epochs in four units -> detected unit -> instant again."""
    us = F.unix_micros(as_instant("ts"))
    k = F.col("event_id") % 4
    v = (F.when(k == 0, F.unix_seconds(as_instant("ts")))
         .when(k == 1, F.unix_millis(as_instant("ts")))
         .when(k == 2, us).otherwise(us * F.lit(1000)))
    ev = events(spark, sf_dir).withColumn("epoch", v).withColumn("unit", detect_unit("epoch"))
    back = (F.when(F.col("unit") == "s", from_epoch("epoch", "s"))
            .when(F.col("unit") == "ms", from_epoch("epoch", "ms"))
            .when(F.col("unit") == "us", from_epoch("epoch", "us"))
            .otherwise(from_epoch("epoch", "ns")))
    return ev.select("event_id", "unit", as_wall_clock(back).alias("ts_back"))


def normalise_line_query(spark, sf_dir):
    """Decimal-comma ``;`` lines -> numbers -> ``,`` lines."""
    ev = events(spark, sf_dir)
    line = F.concat_ws(";", F.translate(F.col("value").cast("string"), ".", ","),
                       F.col("user_id").cast("string"))
    return ev.select("event_id", normalise_line(line).alias("line"))


def track_windows_query(spark, sf_dir):
    """Location topic with both layouts -> valid coordinates -> 500 ms windows of
    five means + count (second-truncated event time, so [s, s+0.5) only)."""
    from .jobs import track_windows
    out = track_windows(geo_location_messages(spark, sf_dir))
    return out.select(as_wall_clock("fenster_start").alias("fenster_start"),
                      *[_r6(c).alias(c) for c in
                        ("lat_mean", "lon_mean", "alt_mean", "hr_mean", "temp_mean")],
                      "n_samples")


def geo_location_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location messages with the derived coordinates (part of them out of range)."""
    g = geo(spark, sf_dir)
    ts_ms = F.unix_millis(as_instant("ts"))
    k = F.col("event_id") % 3
    walk = encode({"ts_ms": ts_ms, "lat": "lat", "lon": "lon", "alt": "alt", "speed": "alt"},
                  "walk")
    fit = encode({"ts_ms": ts_ms, "lat": "lat", "lon": "lon", "alt": "alt", "hr": "user_id",
                  "temp": F.col("user_id") % 40}, "fitness")
    bad = F.concat_ws(",", ts_ms.cast("string"), F.lit("x"))
    text = F.when(k == 0, walk).when(k == 1, fit).otherwise(bad)
    return g.select("event_id", text.cast("binary").alias("value"))


def window_stats_by_series(spark, sf_dir):
    """A3 per series: 1 h windows per user (a fleet of sensors), mean + count;
    the aggregate is keyed on (window, series), combined per map task."""
    out = window_stats(events(spark, sf_dir), "ts", "1 hour", {"v_mean": "value"},
                       count_of="value", by="user_id", end=None)
    return out.select(as_wall_clock("fenster_start").alias("fenster_start"), "user_id",
                      _r6("v_mean").alias("v_mean"), "n_samples")


def extract_readings_long_query(spark, sf_dir):
    """X1 / J2 table form: dumps exploded to lines, look-ahead as an equi-join on
    (dump, 25-line block) plus a line range; dumps with a value only."""
    from ..operators.extract import explode_lines, extract_readings_long
    lines = explode_lines(dumps_from_events(events(spark, sf_dir)), "event_id", "text")
    out = extract_readings_long(lines, dump="event_id")
    return out.select("event_id", F.col("value").alias("lx"))


def payload_ingest(spark, sf_dir):
    """Events as gyroscope request bodies (no z: default 0) ->
    typed rows with the magnitude."""
    body = F.to_json(F.struct(F.unix_millis(as_instant("ts")).alias("time"),
                              F.col("value").alias("x"), F.col("user_id").alias("y")))
    bodies = events(spark, sf_dir).select("event_id", body.alias("body"))
    out = parse_payload(bodies, "gyro", keep=("event_id",))
    return out.select("event_id", as_wall_clock("zeit").alias("zeit"), "gx", "gy", "gz",
                      _r6("absolute").alias("absolute"))


QUERIES.update({
    "window_stats_by_series": window_stats_by_series,
    "extract_readings_long": extract_readings_long_query,
    "payload_ingest": payload_ingest,
    "last_k_per_key": last_k_per_key,
    "trailing_per_key": trailing_per_key,
    "semicircles": semicircles_query,
    "load_counts": load_counts_query,
    "points_range": points_range,
    "detect_unit": detect_unit_query,
    "normalise_line": normalise_line_query,
    "track_windows": track_windows_query,
})


# -- rejects, gaps and NULL keys: the inputs are broken on purpose ----------------------
def _broken_seconds(spark, sf_dir):
    """Float epoch seconds as text; some not finite, some beyond the calendar, some no number."""
    k = F.col("event_id") % 11
    good = (F.unix_micros(as_instant("ts")) / F.lit(1e6)).cast("string")
    text = (F.when(k == 0, F.lit("NaN")).when(k == 1, F.lit("1e300")).when(k == 2, F.lit("soon"))
            .when(k == 3, F.lit("-Infinity")).otherwise(good))
    return events(spark, sf_dir).select("event_id", text.alias("t"))


def event_seconds(spark, sf_dir):
    """Text of float epoch seconds -> second-truncated instant, NULL for what is none."""
    return _broken_seconds(spark, sf_dir).select("event_id", as_wall_clock(event_time_s("t")).alias("zeit"))


def rebase_seconds(spark, sf_dir):
    """P5, column form: relative seconds (some not finite) on a start instant."""
    k = F.col("event_id") % 11
    t = F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf"))).otherwise(F.col("event_id") / F.lit(4.0))
    return events(spark, sf_dir).select("event_id", rebase(t, 1_700_000_000, "ms").cast("double").alias("ts_ms"))


def bad_times(spark, sf_dir):
    """Gyroscope messages whose time is in ms, in ns by mistake, or no number."""
    ev = events(spark, sf_dir)
    ms = F.unix_millis(as_instant("ts"))
    k = F.col("event_id") % 5
    t = F.when(k == 0, (ms * F.lit(1_000_000)).cast("string")).when(k == 1, F.lit("now")).otherwise(ms.cast("string"))
    value = F.when(k == 2, F.lit("")).otherwise(F.concat_ws(",", t, F.lit("1,2,3,4")))
    msgs = ev.select("event_id", value.alias("value"))
    parsed, rejects = parse_gyro(msgs, resolution="ms", keep=("event_id",))
    none = F.lit(None)
    return parsed.select("event_id", as_wall_clock("zeit").alias("zeit"), none.cast("string").alias("reason")).unionByName(
        rejects.select("event_id", none.cast("timestamp_ntz").alias("zeit"), "reason"))


def fill_zero_query(spark, sf_dir):
    """NULL and NaN readings -> 0."""
    k = F.col("event_id") % 7
    v = F.when(k == 0, F.lit(None).cast("double")).when(k == 1, F.lit(float("nan"))).otherwise(F.col("value"))
    return clean.fill_zero(events(spark, sf_dir).select("event_id", v.alias("v")), ["v"])


def number_text(spark, sf_dir):
    """Numbers as rounded text ('' for NULL)."""
    v = F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("double"))
    return events(spark, sf_dir).select("event_id", v.alias("v")).select("event_id", fmt_num("v", 2).alias("txt"))


def drop_missing_query(spark, sf_dir):
    """rows with a NULL or NaN reading go to the rejects."""
    k = F.col("event_id") % 7
    v = F.when(k == 0, F.lit(None).cast("double")).when(k == 1, F.lit(float("nan"))).otherwise(F.col("value"))
    kept, bad = clean.drop_missing(events(spark, sf_dir).select("event_id", v.alias("v")), ["v"])
    return kept.select("event_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("event_id", "reason"))


def min_fields_query(spark, sf_dir):
    """messages with too few fields."""
    k = (F.col("event_id") % 5).cast("int") + 1
    msgs = events(spark, sf_dir).select("event_id", F.array_repeat(F.lit("1"), k).alias("f"))
    kept, bad = clean.min_fields(msgs, "f", 4)
    return kept.select("event_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("event_id", "reason"))


def drop_incomplete_query(spark, sf_dir):
    """hourly means without a latitude or longitude are dropped."""
    g = geo(spark, sf_dir).select("ts", F.when(F.col("lat") < 60, F.col("lat")).alias("lat"), F.when(F.col("lon") > 120, F.col("lon")).alias("lon"))
    win = window_stats(g, "ts", "10 minutes", {"lat_mean": "lat", "lon_mean": "lon"}, count_of="ts", end=None)
    return clean.drop_incomplete(win, ["lat_mean", "lon_mean"]).select(
        as_wall_clock("fenster_start").alias("fenster_start"), _r6("lat_mean").alias("lat_mean"), _r6("lon_mean").alias("lon_mean"), "n_samples")


def _bodies(spark, sf_dir, fields: dict) -> DataFrame:
    """Request bodies of events: every fifth no JSON, every fifth with a text for the last field."""
    k = F.col("event_id") % 5
    last = list(fields)[-1]
    good = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    wrong = F.to_json(F.struct(*[(F.lit("abc") if n == last else c).alias(n) for n, c in fields.items()]))
    return events(spark, sf_dir).select("event_id", F.when(k == 0, F.lit("{broken")).when(k == 1, wrong).otherwise(good).alias("body"))


def payload_rejects_query(spark, sf_dir):
    """Location bodies, bad ones with their reason."""
    bodies = _bodies(spark, sf_dir, {"time": F.unix_millis(as_instant("ts")), "lat": F.col("value"), "lon": F.col("user_id")})
    out = flag_payload(bodies, "location", keep=("event_id",))
    return out.select("event_id", as_wall_clock("zeit").alias("zeit"), "lat", "lon", "alt", "speed", "reason")


def payload_readings(spark, sf_dir):
    """Reading bodies (id default 'light'); the usable ones."""
    bodies = _bodies(spark, sf_dir, {"time_sec": F.unix_millis(as_instant("ts")) / F.lit(1000.0), "lx": F.col("value")})
    return parse_payload(bodies, "reading", keep=("event_id",)).select("event_id", "sensor_id", _r6("time_sec").alias("time_sec"), "lx")


def track_speed(spark, sf_dir):
    """M2: location windows with altitude and speed."""
    from .jobs import track_windows
    out = track_windows(geo_location_messages(spark, sf_dir), size="1 hour")
    return out.select(as_wall_clock("fenster_start").alias("fenster_start"), _r6("alt_mean").alias("alt_mean"),
                      _r6("speed_mean").alias("speed_mean"), "n_samples")


def track_summary_gaps(spark, sf_dir):
    """A7 where values are missing: each mean is weighted by the values behind it."""
    ev = events(spark, sf_dir).select("ts", F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("hr"), F.col("user_id").alias("alt"))
    win = window_stats(ev, "ts", "1 hour", {"hr_mean": "hr", "alt_mean": "alt"}, count_of="alt", counts=True)
    return track_summary(win, ["hr_mean", "alt_mean"]).select(
        "n_windows", _r6("hr_mean_weighted").alias("hr_mean_weighted"), _r6("alt_mean_weighted").alias("alt_mean_weighted"))


def _null_keys(spark, sf_dir):
    return events(spark, sf_dir).withColumn("k", F.when(F.col("event_type") != "click", F.col("event_type")))


def trailing_null_key(spark, sf_dir):
    """a NULL key is a series of its own."""
    return series.trailing(_null_keys(spark, sf_dir), "ts", "6 hours", by="k").select("event_id", "ts")


def unseen_null_key(spark, sf_dir):
    """A NULL key that was seen is seen."""
    ev = _null_keys(spark, sf_dir).withColumn("day_bucket", day_bucket("ts"))
    out = series.unseen(ev.where("event_id % 2 = 0"), ev.where("event_id % 16 = 1"), ["k", "user_id", "day_bucket"])
    return out.select("event_id")


QUERIES.update({
    "event_seconds": event_seconds,
    "rebase_seconds": rebase_seconds,
    "bad_times": bad_times,
    "fill_zero": fill_zero_query,
    "number_text": number_text,
    "drop_missing": drop_missing_query,
    "min_fields": min_fields_query,
    "drop_incomplete": drop_incomplete_query,
    "payload_rejects": payload_rejects_query,
    "payload_readings": payload_readings,
    "track_speed": track_speed,
    "track_summary_gaps": track_summary_gaps,
    "trailing_null_key": trailing_null_key,
    "unseen_null_key": unseen_null_key,
})
