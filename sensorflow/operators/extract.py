"""Sensor value extraction from text dumps.

Rule, per dump: walk the lines matching the sensor pattern in order. For each,
look at it and the next ``span - 1`` lines:

1. the first of them with a keyword value (``functions.text.extract_value``);
2. else, after the first line containing "event", the first line without
   "event" that has ``[number``;
3. else go on with the next sensor line.

A dump without a value is a reject.

Two forms with the same result:

* :func:`extract_readings` works on one dump per row with array
  higher-order functions: every line's regexes run once, the look-ahead is a
  ``slice`` of at most ``span`` entries. Row-local, no shuffle.
* :func:`extract_readings_long` is the table form (J2) for dumps too big for
  one row: lines are exploded and grouped by ``(dump, block of span lines)``
  with each line also serving the block before, so a huge dump is spread
  over many tasks and no group holds more than ``2 * span`` lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import compute_once
from ..functions.text import (DEFAULT_SENSOR_PATTERN, EVENT_VALUE, SENSOR_SPAN,
                              extract_value, first_number, split_lines)


def _line_facts(line: Column, sensor_pattern: str) -> dict[str, Column]:
    return {
        "sensor": F.coalesce(line.rlike("(?i)" + sensor_pattern), F.lit(False)),
        "kv": extract_value(line),
        "ev": F.coalesce(F.lower(line).contains("event"), F.lit(False)),
        # the bracket pattern needs a "[": skip the regex on other lines
        "br": F.when(F.instr(line, "[") > 0, first_number(line, EVENT_VALUE)),
    }


def line_facts(text: str | Column, sensor_pattern: str = DEFAULT_SENSOR_PATTERN) -> Column:
    """Per line of a dump: index, sensor match, keyword value, event flag, bracket value.

    Every regex runs once per line here; :func:`value_from_facts` only reads
    the resulting array.
    """
    t = F.col(text) if isinstance(text, str) else text
    return F.transform(split_lines(t), lambda l, i: F.struct(
        i.alias("i"), *[c.alias(k) for k, c in _line_facts(l, sensor_pattern).items()]))


def value_from_facts(facts: str | Column, span: int = SENSOR_SPAN) -> Column:
    """X1 rule over a ``line_facts`` array: the first sensor line that yields a value."""
    facts = F.col(facts) if isinstance(facts, str) else facts

    none = F.lit(None).cast("double")
    start = F.struct(none.alias("p1"), F.lit(False).alias("seen_ev"), none.alias("p2"))

    def step(acc, x):
        # one pass over the look-ahead: first keyword value; whether an event
        # line was passed; first bracket value on a non-event line after it
        return F.struct(
            F.coalesce(acc["p1"], x["kv"]).alias("p1"),
            (acc["seen_ev"] | x["ev"]).alias("seen_ev"),
            F.coalesce(acc["p2"], F.when(acc["seen_ev"] & ~x["ev"], x["br"])).alias("p2"))

    def value_at(s):
        return F.aggregate(F.slice(facts, s["i"] + 1, span), start, step,
                           lambda r: F.coalesce(r["p1"], r["p2"]))

    sensors = F.filter(facts, lambda x: x["sensor"])
    # in order; once a sensor line gave a value, later ones are not looked at
    return F.aggregate(sensors, none,
                       lambda acc, s: F.when(acc.isNotNull(), acc).otherwise(value_at(s)))


def with_dump_value(dumps: DataFrame, text: str = "text", out: str = "value",
                    sensor_pattern: str = DEFAULT_SENSOR_PATTERN,
                    span: int = SENSOR_SPAN) -> DataFrame:
    """Add the sensor value of each dump (NULL when there is none).

    The line facts are computed once per dump (``compute_once``), then the
    look-ahead rule reads them; no shuffle.
    """
    facts = "__sf_facts"
    # the pattern is matched line by line: an anchored one means line ends
    staged = compute_once(dumps, **{facts: line_facts(text, sensor_pattern)})
    return staged.withColumn(out, value_from_facts(facts, span)).drop(facts)


def extract_readings(dumps: DataFrame, text: str = "text",
                     sensor_pattern: str = DEFAULT_SENSOR_PATTERN,
                     span: int = SENSOR_SPAN) -> tuple[DataFrame, DataFrame]:
    """One dump per row -> ``(readings with value, rejects)``."""
    out = with_dump_value(dumps, text, "value", sensor_pattern, span)
    return (out.where(F.col("value").isNotNull()),
            out.where(F.col("value").isNull()).drop("value")
               .withColumn("reason", F.lit("no sensor value")))


def extract_readings_long(lines: DataFrame, dump: str = "dump_id", line_no: str = "line_no",
                          line: str = "line", sensor_pattern: str = DEFAULT_SENSOR_PATTERN,
                          span: int = SENSOR_SPAN) -> DataFrame:
    """X1 / J2 table form: ``lines`` has one row per (dump, 0-based line number, text).

    Returns ``(dump, value)`` for dumps with a value. Only lines that can
    matter (sensor, keyword value, event, bracket value) are kept. Every such
    line goes to its own ``span``-line block and to the block before, so the
    group (dump, block b) holds lines [b*span, (b+2)*span): the whole
    look-ahead of each sensor line of block b. One shuffle, at most 2*span
    lines per group however large the dump, no join; then the first sensor
    line with a value wins per dump (an aggregate combined per map task).
    """
    # stored once per line: the filter below reads columns, not the patterns again
    staged = compute_once(lines.select(dump, F.col(line_no).cast("bigint").alias("i"), line),
                          **_line_facts(F.col(line), sensor_pattern))
    facts = (staged.drop(line)
             .where(F.col("sensor") | F.col("kv").isNotNull() | F.col("ev")
                    | F.col("br").isNotNull()))
    own = F.floor(F.col("i") / F.lit(span)).cast("bigint")
    spread = facts.withColumn("blk", F.explode(F.array(own, own - F.lit(1))))
    blocks = spread.groupBy(dump, "blk").agg(
        F.array_sort(F.collect_list(F.struct("i", "sensor", "kv", "ev", "br"))).alias("ls"))

    none = F.lit(None).cast("double")
    start = F.struct(none.alias("p1"), F.lit(False).alias("seen_ev"), none.alias("p2"))

    def step(acc, x):
        return F.struct(
            F.coalesce(acc["p1"], x["kv"]).alias("p1"),
            (acc["seen_ev"] | x["ev"]).alias("seen_ev"),
            F.coalesce(acc["p2"], F.when(acc["seen_ev"] & ~x["ev"], x["br"])).alias("p2"))

    def value_at(s):
        win = F.filter("ls", lambda x: (x["i"] >= s["i"]) & (x["i"] < s["i"] + F.lit(span)))
        r = F.aggregate(win, start, step)
        return F.struct(s["i"].alias("i"), F.coalesce(r["p1"], r["p2"]).alias("value"))

    mine = F.filter("ls", lambda x: x["sensor"]
                    & (F.floor(x["i"] / F.lit(span)).cast("bigint") == F.col("blk")))
    per_sensor = blocks.select(dump, F.explode(F.transform(mine, value_at)).alias("s"))
    valued = per_sensor.select(dump, "s.i", "s.value").where(F.col("value").isNotNull())
    return valued.groupBy(dump).agg(F.min_by("value", "i").alias("value"))


def long_rejects(lines: DataFrame, values: DataFrame, dump: str = "dump_id") -> DataFrame:
    """Rejects of the table form: dumps of ``lines`` without a row in ``values``."""
    seen = lines.groupBy(dump).agg(F.lit("no sensor value").alias("reason"))
    return seen.join(values.select(dump), on=dump, how="left_anti")


def explode_lines(dumps: DataFrame, dump: str = "dump_id", text: str = "text") -> DataFrame:
    """Dumps -> one row per line (0-based ``line_no``), for the table form."""
    return dumps.select(dump, F.posexplode(split_lines(F.col(text))).alias("line_no", "line"))
