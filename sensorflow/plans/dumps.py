"""Sensor-service text dumps derived from events, one dump per event row.

The layout follows ``event_id`` (six shapes) and the reading is the row's
``value``, so the extraction covers every rule of the reader: keyword value
after an unrelated ``x=1`` line, event-section bracket value, no sensor line,
a value outside the 25-line look-ahead, keyword before event section, and an
``= [`` value in upper case.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dumps_from_events(ev: DataFrame) -> DataFrame:
    v = F.format_string("%.2f", F.col("value"))
    neg = F.format_string("%.2f", -F.col("value"))
    nl = "\n"

    def lines(*parts):
        return F.concat_ws(nl, *[F.lit(p) if isinstance(p, str) else p for p in parts])

    shapes = [
        lines("Sensor List:", "accel | vendor x=1", "Light Sensor | handle 3",
              "  mode: continuous", F.concat(F.lit("  last value: "), v)),
        lines("Illuminance sensor (wake-up)", "recent events:",
              F.concat(F.lit("  [ "), v, F.lit(", 0]"))),
        lines("accelerometer", F.concat(F.lit("value: "), v), "recent events:", "  [ 1.0 ]"),
        lines("light sensor A", F.array_repeat(F.lit("  ..."), 30), "  value: 999",
              "light sensor B", F.concat(F.lit("lx = "), v)),
        lines("light sensor", "events:", "  [ 5.0 ]", F.concat(F.lit("  data = "), v)),
        lines("LIGHT", F.concat(F.lit("reading = [ "), neg, F.lit(", 1 ]"))),
    ]
    k = F.col("event_id") % len(shapes)
    text = F.when(k == 0, shapes[0])
    for i, s in enumerate(shapes[1:], start=1):
        text = text.when(k == i, s)
    return ev.select("event_id", text.alias("text"))


# The same texts for the SQL oracle (DuckDB dialect).
DUMPS_SQL = r"""
(select event_id, case event_id % 6
  when 0 then concat_ws(chr(10), 'Sensor List:', 'accel | vendor x=1', 'Light Sensor | handle 3',
                        '  mode: continuous', '  last value: ' || printf('%.2f', value))
  when 1 then concat_ws(chr(10), 'Illuminance sensor (wake-up)', 'recent events:',
                        '  [ ' || printf('%.2f', value) || ', 0]')
  when 2 then concat_ws(chr(10), 'accelerometer', 'value: ' || printf('%.2f', value),
                        'recent events:', '  [ 1.0 ]')
  when 3 then concat_ws(chr(10), 'light sensor A', repeat('  ...' || chr(10), 29) || '  ...',
                        '  value: 999', 'light sensor B', 'lx = ' || printf('%.2f', value))
  when 4 then concat_ws(chr(10), 'light sensor', 'events:', '  [ 5.0 ]',
                        '  data = ' || printf('%.2f', value))
  else concat_ws(chr(10), 'LIGHT', 'reading = [ ' || printf('%.2f', -value) || ', 1 ]')
 end as text from events)
"""
