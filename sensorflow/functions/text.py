"""Text helpers: number extraction from free text, line re-serialisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, _col

# Patterns of the sensor-dump reader, tried in this order,
# case-insensitive. A keyword value ("lux: 12.5", "last value = [3"), then a
# bracket after an equals sign ("= [ 7"); inside an event section the first
# "[number" counts. The default sensor pattern and the look-ahead span of 25
# lines (the sensor line included) are fixed too.
KEYWORD_VALUE = r"(?:lux|lx|illuminance|value|last(?:\s+value)?|data)\s*[:=]\s*\[?\s*(-?\d+(?:\.\d+)?)"
EQUALS_BRACKET_VALUE = r"=\s*\[\s*(-?\d+(?:\.\d+)?)"
EVENT_VALUE = r"\[\s*(-?\d+(?:\.\d+)?)"
DEFAULT_SENSOR_PATTERN = r"light|illuminance"
SENSOR_SPAN = 25

# Line breaks as Python's str.splitlines() knows them.
LINE_BREAK = "\\r\\n|[\\n\\x0b\\x0c\\r\\x1c\\x1d\\x1e\\x85\\u2028\\u2029]"


def first_number(line: ColumnOrName, pattern: str) -> Column:
    """Group 1 of the first case-insensitive match of ``pattern`` as DOUBLE, else NULL."""
    # no match gives '', which try_cast turns into NULL
    return F.regexp_extract(_col(line), "(?i)" + pattern, 1).try_cast("double")


def extract_value(line: ColumnOrName) -> Column:
    """Number after a keyword, else after ``= [``; NULL when neither matches.

    Both patterns need ``:`` or ``=``; lines without either skip the regexes.
    """
    l = _col(line)
    may = (F.instr(l, ":") > 0) | (F.instr(l, "=") > 0)
    return F.when(may, F.coalesce(first_number(l, KEYWORD_VALUE),
                                  first_number(l, EQUALS_BRACKET_VALUE)))


def split_lines(text: ColumnOrName) -> Column:
    """Text -> array of lines (Python ``splitlines`` break characters).

    A trailing line break yields a trailing empty line, which matches nothing.
    The rarer break characters are first rewritten to ``\\n`` (compiled
    pattern, cached per task) so the split itself is a single-character split,
    which the JVM does without a regex.
    """
    unified = F.regexp_replace(_col(text), LINE_BREAK, "\n")
    return F.split(unified, "\n")


def normalise_line(line: ColumnOrName, sep: str = ";", decimal: str = ",",
                   out_sep: str = ",") -> Column:
    """``"0,25;1,5"`` -> ``"0.25,1.5"``: fields parsed as numbers and re-joined.

    NULL when any field is no number: no field is dropped, so none changes its
    place (see ``operators.clean.normalise_lines`` for the rejects).
    """
    fields = F.split(_col(line), sep)
    numbers = F.transform(
        fields, lambda x: F.translate(F.trim(x), decimal, ".").try_cast("double"))
    joined = F.array_join(F.transform(numbers, lambda x: x.cast("string")), out_sep)
    return F.when(F.forall(numbers, lambda x: x.isNotNull()), joined)
