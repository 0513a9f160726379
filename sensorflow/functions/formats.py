"""Text encodings of rows.

Messages are CSV text with fixed decimals per field. Encoding runs as
``format_string`` inside the JVM; note that JVM ``%.2f`` rounds ties half-up
(0.125 -> 0.13) where Python rounds half-even on the binary value.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .parse import ColumnOrName, _col

# Message layouts of the surveyed producers, field by field.
# Each entry is (field name, printf format); the time field is epoch ms.
MESSAGE_SPECS: dict[str, list[tuple[str, str]]] = {
    "gyro": [("ts_ms", "%d"), ("gx", "%.6f"), ("gy", "%.6f"), ("gz", "%.6f"), ("absolute", "%.6f")],
    "walk": [("ts_ms", "%d"), ("lat", "%.8f"), ("lon", "%.8f"), ("alt", "%.2f"), ("speed", "%.4f")],
    "fitness": [("ts_ms", "%d"), ("lat", "%.8f"), ("lon", "%.8f"), ("alt", "%.2f"),
                ("hr", "%.0f"), ("temp", "%.1f")],
    # HTTP ingest forwards x, y, z as received and formats only the magnitude.
    "server_gyro": [("ts_ms", "%s"), ("gx", "%s"), ("gy", "%s"), ("gz", "%s"), ("absolute", "%.6f")],
    "server_location": [("ts_ms", "%s"), ("lat", "%s"), ("lon", "%s"), ("alt", "%s"), ("speed", "%s")],
}


def encode(columns: dict[str, ColumnOrName], spec: str | list[tuple[str, str]]) -> Column:
    """One CSV message per row, fields formatted per ``spec``.

    ``columns`` maps the spec's field names to columns; ``%d`` fields are cast
    to BIGINT, ``%f`` fields to DOUBLE, ``%s`` fields to text.
    """
    fields = MESSAGE_SPECS[spec] if isinstance(spec, str) else spec
    fmt = ",".join(f for _, f in fields)
    args = []
    for name, f in fields:
        c = _col(columns[name])
        if f.endswith("d"):
            c = c.cast("bigint")
        elif f.endswith("f"):
            c = c.cast("double")
        else:
            c = c.cast("string")
        args.append(c)
    return F.format_string(fmt, *args)


def fixed(c: ColumnOrName, decimals: int = 6) -> Column:
    """Number -> text with exactly ``decimals`` digits after the point."""
    return F.format_string(f"%.{decimals}f", _col(c).cast("double"))


def fmt_num(c: ColumnOrName, decimals: int = 6) -> Column:
    """Number rounded to ``decimals`` as text; NULL -> ''.

    Keep the double in tables and use this only for text views: Spark rounds
    half-up (5e-7 -> 1.0E-6) and prints small values in E notation.
    """
    return F.coalesce(F.round(_col(c).cast("double"), decimals).cast("string"), F.lit(""))


def label(hr: ColumnOrName, alt: ColumnOrName, temp: ColumnOrName, n: ColumnOrName) -> Column:
    """P25: popup text of a track point."""
    # Fixed value: the text of the surveyed map's popups.
    return F.format_string(
        "HR: %.0f bpm<br>Alt: %.0f m<br>Temp: %.1f °C<br>Samples: %d",
        _col(hr).cast("double"), _col(alt).cast("double"), _col(temp).cast("double"),
        _col(n).cast("bigint"),
    )
