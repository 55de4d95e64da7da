"""Expressions over the struct of Spark's ``image`` source."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# OpenCV type code of the decoded buffer -> colour mode name.
MODES = {0: "L", 16: "RGB", 24: "RGBA"}
# Stored channel order is blue, green, red, alpha; shown order is red, green, blue, alpha.
SHOWN_ORDER = {1: (0,), 3: (2, 1, 0), 4: (2, 1, 0, 3)}


def colour_mode(image: Column) -> Column:
    name = F.lit(None).cast("string")
    for code, label in MODES.items():
        name = F.when(image["mode"] == code, F.lit(label)).otherwise(name)
    return name


def _byte(image: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(image["data"], at + 1, F.lit(1))), 16, 10)


def _listed(*items: Column) -> Column:
    """``[a, b]``; null items are left out."""
    return F.concat(F.lit("["), F.concat_ws(", ", *items), F.lit("]"))


def _pixel(image: Column, y: int, x: int) -> Column:
    first = (F.lit(y) * image["width"] + x) * image["nChannels"]
    text = F.lit(None).cast("string")
    for channels, order in SHOWN_ORDER.items():
        values = [_byte(image, first + k) for k in order]
        shown = values[0] if channels == 1 else _listed(*values)
        text = F.when(image["nChannels"] == channels, shown).otherwise(text)
    return F.when(image["width"] > x, text)


def pixel_sample(image: Column, rows: int = 2, cols: int = 2) -> Column:
    """Nested-list text of the top-left pixels, e.g. ``[[[1, 2, 3], [4, 5, 6]]]``."""
    lines = [
        F.when(image["height"] > y, _listed(*[_pixel(image, y, x) for x in range(cols)]))
        for y in range(rows)
    ]
    return _listed(*lines)
