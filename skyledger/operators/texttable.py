"""Flight rows out of plain text, e.g. the text read off a timetable picture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import words
from ..schemas import FLIGHT_LINE

FEWEST = len(FLIGHT_LINE)


def _fields(tokens: Column) -> dict[str, Column]:
    """A line's tokens by field: four, then the aircraft's words, then two from the end."""
    flight, airline, origin, to, aircraft, distance, status = FLIGHT_LINE
    size = F.size(tokens)
    return {
        flight: F.get(tokens, F.lit(0)),
        airline: F.get(tokens, F.lit(1)),
        origin: F.get(tokens, F.lit(2)),
        to: F.get(tokens, F.lit(3)),
        aircraft: F.array_join(F.slice(tokens, F.lit(5), size - 6), " "),
        distance: F.replace(F.get(tokens, size - 2), F.lit("km"), F.lit("")),
        status: F.get(tokens, size - 1),
    }


def _flight_tokens(text: Column, skip_header: bool) -> Column:
    """The tokens of each line that counts as a flight row."""
    heading = F.array(*[F.lit(name) for name in FLIGHT_LINE])

    def counts(tokens: Column) -> Column:
        enough = F.size(tokens) >= FEWEST
        return enough & (tokens != heading) if skip_header else enough

    return F.filter(F.transform(F.split(text, "\n"), words), counts)


def parse_flight_table(df: DataFrame, text_col: str, skip_header: bool = False) -> DataFrame:
    """One row per text line of seven words or more, next to the other columns of ``df``.

    A heading line counts as a row unless ``skip_header``. No shuffle: a text
    is split inside its own task, and each line only once.
    """
    others = [c for c in df.columns if c != text_col]
    lines = _flight_tokens(F.col(text_col), skip_header)
    rows = df.select(*others, F.explode(lines).alias("__tokens"))
    fields = _fields(F.col("__tokens"))
    return rows.select(*others, *[value.alias(name) for name, value in fields.items()])


def flight_table_json(
    df: DataFrame, text_col: str, out: str = "ocr_text", skip_header: bool = False
) -> DataFrame:
    """Replace the text by the JSON array of its flight rows; ``[]`` when it has none."""
    others = [c for c in df.columns if c != text_col]
    lines = _flight_tokens(F.coalesce(F.col(text_col), F.lit("")), skip_header)

    def record(tokens: Column) -> Column:
        return F.struct(*[value.alias(name) for name, value in _fields(tokens).items()])

    return df.select(*others, F.to_json(F.transform(lines, record)).alias(out))
