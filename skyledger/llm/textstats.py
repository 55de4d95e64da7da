"""Counts of a whole text, and the ratios that quality models look at."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .base import WHITE

SYMBOLS = "#*$%&|<>"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
    "n_distinct_words", "n_adjacent", "n_upper_words", "n_upper_chars", "n_digits", "n_bangs",
    "n_stops", "n_longest_line", "n_long_words",
)
SCHEMA = StructType([StructField(c, LongType()) for c in COUNTS])


def repeated_words(words: list[bytes], width: int = 3) -> tuple[int, int, int]:
    """Distinct words, words equal to the one before, and words in windows found twice or more."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    adjacent = int((ids[1:] == ids[:-1]).sum())
    n = len(words) - width + 1
    if n < 2:
        return len(seen), adjacent, 0
    keys = ids[:n].copy()
    for k in range(1, width):  # each step renumbers, so keys stay below 2 ** 63 for any text
        keys = np.unique(keys * len(seen) + ids[k : k + n], return_inverse=True)[1].reshape(-1)
    often = np.bincount(keys)[keys] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : k + n] |= often
    return len(seen), adjacent, int(covered.sum())


def count(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``; a null text counts as empty."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode("utf-8", "surrogatepass").split()
    if not words:
        return (0, 0, sum(map(text.count, SYMBOLS))) + (0,) * (len(COUNTS) - 3)
    lines, dup, filled, longest = set(), 0, 0, 0
    for line in text.split("\n"):
        if line.strip(WHITE):
            filled += 1
            longest = max(longest, len(line))
            if line in lines:
                dup += 1
            lines.add(line)
    distinct, adjacent, repeat = repeated_words(words)
    capitals = sum(w.isupper() and len(w) > 1 for w in words)
    return (
        len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)),
        dup, repeat, filled, distinct, adjacent, capitals,
        sum(map(text.count, "ABCDEFGHIJKLMNOPQRSTUVWXYZ")), sum(map(text.count, "0123456789")),
        text.count("!"), text.count("."), longest, sum(len(w) > 20 for w in words),
    )


@F.pandas_udf(SCHEMA)
def counts(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        yield pd.DataFrame(np.array([count(t) for t in batch], np.int64).reshape(-1, len(COUNTS)), columns=list(COUNTS))


def ratios(c: str) -> dict[str, Column]:
    """The statistics models look at, from the struct column of counts named ``c``."""
    col = lambda name: F.col(f"{c}.{name}").cast("double")
    words, lines = F.greatest(col("n_words"), F.lit(1.0)), F.greatest(col("n_lines"), F.lit(1.0))
    chars = F.greatest(col("word_chars"), F.lit(1.0))
    return {
        "words": col("n_words"),
        "word_length": col("word_chars") / words,
        "symbols_per_word": col("n_symbols") / words,
        "symbols": col("n_symbols"),
        "dup_lines": col("n_dup_lines") / lines,
        "repeat_words": col("n_repeat_words") / words,
        "distinct_words": col("n_distinct_words") / words,
        "adjacent_words": col("n_adjacent") / words,
        "adjacent": col("n_adjacent"),
        "upper_words": col("n_upper_words") / words,
        "upper_chars": col("n_upper_chars") / chars,
        "digits": col("n_digits") / chars,
        "bangs": col("n_bangs") / words,
        "stops": col("n_stops") / words,
        "words_per_line": words / lines,
        "longest_line": col("n_longest_line"),
        "long_words": col("n_long_words") / words,
    }
