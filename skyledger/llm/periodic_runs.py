"""Finds stretches of words that repeat with a period, and collapses them to one period.

Squares are found over an enhanced suffix array, without a tree. In each
interval of suffixes that share a prefix, say of depth p, the suffixes of all
children but the largest ask whether the suffix p places on, or p places back,
lies in another child of the interval: then two copies of the p words stand
side by side, and what follows the second differs from what follows the first.
Such a branching square is the last of its run; rotating it to the left, by
powers of two of equal ranks, gives the run's start. Of periods that give the
same stretch the smallest is the run's.

Documents are independent: nothing is shuffled. A task takes documents together
until they hold ``CHUNK`` words, so short texts share the passes over arrays; a
longer text is a chunk of its own, and memory follows the longest text (some 60
bytes a word, and 4 for each doubling of its longest repeat).

Defined results: a null or empty text has no words and no runs; null and
repeated ``doc_id`` values are carried as they are, each row by itself; runs
come by start, then period; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .suffix_array import Array, SuffixArray

#: A run has at least this many words and this many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
CHUNK = 1 << 18
SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])

Words = list[bytes]
Rewrite = Callable[[int | None, Words], Words]


def branching_squares(array: SuffixArray, least: int = 2) -> tuple[Array, Array]:
    """Start and period of each square that a different word follows than its period asks for."""
    depth, low, high, splits = array.intervals(least)
    bounds = np.flatnonzero(splits >= 0)
    bounds = bounds[np.argsort(splits[bounds], kind="stable")]
    # Children of an interval: from its low end, and from each boundary, to the next.
    of = np.concatenate((np.arange(len(depth)), splits[bounds]))
    begin = np.concatenate((low, bounds))
    in_order = np.lexsort((begin, of))
    of, begin = of[in_order], begin[in_order]
    last = np.concatenate((of[1:] != of[:-1], np.ones(min(len(of), 1), bool)))
    end = np.where(last, high[of] + 1, np.roll(begin, -1))
    size = end - begin
    # The largest child of each interval is left out; its suffixes are met from the others.
    largest = np.lexsort((size, of))
    largest = largest[np.concatenate((of[largest][1:] != of[largest][:-1], np.ones(min(len(of), 1), bool)))]
    small = np.ones(len(of), bool)
    small[largest] = False
    of, begin, size = of[small], begin[small], size[small]
    child = np.repeat(np.arange(len(of)), size)
    place = np.arange(len(child)) - np.repeat(np.cumsum(size) - size, size) + begin[child]
    here, period = array.order[place], depth[of[child]]
    starts, periods = [], []
    for away in (period, -period):
        other = here + away
        inside = (other >= 0) & (other < len(array.order))
        at = array.inverse[np.where(inside, other, 0)]
        met = inside & (at >= low[of[child]]) & (at <= high[of[child]])
        met &= (at < begin[child]) | (at >= begin[child] + size[child])
        starts.append(np.minimum(here, other)[met])
        periods.append(period[met])
    return np.concatenate(starts), np.concatenate(periods)


def find_runs(
    symbols: Array, ends: Array, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> tuple[Array, Array, Array]:
    """Start, length and period of the runs of all sequences, by start, then period.

    A run holds each of its symbols at least ``least_periods`` times (two at least).
    """
    array = SuffixArray(symbols, ends)
    start, period = branching_squares(array, max(2, least_periods))
    end = start + 2 * period
    start = start - array.shared(start, start + period, -1)
    kept = end - start >= np.maximum(least_words, least_periods * period)
    start, end, period = start[kept], end[kept], period[kept]
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    return start[order], (end - start)[order], period[order]


def _chunk(ids: list[int | None], words: list[Words], least_words: int, least_periods: int) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    flat = np.empty(int(sizes.sum()), object)
    for w, b, e in zip(words, begins.tolist(), ends.tolist(), strict=True):
        flat[b:e] = w
    start, length, period = find_runs(pd.factorize(flat)[0].astype(np.int64), ends, least_words, least_periods)
    of = np.searchsorted(ends, start, "right")
    # What follows a run's first period goes.
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    gone = np.cumsum(change[:-1]) > 0
    lost = np.zeros(len(words), bool)
    lost[of] = True
    collapsed = [
        b" ".join(flat[b:e][~gone[b:e]].tolist() if hit else w).decode()
        for w, b, e, hit in zip(words, begins.tolist(), ends.tolist(), lost.tolist(), strict=True)
    ]
    offsets = np.concatenate(([0], np.cumsum(np.bincount(of, minlength=len(words))))).astype(np.int32)
    runs = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - begins[of], length, period)], fields=list(_RUN))
    return pa.record_batch(
        [pa.array(ids, pa.int64()), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets), runs), pa.array(collapsed, pa.string())],
        schema=_ARROW,
    )


def _batches(
    batches: Iterator[pa.RecordBatch], rewrite: Rewrite | None, least_words: int, least_periods: int
) -> Iterator[pa.RecordBatch]:
    ids: list[int | None] = []
    words: list[Words] = []
    held = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_py()
            own = raw.encode().split() if raw else []
            if rewrite is not None:
                own = rewrite(doc_id, own)
            if words and held + len(own) > CHUNK:
                yield _chunk(ids, words, least_words, least_periods)
                ids, words, held = [], [], 0
            ids.append(doc_id)
            words.append(own)
            held += len(own) + 1
    if words:
        yield _chunk(ids, words, least_words, least_periods)


def detect(
    docs: DataFrame, *, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS, rewrite: Rewrite | None = None
) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` of every document.

    ``runs`` holds start, length and period in words; ``collapsed`` is the text's
    words, one space between them, without what follows the first period of a
    run. ``rewrite`` may change a document's words before they are looked at.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _batches(b, rewrite, least_words, least_periods), SCHEMA)


def strongest(runs: Column) -> Column:
    """The run of greatest length/period, compared as fractions; of equal ones the first; null without any."""

    def better(a: Column, b: Column) -> Column:
        return F.when(a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"]), b).otherwise(a)

    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate(runs, none, better)


def report(docs: DataFrame, rewrite: Rewrite | None = None) -> DataFrame:
    """Per document the number of runs, its strongest one, and digests of the runs and of the collapsed text."""
    found = detect(docs, rewrite=rewrite).withColumn("best", strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
