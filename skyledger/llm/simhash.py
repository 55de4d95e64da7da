"""SimHash near duplicates: fingerprints, exact links within a bit distance, components.

A fingerprint is the bitwise majority of the XXH64 of all word shingles. Two
fingerprints within ``radius`` bits agree on all but ``radius`` of the blocks
their bits are cut into, so each distinct fingerprint goes, once for each
choice of such blocks, to the bucket of those bits; the buckets' own
fingerprints are compared on bit planes (``bitslice``). A bucket emits a
spanning forest of its links, never its pairs, and holds distinct values that
agree on most bits, so its size is bounded by the bits that are left.

Defined results: a null or blank text has fingerprint zero, which links like
any other; fewer words than a shingle give one shingle of all words; a row
without ``doc_id`` has the component of its fingerprint, named by the ids it
has (null if none); repeated rows share fingerprint and component; an empty
table gives an empty result; extra columns are ignored by ``near_duplicates``
and carried by ``one_of_each``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from . import bitslice
from .base import fresh, stored
from .graph import components

WIDTH, RADIUS, SEED = 3, 2, 42
#: Blocks beyond the radius that must agree; more make smaller buckets and more of them.
AGREEING = 4
#: Buckets up to so many fingerprints are compared pair by pair, many buckets in one go.
SMALL = 32


def fingerprint_of(text: str | None, width: int = WIDTH) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, hashed = b" ".join(words), xxhash.xxh64_intdigest
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: max(1, len(words) - width + 1)].tolist()
    ends = (ends - 1)[min(width, len(words)) - 1 :].tolist()
    total = np.zeros(64, np.int64)
    for k in range(0, len(starts), 1 << 14):
        part = [hashed(line[a:b], SEED) for a, b in zip(starts[k : k + (1 << 14)], ends[k : k + (1 << 14)], strict=True)]
        bits = np.unpackbits(np.array(part, "<u8").view(np.uint8), bitorder="little").reshape(-1, 64)
        total += bits.sum(axis=0, dtype=np.int32)
    majority = (2 * total > len(starts)).astype(np.uint8)
    return int(np.packbits(majority, bitorder="little").view("<i8")[0])


def fingerprint(text: Column, width: int = WIDTH) -> Column:
    """The fingerprint as a signed long."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint_of(t, width) for t in batch], dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, LongType())(text)


def masks(radius: int, agreeing: int = AGREEING) -> list[int]:
    """Bits of every choice of ``agreeing`` of ``radius + agreeing`` blocks, as signed longs."""
    edges = np.linspace(0, 64, radius + agreeing + 1).round().astype(int).tolist()
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    chosen = [sum(c) for c in combinations(blocks, agreeing)]
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def _forests(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    for batch in batches:
        column = batch.column(0)
        flat = column.flatten().to_numpy().astype("<i8").view("<u8")
        ends = np.cumsum(column.value_lengths().to_numpy())
        sizes = np.diff(ends, prepend=0)
        heads, tails = [np.zeros(0, "<u8")], [np.zeros(0, "<u8")]
        for size in np.unique(sizes).tolist():  # buckets of one size lie side by side
            picked = np.flatnonzero(sizes == size)
            if size <= SMALL:
                i, j = np.triu_indices(size, 1)
                step = max(1, (1 << 20) // max(1, len(i)))
                for k in range(0, len(picked), step):
                    rows = flat[(ends[picked[k : k + step]] - size)[:, None] + np.arange(size)]
                    left, right = rows[:, i].reshape(-1), rows[:, j].reshape(-1)
                    near = bitslice.near_pairs(left, right, radius)
                    heads.append(left[near])
                    tails.append(right[near])
            else:
                for k in picked.tolist():
                    a, b = bitslice.forest(flat[ends[k] - size : ends[k]], radius)
                    heads.append(a)
                    tails.append(b)
        a, b = (np.concatenate(x).astype("<u8").view("<i8") for x in (heads, tails))
        yield pa.record_batch([pa.array(a), pa.array(b)], schema=schema)


def links(prints: DataFrame, radius: int = RADIUS, agreeing: int = AGREEING) -> DataFrame:
    """Edges ``(a, b)`` that connect what links of distinct ``fingerprint`` values connect."""
    keys = F.explode(F.array(*[
        F.struct(F.lit(k).alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(m)).alias("bits"))
        for k, m in enumerate(masks(radius, agreeing))
    ]))
    buckets = (
        prints.select("fingerprint", keys.alias("key"))
        .groupBy("key.choice", "key.bits").agg(F.collect_list("fingerprint").alias("found"))
        .where(F.size("found") > 1)
    )
    return buckets.select("found").mapInArrow(lambda b: _forests(b, radius), "a long, b long")


def _classes(rows: DataFrame, radius: int) -> DataFrame:
    """``(fingerprint, component, component_id)`` of rows ``(doc_id, fingerprint)``: the root, and the least id."""
    prints = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    groups = components(links(prints, radius)).withColumnRenamed("node", "fingerprint")
    grouped = prints.join(groups, "fingerprint", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "fingerprint"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    return grouped.join(least, "component").select("fingerprint", "component", "component_id")


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(docs["text"], width).alias("fingerprint"))
    rows = stored(rows, "simhash")
    named = rows.join(_classes(rows, radius), "fingerprint")
    shown = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return named.select("doc_id", shown.alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """The documents with the smallest ``doc_id`` of their component, with all their columns.

    Rows without ``doc_id`` stay only where no row of the component has one, and
    of rows of a component that share its kept id, or all lack one, those with
    the smallest text hash stay. Components may share an id, or all lack one:
    each keeps its own. Of rows equal in ``doc_id`` and text one stays, whichever
    it is if their other columns differ.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        fingerprint(docs["text"], width).alias("fingerprint"),
    )
    rows = stored(rows, "simhash")
    named = rows.join(_classes(rows, radius), "fingerprint")
    first = named.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.groupBy("component").agg(F.first("component_id").alias("component_id"), F.min("text_hash").alias("text_hash"))
    first = first.select("component_id", "text_hash")
    # Copies meet inside each task first; the join finds the rows dealt out by its keys.
    keys = [fresh(docs, n) for n in ("_kept_none", "_kept_id", "_kept_hash")]
    first = first.select(*_keys(F.col("component_id"), F.col("text_hash"), keys))
    once = docs.select("*", *_keys(docs["doc_id"].cast("long"), F.xxhash64(docs["text"]), keys)).dropDuplicates(keys)
    return once.join(first, keys, "left_semi").drop(*keys)


def _keys(doc_id: Column, text_hash: Column, names: list[str]) -> list[Column]:
    """Columns to join rows by, none of them null."""
    values = (doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), text_hash)
    return [v.alias(n) for v, n in zip(values, names, strict=True)]
