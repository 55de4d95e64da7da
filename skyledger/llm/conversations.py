"""Turns of conversations in order, and the rebuilt conversations of the trie query.

Turns come by number, null first; of equal numbers by role, then text. A null
role or text is empty, rows without ``conv_id`` belong to no conversation, equal
rows are turns of their own, other columns are ignored.

The turns are sorted by range, so a conversation with very many turns spans many
tasks; its parts are counted, and each turn's place is the count of the parts
before it and its place in its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import stored

#: Heads of a rebuilt conversation have at most this many turns less one, and are lent to so many neighbours.
HEADS, FAMILY = 9, 5


def placed(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``place`` from 1, two hashes ``c1``, ``c2`` of role and text, and ``size``, the text's bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role, text
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # A row's number holds its slice above 33 bits for its place there.
    ordered = stored(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
            "conv_id",
            F.xxhash64("role", "text").alias("c1"),
            F.xxhash64(F.lit("turn"), "text", "role").alias("c2"),
            F.octet_length("text").cast("long").alias("size"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "turns",
    ).withColumn("part", F.shiftright("at", 33))
    parts = ordered.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    place = F.col("at") - F.col("first") + F.col("earlier") + 1
    return ordered.join(parts, ["conv_id", "part"]).select("conv_id", place.alias("place"), "c1", "c2", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: their turns ``(conv_id, depth, c1, c2, size)``, and ``(conv_id, n)`` of each.

    Conversation c starts with the first h turns of conversation ``c - c % 5``,
    all if it has fewer, none if there is none, and goes on with its own turns
    after its first h; h is the crc32 of its number modulo 9.
    """
    rows = stored(placed(turns), "placed")
    own = rows.groupBy("conv_id").agg(F.count("*").alias("own"))
    plans = own.select(
        "conv_id", "own", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
    )
    lent = own.where(F.col("conv_id") % FAMILY == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("lent"))
    plans = plans.join(lent, "base", "left").withColumn("lent", F.least("h", F.coalesce("lent", F.lit(0))))
    # Stored, so that the join below sees two plain shuffles and can split a long conversation.
    plans = stored(plans, "plans")
    heads = rows.where((F.col("place") < HEADS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    heads = heads.join(plans, "base").where(F.col("place") <= F.col("h"))
    tails = rows.join(plans, "conv_id").where(F.col("place") > F.col("h"))
    heads = heads.withColumn("depth", F.col("place"))
    tails = tails.withColumn("depth", F.col("lent") + F.col("place") - F.col("h"))
    columns = ["conv_id", "depth", "c1", "c2", "size"]
    length = F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return heads.select(columns).union(tails.select(columns)), plans.select("conv_id", length.alias("n"))
