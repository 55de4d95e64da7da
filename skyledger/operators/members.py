"""Master-data upkeep: missing members, free codes, new ids."""

from __future__ import annotations

from string import ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import pin

BASE = len(ascii_uppercase)
#: Places and gaps meet in blocks of so many places.
BLOCK = 4096


def new_members(feed: DataFrame, master: DataFrame, feed_col: str, master_col: str) -> DataFrame:
    """Distinct non-null values of ``feed_col`` that ``master_col`` does not hold."""
    seen = feed.select(feed_col).where(F.col(feed_col).isNotNull()).distinct()
    known = master.select(F.col(master_col).alias(feed_col)).distinct()
    return seen.join(known, feed_col, "left_anti")


def code_pool(spark: SparkSession, length: int, col: str = "code") -> DataFrame:
    """All upper-case letter codes of a length: AA, AB, ... ZZ for two letters.

    Code number n written in base 26, so the rows come from a range and need no
    join of alphabets.
    """
    return spark.range(BASE**length).select(code_of(F.col("id"), length).alias(col))


def code_of(number: Column, length: int) -> Column:
    """A code's number as its letters."""
    letters = [
        F.char((F.floor(number / BASE**place) % BASE + ord("A")).cast("int")) for place in reversed(range(length))
    ]
    return F.concat(*letters)


def code_number(code: Column, length: int) -> Column:
    """The number of a code of ``length`` letters, null for any other text."""
    parts = [(F.ascii(F.substring(code, k + 1, 1)) - ord("A")) * F.lit(BASE ** (length - k - 1)).cast("long") for k in range(length)]
    return F.when(code.rlike(f"^[A-Z]{{{length}}}\\z"), sum(parts[1:], parts[0]).cast("long"))


def available_codes(pool: DataFrame, used: DataFrame, col: str, pool_col: str = "code") -> DataFrame:
    """Codes of the pool that no row of ``used`` has in ``col``."""
    taken = used.select(F.col(col).alias(pool_col)).distinct()
    return pool.join(taken, pool_col, "left_anti")


def number_rows(df: DataFrame, order_by: str | Column | list[str | Column], out: str) -> DataFrame:
    """Number rows 0, 1, 2 ... in the given order, without bringing them into one task.

    The rows are range-partitioned and sorted once; a row's place in its slice
    is stored with it, so it stays the same on a retry. Each slice then counts
    from the sum of the slices before it: one count per slice is all that ever
    comes together.
    """
    order = [order_by] if isinstance(order_by, str | Column) else list(order_by)
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    # The id of a row is its slice number above 33 bits for its place in the slice.
    row_id = F.monotonically_increasing_id()
    placed = pin(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", row_id)
        .withColumn("__slice", F.shiftright("__id", 33))
        .withColumn("__within", F.col("__id").bitwiseAND((1 << 33) - 1))
        .drop("__id")
    )
    before = W.orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        placed.groupBy("__slice")
        .agg(F.count("*").alias("__n"))
        .select("__slice", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    )
    # As many rows as there were shuffle partitions.
    numbered = placed.join(F.broadcast(starts), "__slice")
    number = F.col("__start") + F.col("__within")
    return numbered.withColumn(out, number).drop("__slice", "__start", "__within")


def assign_ids(
    df: DataFrame, order_by: str | Column | list[str | Column], base: int = 0, start: int = 0,
    id_col: str = "id",
) -> DataFrame:
    """Add text ids ``base + start``, ``base + start + 1`` ... in the given order.

    ``order_by`` should tell all rows apart, so that ids come out the same
    every time.
    """
    numbered = number_rows(df, order_by, "__number")
    new_id = (F.col("__number") + F.lit(base + start)).cast("string")
    return numbered.withColumn(id_col, new_id).drop("__number")


def code_length(used: DataFrame, col: str, length: int, wanted: int) -> int:
    """The least length, ``length`` or more, that has ``wanted`` codes which no row of ``used`` holds."""
    while True:
        taken = used.select(code_number(F.col(col), length).alias("n")).where("n IS NOT NULL").agg(F.count_distinct("n")).first()[0]
        if BASE**length - taken >= wanted:
            return length
        length += 1


def with_free_codes(rows: DataFrame, place: str, used: DataFrame, col: str, length: int) -> DataFrame:
    """Give the row at place k the k-th code, in their order, that no row of ``used`` has in ``col``.

    No list of codes is made. The j-th used number, counted from 0, has its
    number less j free codes below it; so from that place on codes are moved by
    one more than j. Each block of places takes what the blocks before moved,
    and within it places and moves are passed in order. A place beyond the last
    code makes the query fail.
    """
    numbers = used.select(code_number(F.col(col), length).alias("__n")).where("__n IS NOT NULL").distinct()
    ranked = number_rows(numbers, "__n", "__j")
    moves = ranked.groupBy((F.col("__n") - F.col("__j")).alias("__at")).agg((F.max("__j") + 1).alias("__by"))
    block = lambda c: F.floor(F.col(c) / BLOCK).alias("__block")
    moves = moves.select(block("__at"), "__at", "__by")
    asked = rows.select(block(place), F.col(place).alias("__at")).withColumn("__by", F.lit(None).cast("long"))
    both = moves.join(asked.select("__block").distinct(), "__block", "left_semi")
    blocks = moves.unionByName(asked).groupBy("__block").agg(F.max("__by").alias("__by"))
    # One row for each 4096 places asked for or moved.
    earlier = W.orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select("__block", F.coalesce(F.max("__by").over(earlier), F.lit(0)).alias("__before"))
    upto = W.partitionBy("__block").orderBy("__at", F.col("__by").asc_nulls_last()).rowsBetween(W.unboundedPreceding, 0)
    placed = both.withColumn("__asked", F.lit(False)).unionByName(asked.withColumn("__asked", F.lit(True)))
    placed = placed.withColumn("__moved", F.max("__by").over(upto)).where("__asked").select("__block", F.col("__at").alias(place), "__moved")
    number = F.col(place) + F.greatest(F.col("__before"), F.coalesce("__moved", F.lit(0)))
    none_left = F.raise_error(F.lit(f"no free {col} left")).cast("string")
    found = placed.join(blocks, "__block").select(
        place, F.when(number < BASE**length, code_of(number, length)).otherwise(none_left).alias(col)
    )
    return rows.drop(col).join(found, place)
