"""What several operators share: stored steps, words, hold-out, labelled samples."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir

#: Words are runs of anything but these; bytes.split() cuts at the same six.
WHITE = " \t\n\x0b\x0c\r"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def cleaned(spark: SparkSession) -> Iterator[None]:
    """What actions inside shuffle is dropped as soon as they are done."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that lineage ends here.

    What the write shuffled is dropped: nothing reads it again.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    with cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return stem if stem not in taken else f"{stem}_{uuid.uuid4().hex}"


def held_out(doc_id: Column) -> Column:
    """True for the fifth of ids that no fit may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_ids(labels: DataFrame, label: str, bound: int | None = None) -> DataFrame:
    """``(doc_id, label)`` rows a fit may learn from, one per document.

    Null ids, null labels and held-out ids are left out; an id labelled more
    than once counts by its smallest label. With ``bound``, at most so many
    rows, picked by a hash of the id.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(F.col(label).cast("int")).alias("label"))
    )
    if bound is None:
        return rows
    share = 2**20 * min(1.0, 1.1 * bound / max(1, rows.count()))
    order = F.xxhash64("doc_id", F.lit("sample"))
    return rows.where(F.pmod(order, F.lit(2**20)) < share).orderBy(order, "doc_id").limit(bound)


def one_a_document(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Of rows with one ``doc_id`` the one whose text has the smallest hash: ``label`` and ``columns``.

    So a sample of ids is one of rows too, however often an id occurs. Rows meet
    inside each task first. ``rows`` has ``doc_id``, ``label`` and ``text_hash``.
    """
    kept = F.min_by(F.struct("label", *columns), "text_hash")
    return rows.groupBy("doc_id").agg(kept.alias("kept")).select("kept.*")
