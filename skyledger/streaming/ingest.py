"""Process each landed file once, then stop.

The checkpoint remembers the files that were read. A batch writes its own
commit folder named by the batch number, so a batch that is run again after a
failure replaces its folder and adds nothing twice. One checkpoint belongs to
one output folder.

Commits are dealt into folders by a hash of what later batches look for, so a
batch reads only the folders its own rows can be in, however long the history
has become. Histories that were begun without such folders go on without.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.history import ROW_DIGEST, Buckets, dealt, rows_until, write_base, write_commit
from ..operators.merging import fold_latest, folded_changes

Transform = Callable[[DataFrame], DataFrame]

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"

FILE_OPTIONS = {
    "csv": ("csv", {"header": True, "enforceSchema": False, "multiLine": True, "escape": '"'}),
    "json": ("json", {"multiLine": True}),
    "jsonl": ("json", {}),
    "parquet": ("parquet", {}),
    "image": ("image", {}),
}


def run_once(
    spark: SparkSession, src_glob: str, fmt: str, schema: StructType | str, checkpoint: str,
    files_per_batch: int | None, handle: Callable[[DataFrame, int], None], stream: Transform | None = None,
) -> None:
    """Give the rows of files not seen before to ``handle``, batch by batch, then stop.

    A batch names its files, and Spark looks each up in a task of its own: many small
    files are looked up by a few tasks for each core.
    """
    before = spark.conf.get(LISTING)
    spark.conf.set(LISTING, min(int(before), 4 * spark.sparkContext.defaultParallelism))
    try:
        _run_once(spark, src_glob, fmt, schema, checkpoint, files_per_batch, handle, stream)
    finally:
        spark.conf.set(LISTING, before)


def _run_once(
    spark: SparkSession, src_glob: str, fmt: str, schema: StructType | str, checkpoint: str,
    files_per_batch: int | None, handle: Callable[[DataFrame, int], None], stream: Transform | None,
) -> None:
    source, options = FILE_OPTIONS[fmt]
    reader = spark.readStream.format(source).options(**options).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(src_glob)
    query = (
        (rows if stream is None else stream(rows))
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """Hold a batch that is read more than once; what a lost executor held is computed again."""
    held = rows.persist()
    try:
        yield held
    finally:
        held.unpersist()


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of a row's JSON text: the same for rows that are equal in all ``columns``, nulls too."""
    fields = F.struct(*[F.col(f"`{c}`") for c in columns])
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)


def _layout(spark: SparkSession, path: str, keys: Sequence[str], count: int) -> Buckets | None:
    return Buckets(tuple(keys), count) if dealt(spark, path) else None


def unseen_rows(rows: DataFrame, path: str, commit_id: int, buckets: Buckets | None) -> DataFrame:
    """The rows whose digest no commit before ``commit_id`` holds.

    ``rows`` has its digests in ``ROW_DIGEST``. Of earlier commits only the digests are read, and of
    those only the folders that digests of ``rows`` can be in.
    """
    names = None if buckets is None else buckets.of(rows)
    earlier = rows_until(rows.sparkSession, path, commit_id - 1, rows.schema, buckets, names)
    if buckets is None:
        # Commits without digests: these are made of the rows' own columns.
        own = [c for c in rows.columns if c != ROW_DIGEST]
        earlier = earlier.withColumn(ROW_DIGEST, F.coalesce(F.col(ROW_DIGEST), row_digest(own)))
    return rows.join(earlier.select(ROW_DIGEST), ROW_DIGEST, "left_anti").select(*rows.columns)


def ingest_incremental(
    spark: SparkSession, src_glob: str, schema: StructType, transform: Transform, out: str,
    checkpoint: str, fmt: str = "csv", files_per_batch: int | None = None, distinct: bool = True,
    buckets: int = 64,
) -> None:
    """Append the cleaned rows of files not seen before to the history at ``out``.

    ``transform`` must give each row by itself the same result in any batch;
    dropping equal rows is done here: a row equal to one of its batch or of an
    earlier commit is not added. So the rows do not depend on how files fall
    into batches, and ``files_per_batch`` only bounds the work of one when a
    long backlog is waiting. ``distinct=False`` adds every row and is for a
    ``transform`` that drops none.

    Equal rows are told by a digest of 256 bits that is stored with each row,
    in ``buckets`` folders a commit. Feeds with event time can forget old rows:
    see ``ingest_within``.
    """

    # As the history was begun, so it goes on: looked up once, not for each batch.
    layout = _layout(spark, out, (ROW_DIGEST,), buckets) if distinct else None

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch)
        if not distinct:
            write_commit(rows, out, batch_id)
            return
        once = rows.withColumn(ROW_DIGEST, row_digest(rows.columns)).dropDuplicates([ROW_DIGEST])
        with kept(once) as held:
            write_commit(unseen_rows(held, out, batch_id, layout), out, batch_id, buckets=layout)

    run_once(spark, src_glob, fmt, schema, checkpoint, files_per_batch, handle)


def ingest_within(
    spark: SparkSession, src_glob: str, schema: StructType, transform: Transform, out: str,
    checkpoint: str, event_time: str, delay: str, fmt: str = "csv", files_per_batch: int | None = None,
) -> None:
    """``ingest_incremental`` for a feed with event time: equal rows count once within ``delay``.

    Spark keeps the rows seen in its state store and forgets each once the
    watermark, the latest event time less ``delay``, has passed it; no commit is
    read again. Rows later than that are not added, nor are rows without event
    time, which could never be forgotten. ``transform`` works row by row and
    leaves ``event_time`` a timestamp.
    """

    def once(rows: DataFrame) -> DataFrame:
        timed = transform(rows).where(F.col(f"`{event_time}`").isNotNull())
        return timed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark()

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_commit(batch, out, batch_id)

    run_once(spark, src_glob, fmt, schema, checkpoint, files_per_batch, handle, once)


def incremental_upsert(
    spark: SparkSession, src_glob: str, schema: StructType, transform: Transform,
    keys: str | Sequence[str], history_path: str, checkpoint: str,
    order_by: str | Column | Sequence[str | Column], fmt: str = "csv",
    files_per_batch: int | None = None, buckets: int = 64, base_every: int | None = 16,
) -> None:
    """Merge the rows of new files into a dimension kept as history.

    Per key and column the last value by ``order_by`` that is not null counts,
    over all files there ever were: the history also stores the order of each
    value, so a late file does not overwrite a newer value and the result does
    not depend on how files fall into batches. Of values of equal order the
    greatest counts. Rows without a key stand for no key and all stay. A batch
    looks up only its own keys, in the folders they can be in, and writes only
    new or changed rows. After each ``base_every`` batches a base gathers them
    (never with None), so later batches read a base and a few commits. Read the
    table with ``table_as_of(spark, history_path, keys=keys).drop(FOLD_ORDER)``.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    layout = _layout(spark, history_path, names, buckets)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with kept(fold_latest(transform(batch), names, order_by)) as source:
            asked = None if layout is None else layout.of(source)
            if layout is not None and base_every and batch_id and batch_id % base_every == 0:
                # The batches before this one are done for good.
                write_base(spark, history_path, batch_id - 1, layout)
            earlier = rows_until(spark, history_path, batch_id - 1, source.schema, layout, asked)
            write_commit(folded_changes(earlier, source, names), history_path, batch_id, buckets=layout)

    run_once(spark, src_glob, fmt, schema, checkpoint, files_per_batch, handle)
