"""Catalog tables: replace, append, overwrite the touched partitions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import pin
from ..sources.tables import table_exists


def ensure_namespace(spark: SparkSession, namespace: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{where}")


def _partitions(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def clustered(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Bring rows of a partition together before a partitioned write.

    The rebalance hint sends a partition value to few writers, and adaptive
    execution cuts a value that is too big for one writer into several files.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    order = [*partition_by, *sort_by]
    return df.sortWithinPartitions(*order) if order else df


def recover(spark: SparkSession, table: str) -> None:
    """Finish or undo a replacement that was stopped between its renames.

    The old table only goes once the new one has its name, so one of them is whole.
    """
    if _has_own_catalog(table):
        return
    old = f"{table}__old"
    if table_exists(spark, old):
        if table_exists(spark, table):
            spark.sql(f"DROP TABLE {old}")
        else:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")


def _has_own_catalog(table: str) -> bool:
    return table.count(".") > 1 and not table.startswith("spark_catalog.")


def publish(
    df: DataFrame, table: str, mode: str = "replace",
    partition_by: Sequence[str] = (), sort_by: Sequence[str] = (), fmt: str = "parquet",
    within: Mapping[str, str] | None = None,
) -> None:
    """Write ``df`` to ``table``.

    ``replace``: the table holds exactly these rows; they are built before the
    old table goes, so ``df`` may read the table it replaces.
    ``append``: add the rows, creating the table when absent.
    ``overwrite_partitions``: replace only the partitions that occur in ``df``
    (the whole table when it has no partitions), so a rerun changes nothing.
    ``replace_slice``: replace all partitions with the values ``within`` gives,
    also those that no longer occur; without rows the slice is emptied. The rows
    are computed and stored first, so a failing query changes nothing.

    A table of a catalog of its own (``catalog.namespace.table``) is written
    through that catalog's atomic operations; ``fmt`` is for the built-in one.
    """
    spark = df.sparkSession
    if mode not in ("replace", "append", "overwrite_partitions", "replace_slice"):
        raise ValueError(f"unknown mode {mode!r}")
    if (mode == "replace_slice") != bool(within):
        raise ValueError("within goes with replace_slice")
    recover(spark, table)
    exists = table_exists(spark, table)
    if _has_own_catalog(table):
        _publish_to_catalog(df, table, mode, exists, partition_by, sort_by, within or {})
        return
    # An existing table's own partitions count, whatever the caller remembers of them.
    own = _partitions(spark, table) if exists and mode != "replace" else list(partition_by)
    if partition_by and own != list(partition_by):
        raise ValueError(f"{table} is partitioned by {own}, not by {list(partition_by)}")
    if not exists or mode == "replace" or (mode == "overwrite_partitions" and not own):
        _replace(df, table, exists, own, sort_by, fmt)
        return
    columns = spark.table(table).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"{table} has columns {columns}, the new rows have {df.columns}")
    if mode == "replace_slice":
        _replace_slice(clustered(pin(df.select(*columns)), own, sort_by), table, own, within)
        return
    rows = clustered(df.select(*columns), own, sort_by)
    if mode == "append":
        rows.write.insertInto(table)
        return
    with _overwriting(spark, "dynamic"):
        rows.write.insertInto(table, overwrite=True)


@contextmanager
def _overwriting(spark: SparkSession, how: str) -> Iterator[None]:
    """Inserts take this from the session only; writes of other threads see it meanwhile."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, how)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _replace_slice(rows: DataFrame, table: str, own: Sequence[str], within: Mapping[str, str]) -> None:
    if list(within) != own[: len(within)]:
        raise ValueError(f"{table} is partitioned by {own}, not first by {list(within)}")
    spark, name = rows.sparkSession, f"slice_{uuid.uuid4().hex}"
    spec = ", ".join([*(f"`{c}` = '{v}'" for c, v in within.items()), *(f"`{c}`" for c in own[len(within) :])])
    rows.drop(*within).createOrReplaceTempView(name)
    try:
        with _overwriting(spark, "static"):
            spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({spec}) SELECT * FROM {name}")
    finally:
        spark.catalog.dropTempView(name)


def _publish_to_catalog(
    df: DataFrame, table: str, mode: str, exists: bool, partition_by: Sequence[str],
    sort_by: Sequence[str], within: Mapping[str, str],
) -> None:
    writer = clustered(df, partition_by, sort_by).writeTo(table)
    if mode == "replace" or not exists:
        if partition_by:
            writer = writer.partitionedBy(*[F.col(c) for c in partition_by])
        writer.createOrReplace()
    elif mode == "append":
        writer.append()
    elif mode == "replace_slice":
        writer.overwrite(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in within.items()]))
    else:
        writer.overwritePartitions()


def _replace(
    df: DataFrame, table: str, exists: bool, partition_by: Sequence[str], sort_by: Sequence[str],
    fmt: str,
) -> None:
    spark = df.sparkSession
    built = f"{table}__next" if exists else table
    spark.sql(f"DROP TABLE IF EXISTS {built}")
    writer = clustered(df, partition_by, sort_by).write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(built)
    if exists:
        old = f"{table}__old"  # gone by now: recover() came first
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        spark.sql(f"ALTER TABLE {built} RENAME TO {table}")
        spark.sql(f"DROP TABLE {old}")
