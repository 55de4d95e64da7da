"""History queries: two commits of a dimension, the second written twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    Buckets, as_of, changed_rows, commits, compact, dedupe_latest, files, read_history, snapshots, table_as_of, write_base,
    write_commit,
)
from ..session import work_dir
from .merging import CHANGES, LATEST_CHANGES
from .registry import shown
from .standins import view

COLUMNS = ("id", "name", "iata", "status", "hub")
PICKED = ", ".join(COLUMNS)
WRITTEN = (
    f"{CHANGES}, latest AS ({LATEST_CHANGES} UNION ALL "
    "SELECT id, name, iata, status FROM changes WHERE id IS NULL), second AS (SELECT s.id, "
    "coalesce(s.name, t.name) AS name, coalesce(s.iata, t.iata) AS iata, "
    "coalesce(s.status, t.status) AS status, t.hub FROM latest s LEFT JOIN airlines t ON s.id = t.id)"
)


def _commits(spark: SparkSession, sf_dir: str) -> str:
    path = work_dir(spark, "history")
    first = view(spark, sf_dir, "airlines").select(*COLUMNS)
    write_commit(first, path, 1)
    changes = view(spark, sf_dir, "airline_changes")
    source = dedupe_latest(changes, "id", "seq").drop("seq")
    for _ in range(2):
        current = as_of(read_history(spark, path), 1, "id")
        write_commit(changed_rows(current, source, "id"), path, 2)
    return path


@shown(f"{CHANGES} SELECT {PICKED} FROM airlines")
def history_first_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(read_history(spark, _commits(spark, sf_dir)), 1, "id")


@shown(
    f"{WRITTEN} SELECT {PICKED} FROM second UNION ALL "
    f"SELECT {PICKED} FROM airlines WHERE id NOT IN (SELECT id FROM second WHERE id IS NOT NULL)"
)
def history_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_of(read_history(spark, _commits(spark, sf_dir)), keys="id")


COUNTED = (
    f"{WRITTEN} SELECT CAST(1 AS BIGINT) AS commit_id, CAST(count(*) AS BIGINT) AS n_rows "
    "FROM airlines UNION ALL SELECT 2, count(*) FROM second"
)


@shown(COUNTED)
def history_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = snapshots(read_history(spark, _commits(spark, sf_dir)))
    in_order = F.col("first_committed_at") <= F.col("last_committed_at")
    return listed.where(in_order).select("commit_id", "n_rows")


@shown(COUNTED)
def history_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per commit, added up from the files that hold them."""
    listed = files(spark.read.parquet(_commits(spark, sf_dir)))
    commit = F.regexp_extract("file_path", "commit_id=([0-9]+)", 1).cast("long")
    return (
        listed.where(F.col("file_size") > 0)
        .groupBy(commit.alias("commit_id"))
        .agg(F.sum("n_rows").alias("n_rows"))
    )


@shown(
    f"{WRITTEN}, kept AS (SELECT {PICKED} FROM second UNION ALL "
    f"SELECT {PICKED} FROM airlines WHERE id NOT IN (SELECT id FROM second WHERE id IS NOT NULL)) "
    f"SELECT CAST(2 AS BIGINT) AS commit_id, {PICKED} FROM kept"
)
def history_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, small = _commits(spark, sf_dir), work_dir(spark, "compact")
    compact(spark, path, small, 2, "id")
    return read_history(spark, small).drop("committed_at")


PARTS = 3
DEALT = Buckets(("id",), 16)


def _chain() -> str:
    """The dimension after each third of the changes, one table a commit."""
    steps = [f"{CHANGES}, t0 AS (SELECT {PICKED} FROM airlines)"]
    for k in range(PARTS):
        steps.append(
            f"l{k} AS (SELECT id, name, iata, status FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn "
            f"FROM changes WHERE id IS NOT NULL AND seq % {PARTS} = {k}) AS r WHERE rn = 1)"
        )
        steps.append(
            f"t{k + 1} AS (SELECT coalesce(s.id, t.id) AS id, coalesce(s.name, t.name) AS name, coalesce(s.iata, t.iata) AS iata, "
            f"coalesce(s.status, t.status) AS status, t.hub FROM t{k} t FULL OUTER JOIN l{k} s ON s.id = t.id)"
        )
    return ", ".join(steps)


def _long_history(spark: SparkSession, sf_dir: str) -> str:
    """The master and three batches of changes as commits in key buckets; a base after the second and third."""
    path = work_dir(spark, "history")
    write_commit(view(spark, sf_dir, "airlines").select(*COLUMNS), path, 0, buckets=DEALT)
    changes = view(spark, sf_dir, "airline_changes").where("id IS NOT NULL")
    for k in range(PARTS):
        source = dedupe_latest(changes.where(f"pmod(seq, {PARTS}) = {k}"), "id", "seq").drop("seq")
        current = table_as_of(spark, path, k, "id")
        write_commit(changed_rows(current, source, "id"), path, k + 1, buckets=DEALT)
        if k < PARTS - 1:
            write_base(spark, path, k + 1, DEALT)
    return path


@shown(
    f"{_chain()} "
    + " UNION ALL ".join(f"SELECT CAST({k} AS BIGINT) AS commit_id, {PICKED} FROM t{k}" for k in range(PARTS + 1))
)
def history_at_each_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as of every commit, from the nearest base and what follows."""
    path, shown_at = _long_history(spark, sf_dir), []
    for k in range(PARTS + 1):
        shown_at.append(table_as_of(spark, path, k, "id").select(F.lit(k).cast("long").alias("commit_id"), *COLUMNS))
    first, *rest = shown_at
    for rows in rest:
        first = first.union(rows)
    return first


@shown(
    f"{WRITTEN} SELECT CAST(1 AS BIGINT) AS commit_id, CAST(count(*) AS BIGINT) AS n_rows FROM airlines "
    "UNION ALL SELECT 2, count(*) FROM second UNION ALL SELECT 3, 0"
)
def history_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All commits from the log; the third changes nothing and holds no rows."""
    path = _commits(spark, sf_dir)
    current = table_as_of(spark, path, 2, "id")
    write_commit(changed_rows(current, current.where("id IS NOT NULL"), "id"), path, 3)
    listed = commits(spark, path).where(F.col("first_committed_at") <= F.col("last_committed_at"))
    return listed.select("commit_id", "n_rows")
