"""Commit-tagged history: append-only Parquet, one folder per commit.

A commit may be dealt into folders by a hash of its keys (``Buckets``), so that
a reader who knows which keys it wants lists and reads only their folders.
``write_base`` gathers what came since the last base: reading the table as of a
commit then takes the nearest base and the commits after it. A log under
``_log`` holds a row per commit and base, written last: a base without one does
not count.

Where the catalog has a table format with its own snapshots, use its SQL
(``VERSION AS OF``) instead.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import read_or_empty
from .merging import dedupe_latest

COMMIT_COLUMNS = ("commit_id", "committed_at")
#: The folder of a row's keys, and a digest of a row: kept beside the rows, not part of the table.
KEY_BUCKET, ROW_DIGEST = "key_bucket", "row_digest"
NO_KEY = "none"
#: In the log of a base: its rows without a key are those since the base before; ``NO_KEY`` stands for all there were.
NO_KEY_SINCE = "none_since"
#: So many commits in a row are opened by name, more by listing the whole history.
BY_NAME = 1000
LOG = (
    "kind string, commit_id long, first_committed_at timestamp, last_committed_at timestamp, "
    "n_rows long, buckets array<string>"
)


@dataclass(frozen=True)
class Buckets:
    """Deals rows into ``count`` folders a commit by a hash of ``keys``.

    The folder's name holds the count too, so a history whose count was changed
    stays readable: folders of another count are never passed over. A row that
    lacks a key is in a folder of its own.
    """

    keys: tuple[str, ...]
    count: int = 64

    def label(self) -> Column:
        columns = [F.col(f"`{k}`").cast("string") for k in self.keys]
        number = F.pmod(F.xxhash64(*columns), F.lit(self.count)).cast("string")
        missing = reduce(lambda a, b: a | b, [c.isNull() for c in columns])
        return F.when(missing, NO_KEY).otherwise(F.concat(number, F.lit(f"of{self.count}")))

    def of(self, batch: DataFrame) -> list[str]:
        """The folders that keys of ``batch`` can be in, at most ``count`` names."""
        found = batch.select(self.label().alias("b")).where(F.col("b") != NO_KEY).distinct()
        return sorted(r["b"] for r in found.collect())

    def only(self, history: DataFrame, names: Sequence[str]) -> DataFrame:
        """The rows of these folders and of those dealt out by another count."""
        if KEY_BUCKET not in history.columns:
            return history
        other = ~F.col(KEY_BUCKET).endswith(f"of{self.count}") & (F.col(KEY_BUCKET) != NO_KEY)
        return history.where(F.col(KEY_BUCKET).isin(*names) | other | F.col(KEY_BUCKET).isNull())


def _write(df: DataFrame, path: str, buckets: Buckets | None) -> None:
    if buckets is None:
        df.write.mode("overwrite").parquet(path)
        return
    # A bucket goes to few writers; adaptive execution cuts one that is too big. Rows without a key,
    # which may be most, go to many: cut by bytes on the wire they would be far more in memory.
    spread = F.when(F.col(KEY_BUCKET) == NO_KEY, F.spark_partition_id() % buckets.count).otherwise(0)
    dealt = df.withColumn(KEY_BUCKET, buckets.label()).withColumn("__spread", spread)
    dealt = dealt.hint("rebalance", KEY_BUCKET, "__spread").drop("__spread")
    dealt.write.mode("overwrite").partitionBy(KEY_BUCKET).parquet(path)


def _mark(spark: SparkSession, path: str, kind: str, commit_id: int, **facts: object) -> None:
    schema = StructType([f for f in StructType.fromDDL(LOG).fields if f.name not in ("kind", "commit_id")])
    row = spark.createDataFrame([tuple(facts.get(n) for n in schema.fieldNames())], schema)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/_log/kind={kind}/commit_id={commit_id}")


def _log(spark: SparkSession, path: str, kind: str) -> DataFrame:
    schema = StructType.fromDDL(LOG)
    log = read_or_empty(spark, lambda: spark.read.schema(schema).parquet(f"{path}/_log"), schema)
    return log.where(F.col("kind") == kind).drop("kind")


def write_commit(
    df: DataFrame, path: str, commit_id: int, committed_at: Column | None = None, buckets: Buckets | None = None
) -> None:
    """Store ``df`` as commit ``commit_id``. Writing it again replaces that commit only."""
    spark = df.sparkSession
    when = committed_at if committed_at is not None else F.current_timestamp()
    folder, rows = f"{path}/commit_id={commit_id}", df.withColumn("committed_at", when)
    _write(rows, folder, buckets)
    # One column of what was written tells times and count.
    stored = spark.read.schema(rows.select("committed_at").schema).parquet(folder)
    first, last = (F.coalesce(f("committed_at"), F.current_timestamp()).cast("timestamp") for f in (F.min, F.max))
    facts = stored.agg(first.alias("first_committed_at"), last.alias("last_committed_at"), F.count("*").alias("n_rows")).first()
    if buckets is not None and not facts["n_rows"]:
        # Dealt out, no rows are no files; one keeps the columns known.
        rows.limit(0).write.mode("overwrite").parquet(f"{folder}/{KEY_BUCKET}={NO_KEY}")
    _mark(spark, path, "commit", commit_id, **facts.asDict())


def read_history(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All commits with ``commit_id`` and ``committed_at``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).withColumn("commit_id", F.col("commit_id").cast("long"))


def _shown(rows: DataFrame) -> DataFrame:
    return rows.drop(*COMMIT_COLUMNS, KEY_BUCKET, ROW_DIGEST)


def as_of(
    history: DataFrame, commit_id: int | None = None, keys: str | Sequence[str] | None = None
) -> DataFrame:
    """The table as it was right after a commit (the newest one by default).

    Without ``keys`` the table is append-only and holds every row so far; with
    keys each key shows its latest row, null keys aside. Commit folders after
    ``commit_id`` are not read. ``table_as_of`` also takes bases.
    """
    rows = history if commit_id is None else history.where(F.col("commit_id") <= commit_id)
    if keys is not None:
        rows = dedupe_latest(rows, keys, "commit_id")
    return _shown(rows)


def rows_until(
    spark: SparkSession, path: str, commit_id: int | None = None, schema: StructType | None = None,
    buckets: Buckets | None = None, names: Sequence[str] | None = None,
) -> DataFrame:
    """Rows that make up the table as of a commit: of the nearest bases and of the commits after them.

    A key may come several times, its greatest ``commit_id`` counts. With
    ``buckets`` and ``names`` only those folders are read. ``schema`` holds the
    table's own columns and is needed where there may be no commit yet.
    """
    wanted = F.lit(True) if commit_id is None else F.col("commit_id") <= commit_id
    bases = _log(spark, path, "base").where(wanted)
    # As many rows as there are folders in a commit: for each the newest base that holds it.
    found = bases.select("commit_id", F.explode_outer("buckets").alias("b"))
    newest = found.groupBy("b").agg(F.max("commit_id").alias("at"), F.collect_set("commit_id").alias("all")).collect()
    after = max((r["at"] for r in newest), default=None)
    history = _opened(spark, path, schema, after, commit_id)
    rows = history.where(wanted if after is None else wanted & (F.col("commit_id") > after))
    if after is not None:
        keyed: dict[int, list[str]] = {}
        gathered = max((r["at"] for r in newest if r["b"] == NO_KEY), default=-1)
        for r in newest:
            if r["b"] == NO_KEY_SINCE:
                if names is None:
                    for at in r["all"]:
                        if at > gathered:
                            keyed.setdefault(at, []).append(NO_KEY)
            elif r["b"] is not None:
                keyed.setdefault(r["at"], []).append(r["b"])
        if keyed:
            held = _opened(spark, f"{path}/_bases", schema, among=sorted(keyed))
            picks = [(F.col("commit_id") == at) & F.col(KEY_BUCKET).isin(*sorted(own)) for at, own in sorted(keyed.items())]
            held = held.where(reduce(lambda a, b: a | b, picks))
        else:
            held = _opened(spark, f"{path}/_bases", schema)
            held = held.join(bases.select("commit_id"), "commit_id", "left_semi")
        rows = held.unionByName(rows, allowMissingColumns=True)
    return rows if buckets is None or names is None else buckets.only(rows, names)


def _opened(
    spark: SparkSession, path: str, schema: StructType | None, after: int | None = None, until: int | None = None,
    among: Sequence[int] | None = None,
) -> DataFrame:
    """The commits at ``path``, at least those ``after`` and ``until`` a commit, or those ``among`` some.

    Where they are few enough to be named, folders of others are not even listed: listing all
    of them for each batch would take longer with each batch.
    """
    if among is None and after is not None and until is not None and until - after <= BY_NAME:
        among = range(after + 1, until + 1)
    if schema is None:
        if not among:
            return read_history(spark, path)
        columns = read_or_empty(spark, lambda: _named(spark, path, among), StructType())
        return columns if "commit_id" in columns.columns else read_history(spark, path).where("false")
    full = StructType([*schema.fields]).add("committed_at", "timestamp").add("commit_id", "long")
    if among is not None and not among:
        return spark.createDataFrame([], full)
    own = StructType(full.fields[:-1])
    rows = read_or_empty(spark, lambda: read_history(spark, path, own) if among is None else _named(spark, path, among, own), full)
    return rows if "commit_id" in rows.columns else spark.createDataFrame([], full)


def _named(spark: SparkSession, path: str, among: Sequence[int], schema: StructType | None = None) -> DataFrame:
    """``read_history`` of some commits; such as are not there are passed over."""
    reader = spark.read.option("basePath", path)
    reader = reader if schema is None else reader.schema(schema)
    rows = reader.parquet(f"{path}/commit_id={{{','.join(map(str, among))}}}")
    return rows.withColumn("commit_id", F.col("commit_id").cast("long"))


def table_as_of(
    spark: SparkSession, path: str, commit_id: int | None = None, keys: str | Sequence[str] | None = None
) -> DataFrame:
    """The table right after a commit (the newest by default), from the nearest base and what follows.

    Same rows as ``as_of``; folders of commits that a base has gathered are not read.
    """
    rows = rows_until(spark, path, commit_id)
    return _shown(rows if keys is None else dedupe_latest(rows, keys, "commit_id"))


def write_base(
    spark: SparkSession, path: str, commit_id: int, buckets: Buckets | None = None
) -> None:
    """Gather what came up to ``commit_id`` since the last base.

    With ``buckets`` each key's latest row is kept, and only the folders that
    commits since the last base touched are written again; the others stay with
    the base that holds them. Rows without a key all stay, so older ones are not
    written again either. Without, the table is append-only: the commits
    since the last base become one folder, and no older row is written again.
    Writing a base again replaces it; a commit of that number or less must not
    be written again afterwards.
    """
    if buckets is not None and not dealt(spark, path):
        raise ValueError(f"the commits of {path} are not dealt into folders")
    last = _log(spark, path, "base").where(F.col("commit_id") < commit_id).agg(F.max("commit_id")).first()[0]
    since = _opened(spark, path, None, last, commit_id).where(F.col("commit_id") <= commit_id)
    if last is not None:
        since = since.where(F.col("commit_id") > last)
    folder, names = f"{path}/_bases/commit_id={commit_id}", None
    if buckets is None:
        since.drop("commit_id").write.mode("overwrite").parquet(folder)
    else:
        names = {r[0] for r in since.select(KEY_BUCKET).distinct().collect()}
        older = _log(spark, path, "base").where(F.col("commit_id") < commit_id).select(F.explode("buckets")).distinct()
        older = {r[0] for r in older.collect()}
        if any(not n.endswith(f"of{buckets.count}") for n in (names | older) - {NO_KEY, NO_KEY_SINCE}):
            names |= older - {NO_KEY, NO_KEY_SINCE}  # the count was changed: everything is dealt out anew
        before = rows_until(spark, path, last) if last is not None else since.where("false")
        touched = before.where(F.col(KEY_BUCKET).isin(*sorted(names - {NO_KEY}))).unionByName(since, allowMissingColumns=True)
        _write(dedupe_latest(touched, buckets.keys, "commit_id").drop("commit_id"), folder, buckets)
        names |= {r[0] for r in spark.read.parquet(folder).select(KEY_BUCKET).distinct().collect()} if names else set()
        names = {NO_KEY_SINCE if n == NO_KEY else n for n in names}
    now = spark.range(1).select(F.current_timestamp()).first()[0]
    _mark(spark, path, "base", commit_id, first_committed_at=now, last_committed_at=now, buckets=None if names is None else sorted(names))


def dealt(spark: SparkSession, path: str) -> bool:
    """Whether the history's commits are dealt into folders; also where there is none yet."""
    schema = StructType().add("committed_at", "timestamp")
    found = read_or_empty(spark, lambda: spark.read.schema(schema).parquet(path), schema).columns
    return KEY_BUCKET in found or "commit_id" not in found


def commits(spark: SparkSession, path: str) -> DataFrame:
    """One row per commit, from the log: ``commit_id``, first and last ``committed_at``, ``n_rows``.

    A commit without rows is listed too, and no commit's rows are read.
    """
    return _log(spark, path, "commit").drop("buckets")


def snapshots(history: DataFrame) -> DataFrame:
    """One row per commit that has rows: when it was written and how many there are.

    For any frame of commits, say a part of a history; ``commits`` lists a whole one from its log.
    """
    return history.groupBy("commit_id").agg(
        F.min("committed_at").alias("first_committed_at"),
        F.max("committed_at").alias("last_committed_at"),
        F.count("*").alias("n_rows"),
    )


def files(df: DataFrame) -> DataFrame:
    """The data files behind a file scan, with size, time and row count."""
    return (
        df.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
        .groupBy("file_path", "file_size", "file_modification_time")
        .agg(F.count("*").alias("n_rows"))
    )


def compact(
    spark: SparkSession, path: str, new_path: str, commit_id: int,
    keys: str | Sequence[str] | None = None,
) -> None:
    """Write the table as of ``commit_id`` to ``new_path`` as that one commit.

    Many small commits become few files; without ``keys`` every row stays.
    """
    write_commit(table_as_of(spark, path, commit_id, keys), new_path, commit_id)
