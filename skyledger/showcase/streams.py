"""Incremental jobs over landed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import FOLD_ORDER, CleanSpec, as_of, clean, clean_rows, read_history, table_as_of
from ..session import work_dir
from ..sinks import export_json, land
from ..streaming import incremental_upsert, ingest_incremental, ingest_within
from .merging import CHANGES
from .registry import shown
from .standins import table, view

EVENT_SQL = "SELECT event_id, user_id, upper(event_type) AS event_type, {ts} AS timestamp FROM events"


@shown(
    EVENT_SQL.format(ts="CAST(ts AS VARCHAR)") + " UNION ALL "
    + EVENT_SQL.format(ts="CAST(ts + INTERVAL 1 YEAR AS VARCHAR)")
)
def ingest_days_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the events, ingest; ingest again; land them a year later, ingest."""
    root, out, checkpoint = (work_dir(spark, part) for part in ("raw", "ingested", "progress"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")

    def tidy(batch: DataFrame) -> DataFrame:
        return clean(batch, CleanSpec(upper=("event_type",)))

    def landed(rows: DataFrame) -> DataFrame:
        return rows.withColumn("timestamp", F.col("ts").cast("string")).drop("ts")

    schema = landed(events).schema
    later = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 YEAR"))
    for rows in (events, None, later):
        if rows is not None:
            # Each row twice in its file: the batch's cleaning keeps one.
            land(landed(rows.union(rows)), root, "events", "csv", "timestamp")
        ingest_incremental(
            spark, f"{root}/csv/events/*/*/*", schema, tidy, out, checkpoint, fmt="csv"
        )
    return as_of(read_history(spark, out))


FOLDED = (
    f"{CHANGES}, fed AS (SELECT id, name, iata, status, CAST(0 AS BIGINT) AS seq FROM airlines "
    "UNION ALL SELECT id, name, iata, status, seq FROM changes), folded AS (SELECT id, "
    "max_by(name, seq) FILTER (WHERE name IS NOT NULL) AS name, "
    "max_by(iata, seq) FILTER (WHERE iata IS NOT NULL) AS iata, "
    "max_by(status, seq) FILTER (WHERE status IS NOT NULL) AS status FROM fed WHERE id IS NOT NULL GROUP BY id "
    "UNION ALL SELECT id, name, iata, status FROM fed WHERE id IS NULL)"
)


def _upserted(spark: SparkSession, sf_dir: str, files_per_batch: int | None) -> DataFrame:
    """A dimension kept as history from files that come late, repeat keys, hold nulls and lack ids."""
    feed, history, checkpoint = (work_dir(spark, part) for part in ("feed", "dim", "progress"))
    airlines = view(spark, sf_dir, "airlines").selectExpr(
        "id", "name", "iata", "status", "CAST(0 AS BIGINT) AS seq"
    )
    changes = view(spark, sf_dir, "airline_changes")
    # The newest changes land first, the master last; the last run brings nothing new.
    parts = [changes.where(f"pmod(seq, 3) = {k}") for k in (2, 0, 1)]
    for number, rows in enumerate((*parts, airlines, None)):
        if rows is not None:
            export_json(rows, f"{feed}/run={number}")
        if number in (1, 3, 4):
            incremental_upsert(
                spark, f"{feed}/*", airlines.schema, lambda batch: batch, "id", history, checkpoint,
                order_by="seq", fmt="jsonl", files_per_batch=files_per_batch, base_every=3,
            )
    return table_as_of(spark, history, keys="id").drop("seq", FOLD_ORDER)


@shown(f"{FOLDED} SELECT * FROM folded")
def upsert_days_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir, None)


@shown(
    f"{FOLDED} SELECT CAST(cut AS BIGINT) AS cut, folded.* FROM folded, (VALUES (1), (3)) AS cuts(cut)"
)
def upsert_in_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same feed in batches of one and of three files."""
    one, three = (
        _upserted(spark, sf_dir, cut).withColumn("cut", F.lit(cut).cast("long")) for cut in (1, 3)
    )
    return one.union(three)


@shown("SELECT event_id, user_id, upper(event_type) AS event_type FROM events")
def ingest_in_small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row in two files, one file to a batch; a row is added once."""
    root, out, checkpoint = (work_dir(spark, part) for part in ("raw", "ingested", "progress"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    for number in range(2):
        export_json(events, f"{root}/run={number}")

    def tidy(batch: DataFrame) -> DataFrame:
        return clean(batch, CleanSpec(upper=("event_type",)))

    ingest_incremental(
        spark, f"{root}/*", events.schema, tidy, out, checkpoint, fmt="jsonl", files_per_batch=1
    )
    return as_of(read_history(spark, out))


@shown("SELECT event_id, user_id, upper(event_type) AS event_type, ts FROM events")
def ingest_within_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events land quarter by quarter, each with the quarter before once more; a row is added once."""
    root, out, checkpoint = (work_dir(spark, part) for part in ("raw", "ingested", "progress"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    step = (last - first) / 4 if first else None
    for k in range(4 if first else 0):
        since, until = first + step * max(0, k - 1), first + step * (k + 1)
        end = F.col("ts") <= last if k == 3 else F.col("ts") < until
        events.where((F.col("ts") >= since) & end).write.parquet(f"{root}/run={k}")
        ingest_within(
            spark, f"{root}/*", events.schema, lambda batch: clean_rows(batch, CleanSpec(upper=("event_type",))), out, checkpoint,
            event_time="ts", delay=f"{int(step.total_seconds()) * 2 + 60} seconds", fmt="parquet",
        )
    rows = as_of(read_history(spark, out)) if first else events
    return rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
