"""Merge queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import apply_updates, changed_rows, clean, dedupe_latest, merge_upsert
from ..plans import specs
from .cleaning import CLEANED_VIEWS
from .registry import shown
from .standins import table, view, view_sql, with_sql

AIRLINE_COLUMNS = (
    "id", "name", "iata", "icao", "callsign", "country_code", "country", "hub", "status",
    "created_at", "updated_at",
)


def _outer_sql(columns: tuple[str, ...], target: str = "airlines", source: str = "airline_batch") -> str:
    picked = ", ".join(f"coalesce(s.{c}, t.{c}) AS {c}" for c in columns)
    return f"SELECT {picked} FROM {target} t FULL OUTER JOIN {source} s ON s.id = t.id"


def _airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(view(spark, sf_dir, "airlines"), specs.AIRLINES)


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(view(spark, sf_dir, "airline_batch"), specs.AIRLINES)


@shown(f"{CLEANED_VIEWS} {_outer_sql(AIRLINE_COLUMNS)}")
def merge_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(_airlines(spark, sf_dir), _batch(spark, sf_dir), "id")


SUBSET = ("id", "name", "icao", "country_code", "hub")


@shown(f"{CLEANED_VIEWS} {_outer_sql(SUBSET)}")
def merge_column_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(_airlines(spark, sf_dir), _batch(spark, sf_dir), "id", columns=SUBSET)


RAW = with_sql(airlines=view_sql("airlines"), airline_batch=view_sql("airline_batch"))
RAW_COLUMNS = ("id", "name", "iata", "hub")


@shown(
    f"{RAW} SELECT id, coalesce(name, 'Unknown') AS name, coalesce(iata, 'XXX') AS iata, hub "
    f"FROM ({_outer_sql(RAW_COLUMNS)}) AS merged"
)
def merge_fill_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(
        view(spark, sf_dir, "airlines"), view(spark, sf_dir, "airline_batch"), "id",
        columns=RAW_COLUMNS, fill_after_merge={"name": "Unknown", "iata": "XXX"},
    )


CHANGES = with_sql(airlines=view_sql("airlines"), changes=view_sql("airline_changes"))


@shown(
    f"{CHANGES} SELECT coalesce(s.id, t.id) AS id, coalesce(s.name, t.name) AS name, "
    "coalesce(s.iata, t.iata) AS iata, coalesce(s.status, t.status) AS status, t.hub "
    "FROM airlines t FULL OUTER JOIN changes s ON s.id = t.id"
)
def merge_repeated_and_null_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_upsert(
        view(spark, sf_dir, "airlines").select("id", "name", "iata", "status", "hub"),
        view(spark, sf_dir, "airline_changes").drop("seq"), "id",
    )


@shown(
    f"{CHANGES} SELECT id, name, iata, status, seq FROM ("
    "SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn FROM changes "
    "WHERE id IS NOT NULL) AS ranked WHERE rn = 1 "
    "UNION ALL SELECT id, name, iata, status, seq FROM changes WHERE id IS NULL"
)
def latest_change_per_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_latest(view(spark, sf_dir, "airline_changes"), "id", "seq")


@shown(
    "SELECT event_id, user_id, event_type, value, CAST(ts AS VARCHAR) AS ts FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY ts DESC, event_id DESC) AS rn FROM events) AS ranked WHERE rn = 1"
)
def dedupe_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").drop("props")
    latest = dedupe_latest(events, ["user_id", "event_type"], ["ts", "event_id"])
    return latest.withColumn("ts", F.col("ts").cast("string"))


LATEST_CHANGES = (
    "SELECT id, name, iata, status FROM (SELECT *, row_number() OVER "
    "(PARTITION BY id ORDER BY seq DESC) AS rn FROM changes WHERE id IS NOT NULL) AS ranked "
    "WHERE rn = 1"
)


@shown(
    f"{CHANGES}, latest AS ({LATEST_CHANGES} UNION ALL "
    "SELECT id, name, iata, status FROM changes WHERE id IS NULL) "
    "SELECT s.id, coalesce(s.name, t.name) AS name, "
    "coalesce(s.iata, t.iata) AS iata, coalesce(s.status, t.status) AS status, t.hub "
    "FROM latest s LEFT JOIN airlines t ON s.id = t.id WHERE t.id IS NULL "
    "OR coalesce(s.name, t.name) IS DISTINCT FROM t.name "
    "OR coalesce(s.iata, t.iata) IS DISTINCT FROM t.iata "
    "OR coalesce(s.status, t.status) IS DISTINCT FROM t.status"
)
def changed_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = view(spark, sf_dir, "airline_changes")
    current = view(spark, sf_dir, "airlines").select("id", "name", "iata", "status", "hub")
    return changed_rows(current, dedupe_latest(changes, "id", "seq").drop("seq"), "id")


@shown(
    f"{CHANGES}, latest AS ({LATEST_CHANGES}) SELECT t.id, t.iata, "
    "CASE WHEN s.id IS NULL THEN t.name ELSE 'Updated ' || t.name END AS name, "
    "coalesce(s.status, t.status) AS status, t.hub, "
    "CASE WHEN s.id IS NULL THEN t.updated_at ELSE '2024-03-01T00:00:00' END AS updated_at "
    "FROM airlines t LEFT JOIN latest s ON s.id = t.id"
)
def update_airlines_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "airlines").select("id", "iata", "name", "status", "hub", "updated_at")
    updates = view(spark, sf_dir, "airline_changes").select("id", "status", "seq")
    return apply_updates(
        rows, updates, "id", "updated_at", "2024-03-01T00:00:00",
        derive={"name": F.concat(F.lit("Updated "), F.col("name"))}, order_by="seq",
    )


@shown(
    f"{CHANGES}, latest AS ({LATEST_CHANGES} UNION ALL "
    "SELECT id, name, iata, status FROM changes WHERE id IS NULL) "
    "SELECT coalesce(s.id, t.id) AS id, coalesce(s.name, t.name) AS name, "
    "coalesce(s.iata, t.iata) AS iata, coalesce(s.status, t.status) AS status, t.hub "
    "FROM airlines t FULL OUTER JOIN latest s ON s.id = t.id"
)
def merge_latest_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    airlines = view(spark, sf_dir, "airlines").select("id", "name", "iata", "status", "hub")
    return merge_upsert(
        airlines, view(spark, sf_dir, "airline_changes"), "id", columns=airlines.columns,
        latest_by="seq",
    )
