"""Mart queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, enrich, merge_upsert
from ..plans import gold, specs
from ..plans.increments import refresh_gold
from ..plans.silver import Layers
from ..session import work_dir
from ..sinks import ensure_namespace, publish
from .cleaning import CLEANED_VIEWS
from .merging import AIRLINE_COLUMNS, _outer_sql
from .registry import shown
from .standins import table, view

FLIGHT_SQL = (
    "SELECT f.flight_id, f.flight_number, f.airline_iata, a.name AS airline_name, "
    "f.aircraft_type, f.departure_airport_iata, f.arrival_airport_iata, f.distance_km, "
    "f.status AS flight_status FROM flights f LEFT JOIN {airlines} a ON f.airline_iata = a.iata "
    "AND a.iata <> 'XXX'"
)


def _clean(spark: SparkSession, sf_dir: str, name: str, spec: str) -> DataFrame:
    return clean(view(spark, sf_dir, name), getattr(specs, spec))


@shown(f"{CLEANED_VIEWS}, merged AS ({_outer_sql(AIRLINE_COLUMNS)}) " + FLIGHT_SQL.format(airlines="merged"))
def silver_to_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean a dimension and a fact, merge a batch into the dimension, join."""
    airlines = merge_upsert(
        _clean(spark, sf_dir, "airlines", "AIRLINES"),
        _clean(spark, sf_dir, "airline_batch", "AIRLINES"), "id",
    )
    return gold.flight_performance(_clean(spark, sf_dir, "flights", "FLIGHTS"), airlines)


@shown(f"{CLEANED_VIEWS} " + FLIGHT_SQL.format(airlines="airlines"))
def flight_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.flight_performance(
        _clean(spark, sf_dir, "flights", "FLIGHTS"), _clean(spark, sf_dir, "airlines", "AIRLINES")
    )


@shown(
    f"{CLEANED_VIEWS} SELECT a.airport_id, a.airport_name, a.country_iso2, c.name AS country_name, "
    "c.continent, c.population FROM airports a LEFT JOIN countries c ON a.country_iso2 = c.iso2 "
    "AND c.iso2 <> 'XX'"
)
def airport_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.airport_capacity(
        _clean(spark, sf_dir, "airports", "AIRPORTS"),
        _clean(spark, sf_dir, "countries", "COUNTRIES"), unique_dim=True,
    )


@shown(
    f"{CLEANED_VIEWS} SELECT i.city_name, i.country_iso2, c.name AS country_name, i.latitude, "
    "i.longitude, w.temperature_c, w.humidity, w.wind_speed_kmh, w.weather_desc "
    "FROM cities i LEFT JOIN weather w ON i.iata_code = upper(w.city) "
    "LEFT JOIN countries c ON i.country_iso2 = c.iso2 AND c.iso2 <> 'XX'"
)
def city_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.city_weather(
        _clean(spark, sf_dir, "cities", "CITIES"), _clean(spark, sf_dir, "weather", "WEATHER"),
        _clean(spark, sf_dir, "countries", "COUNTRIES"),
    )


@shown(
    f"{CLEANED_VIEWS}, latest AS (SELECT * FROM (SELECT city, timestamp, weather_desc, "
    "temperature_c, wind_speed_kmh, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC, "
    "weather_desc DESC, temperature_c DESC, wind_speed_kmh DESC) AS rn FROM weather) AS r "
    f"WHERE rn = 1), flown AS ({FLIGHT_SQL.format(airlines='airlines')}) "
    "SELECT f.*, w.weather_desc AS weather_condition, w.temperature_c, w.wind_speed_kmh "
    "FROM flown f LEFT JOIN latest w ON f.departure_airport_iata = w.city"
)
def flight_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.flight_weather(
        _clean(spark, sf_dir, "flights", "FLIGHTS"), _clean(spark, sf_dir, "airlines", "AIRLINES"),
        _clean(spark, sf_dir, "weather", "WEATHER"),
    )


@shown(
    "SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_orderstatus AS status, "
    "o.o_orderpriority AS priority, c.c_name AS customer, n.n_name AS nation, r.r_name AS region "
    "FROM lineitem l LEFT JOIN orders o ON l.l_orderkey * 2 = o.o_orderkey "
    "LEFT JOIN customer c ON o.o_custkey = c.c_custkey "
    "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey "
    "LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"
)
def enrich_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five tables; half of the lines have no order."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_quantity", "l_orderkey * 2 AS looked_up"
    )
    steps = (
        ("orders", {"looked_up": "o_orderkey"},
         {"o_orderstatus": "status", "o_orderpriority": "priority", "o_custkey": "custkey"}),
        ("customer", {"custkey": "c_custkey"}, {"c_name": "customer", "c_nationkey": "nationkey"}),
        ("nation", {"nationkey": "n_nationkey"}, {"n_name": "nation", "n_regionkey": "regionkey"}),
        ("region", {"regionkey": "r_regionkey"}, {"r_name": "region"}),
    )
    for name, on, take in steps:
        lines = enrich(lines, table(spark, sf_dir, name), on, take)
    return lines.drop("looked_up", "custkey", "nationkey", "regionkey")


def _silver(spark: SparkSession, sf_dir: str) -> Layers:
    tag = uuid.uuid4().hex
    layers = Layers("", f"silver_{tag}", f"gold_{tag}")
    for name in (layers.silver, layers.gold):
        ensure_namespace(spark, name, work_dir(spark, "tables"))
    return layers


@shown(
    f"{CLEANED_VIEWS}, merged AS ({_outer_sql(AIRLINE_COLUMNS)}) SELECT r.*, '2024-01-0' || CAST(CAST(r.flight_id AS BIGINT) % 3 AS VARCHAR) "
    f"AS ingest_date FROM ({FLIGHT_SQL.format(airlines='merged')}) AS r WHERE CAST(r.flight_id AS BIGINT) % 3 <> 1 "
    "OR CAST(r.flight_id AS BIGINT) % 2 = 0"
)
def marts_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, then a third, a corrected one and renamed airlines; the mart follows by partitions."""
    layers = _silver(spark, sf_dir)
    flights = _clean(spark, sf_dir, "flights", "FLIGHTS")
    number = F.col("flight_id").cast("long")
    flights = flights.withColumn("ingest_date", F.concat(F.lit("2024-01-0"), (number % 3).cast("string")))
    airlines = _clean(spark, sf_dir, "airlines", "AIRLINES")
    for name in ("airports", "countries"):
        publish(_clean(spark, sf_dir, name, name.upper()), layers.silver_table(name))

    def land(rows: DataFrame, day: str) -> None:
        publish(
            rows.where(F.col("ingest_date") == day), layers.silver_table("flights"), mode="replace_slice",
            partition_by=("ingest_date", "status"), within={"ingest_date": day},
        )

    publish(airlines, layers.silver_table("airlines"))
    land(flights, "2024-01-00")
    land(flights, "2024-01-01")
    refresh_gold(spark, layers)
    land(flights, "2024-01-02")
    land(flights.where(number % 2 == 0), "2024-01-01")
    batch = clean(view(spark, sf_dir, "airline_batch"), specs.AIRLINES)
    publish(merge_upsert(spark.table(layers.silver_table("airlines")), batch, "id"), layers.silver_table("airlines"))
    refresh_gold(spark, layers)
    return spark.table(f"{layers.gold}.{specs.GOLD_FLIGHTS}")
