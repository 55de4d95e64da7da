"""Master-data queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import assign_ids, available_codes, code_pool, new_members
from ..plans import masterdata
from .registry import shown
from .standins import table, view, view_sql, with_sql

STAMP = "2024-03-01T00:00:00"
NAMED = ["'C' || CAST(c_custkey * 3 AS STRING) AS iso2", "CAST(c_custkey AS STRING) AS id"]
SEEN = ["CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'C' || CAST(user_id AS STRING) END AS country"]
FOUND = with_sql(
    master=f"SELECT {', '.join(NAMED)} FROM customer",
    feed=f"SELECT {', '.join(SEEN)} FROM events",
    found="SELECT DISTINCT country FROM feed WHERE country IS NOT NULL "
    "AND country NOT IN (SELECT iso2 FROM master)",
)


@shown(f"{FOUND} SELECT country FROM found")
def new_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "events").selectExpr(*SEEN)
    return new_members(feed, table(spark, sf_dir, "customer").selectExpr(*NAMED), "country", "iso2")


@shown(
    f"{FOUND} SELECT CAST(3000000 + row_number() OVER (ORDER BY country) - 1 AS VARCHAR) AS id, "
    "country AS name, upper(substring(country, 1, 2)) AS iso2, 'Capital ' || country AS capital, "
    f"'EU' AS continent, CAST(NULL AS VARCHAR) AS population, '{STAMP}' AS created_at, "
    f"'{STAMP}' AS updated_at FROM found"
)
def discover_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = table(spark, sf_dir, "events").selectExpr(*SEEN)
    master = table(spark, sf_dir, "customer").selectExpr(*NAMED)
    return masterdata.discover_countries(feed, master, STAMP, continent="EU")


LETTERS = "chr(CAST(65 + {n} // {d} % 26 AS INTEGER))"


def _code_sql(n: str, length: int) -> str:
    return " || ".join(LETTERS.format(n=n, d=26**k) for k in reversed(range(length)))


# Every customer and supplier holds the code of its doubled or tripled number.
USED_SQL = f"SELECT {_code_sql('(c_custkey * 2)', 4)} AS iata, CAST(c_custkey AS VARCHAR) AS id FROM customer"


def _used(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = " || ".join(
        f"char(CAST(65 + floor(c_custkey * 2 / {26**k}) % 26 AS INT))" for k in reversed(range(4))
    )
    return table(spark, sf_dir, "customer").selectExpr(
        f"{letters} AS iata", "CAST(c_custkey AS STRING) AS id"
    )


POOL_SQL = f"SELECT {_code_sql('n', 4)} AS code FROM range(456976) AS numbers(n)"


@shown(
    with_sql(used=USED_SQL, pool=POOL_SQL)
    + " SELECT code FROM pool WHERE code NOT IN (SELECT iata FROM used)"
)
def free_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available_codes(code_pool(spark, 4), _used(spark, sf_dir), "iata")


# Four letters, or five where the four do not suffice.
FITTING_SQL = (
    "SELECT code FROM pool4 WHERE (SELECT l FROM need) = 4 "
    f"UNION ALL SELECT {_code_sql('n', 5)} FROM range(11881376) AS numbers(n) WHERE (SELECT l FROM need) = 5"
)
NEED_SQL = (
    "SELECT CASE WHEN 456976 - (SELECT count(DISTINCT iata) FROM used) >= (SELECT count(*) FROM supplier) THEN 4 ELSE 5 END AS l"
)


@shown(
    with_sql(
        used=USED_SQL, pool4=POOL_SQL, need=NEED_SQL, pool=FITTING_SQL,
        free="SELECT code, row_number() OVER (ORDER BY code) - 1 AS place FROM pool "
        "WHERE code NOT IN (SELECT iata FROM used)",
        candidates="SELECT s_name AS name, row_number() OVER (ORDER BY s_name) - 1 AS place FROM supplier",
    )
    + " SELECT CAST(1000000 + c.place AS VARCHAR) AS id, c.name, f.code AS iata, "
    f"'{STAMP}' AS created_at, '{STAMP}' AS updated_at "
    "FROM candidates c JOIN free f ON c.place = f.place"
)
def add_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    candidates = table(spark, sf_dir, "supplier").selectExpr("s_name AS name")
    return masterdata.add_members(
        _used(spark, sf_dir), candidates, "airlines", {"iata": 4}, "name", STAMP, longer=True
    )


@shown(
    "SELECT CAST(500 + row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS VARCHAR) "
    "AS id, o_orderkey, o_totalprice FROM orders"
)
def assign_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return assign_ids(
        orders, [orders["o_totalprice"].desc(), orders["o_orderkey"]], base=400, start=100
    )


@shown(
    f"{with_sql(airports=view_sql('airports'))} SELECT a.id, a.airport_id, a.iata_code, a.icao_code, "
    "CASE WHEN s.s_suppkey IS NULL THEN a.country_iso2 ELSE CAST(s.s_nationkey AS VARCHAR) END "
    "AS country_iso2, a.country_name, "
    "CASE WHEN s.s_suppkey IS NULL THEN a.airport_name ELSE 'Updated ' || a.airport_name END "
    f"AS airport_name, CASE WHEN s.s_suppkey IS NULL THEN '' ELSE '{STAMP}' END AS updated_at "
    "FROM airports a LEFT JOIN supplier s ON a.id = CAST(s.s_suppkey AS VARCHAR)"
)
def update_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    airports = view(spark, sf_dir, "airports").selectExpr("*", "'' AS updated_at")
    changes = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "CAST(s_nationkey AS STRING) AS country_iso2"
    )
    return masterdata.update_airports(airports, changes, STAMP)


@shown(
    f"{with_sql(countries=view_sql('supplier_countries'))} SELECT s.id, s.name, s.iso2, "
    "CASE WHEN c.c_custkey IS NULL THEN s.capital ELSE 'New ' || s.capital END AS capital, "
    "s.continent, CASE WHEN c.c_custkey IS NULL THEN s.population "
    "ELSE CAST(c.c_custkey * 1000 AS VARCHAR) END AS population, "
    f"CASE WHEN c.c_custkey IS NULL THEN '' ELSE '{STAMP}' END AS updated_at "
    "FROM countries s LEFT JOIN customer c ON s.id = CAST(c.c_custkey * 3 AS VARCHAR)"
)
def update_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    countries = view(spark, sf_dir, "supplier_countries").selectExpr("*", "'' AS updated_at")
    changes = table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey * 3 AS STRING) AS id", "c_custkey * 1000 AS population"
    )
    return masterdata.update_countries(countries, changes, STAMP)


@shown(
    f"{with_sql(cities=view_sql('cities'))} SELECT i.id, i.iata_code, i.city_name, i.country_iso2, "
    "CASE WHEN o.o_orderkey IS NULL THEN i.latitude ELSE round(o.o_totalprice / 7, 6) END AS latitude, "
    "CASE WHEN o.o_orderkey IS NULL THEN CAST(i.longitude AS DOUBLE) "
    "ELSE round(o.o_totalprice / 9, 6) END AS longitude, "
    "CASE WHEN o.o_orderkey IS NULL THEN i.timezone ELSE 'UTC-5' END AS timezone, "
    f"CASE WHEN o.o_orderkey IS NULL THEN '' ELSE '{STAMP}' END AS updated_at "
    "FROM cities i LEFT JOIN orders o ON i.id = CAST(o.o_orderkey * 2 AS VARCHAR)"
)
def update_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = view(spark, sf_dir, "cities").selectExpr("*", "'' AS updated_at")
    cities = cities.withColumn("longitude", cities["longitude"].cast("double"))
    changes = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey * 2 AS id", "'UTC-5' AS timezone", "o_totalprice / 7 AS latitude",
        "o_totalprice / 9 AS longitude",
    )
    return masterdata.update_cities(cities, changes, STAMP)
