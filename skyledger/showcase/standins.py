"""The domain's datasets as views of the given tables.

Each view is a source table and a list of expressions that Spark and ANSI SQL
read alike. Nulls, blanks and stray spaces are put in by key arithmetic; every
view keeps all rows of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, tuple[str, list[str]]] = {
    "airlines": (
        "customer",
        [
            "CAST(c_custkey AS STRING) AS id",
            "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE '  ' || lower(c_name) || ' ltd ' END AS name",
            "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE ' c' || CAST(c_custkey AS STRING) END AS iata",
            "'I' || CAST(c_custkey AS STRING) AS icao",
            "upper(c_mktsegment) AS callsign",
            "CAST(c_nationkey AS STRING) AS country_code",
            "CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE lower(c_mktsegment) END AS country",
            "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE 'H' || CAST(c_nationkey AS STRING) END AS hub",
            "'active' AS status",
            "'2024-01-01T00:00:00' AS created_at",
            "'2024-01-01T00:00:00' AS updated_at",
        ],
    ),
    # The same customers under doubled ids: every second one meets a target row.
    "airline_batch": (
        "customer",
        [
            "CAST(c_custkey * 2 AS STRING) AS id",
            "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lower(c_name) || ' new' END AS name",
            "'n' || CAST(c_custkey AS STRING) AS iata",
            "CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE 'J' || CAST(c_custkey AS STRING) END AS icao",
            "CAST(NULL AS STRING) AS callsign",
            "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_nationkey AS STRING) END AS country_code",
            "lower(c_mktsegment) AS country",
            "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'K' || CAST(c_nationkey AS STRING) END AS hub",
            "'inactive' AS status",
            "CAST(NULL AS STRING) AS created_at",
            "'2024-02-01T00:00:00' AS updated_at",
        ],
    ),
    # Many rows per id, and rows without an id.
    "airline_changes": (
        "orders",
        [
            "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_custkey * 2 AS STRING) END AS id",
            "CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS name",
            "CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 'O' || CAST(o_orderkey AS STRING) END AS iata",
            "o_orderstatus AS status",
            "o_orderkey AS seq",
        ],
    ),
    "airports": (
        "customer",
        [
            "CAST(c_custkey AS STRING) AS id",
            "CAST(c_custkey + 1 AS STRING) AS airport_id",
            "CASE WHEN c_custkey % 8 = 0 THEN NULL ELSE ' a' || CAST(c_custkey AS STRING) END AS iata_code",
            "'K' || CAST(c_custkey AS STRING) AS icao_code",
            "CASE WHEN c_custkey % 9 = 0 THEN 'XX' ELSE CAST(c_nationkey AS STRING) END AS country_iso2",
            "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE lower(c_mktsegment) || ' ' END AS country_name",
            "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE upper(c_name) || ' INTL ' END AS airport_name",
        ],
    ),
    "countries": (
        "nation",
        [
            "CAST(n_nationkey AS STRING) AS id",
            "' ' || lower(n_name) AS name",
            "CASE WHEN n_nationkey % 8 = 3 THEN NULL ELSE CAST(n_nationkey AS STRING) END AS iso2",
            "CASE WHEN n_nationkey % 4 = 0 THEN NULL ELSE 'town ' || lower(n_name) END AS capital",
            "CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE 'r' || CAST(n_regionkey AS STRING) END AS continent",
            "CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE CAST(n_nationkey * 1000 AS STRING) END AS population",
        ],
    ),
    "supplier_countries": (
        "supplier",
        [
            "CAST(s_suppkey AS STRING) AS id",
            "CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE '  ' || upper(s_name) || ' isles' END AS name",
            "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE ' s' || CAST(s_nationkey AS STRING) || ' ' END AS iso2",
            "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'port ' || lower(s_name) END AS capital",
            "CASE WHEN s_suppkey % 4 = 0 THEN '  ' ELSE 'eu' END AS continent",
            "CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE CAST(s_suppkey * 100 AS STRING) END AS population",
        ],
    ),
    "cities": (
        "part",
        [
            "CAST(p_partkey AS STRING) AS id",
            "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE ' u' || CAST(p_partkey AS STRING) END AS iata_code",
            "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE upper(p_name) END AS city_name",
            "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size % 25 AS STRING) END AS country_iso2",
            "p_retailprice AS latitude",
            "p_size AS longitude",
            "CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE 'UTC+1' END AS timezone",
        ],
    ),
    "weather": (
        "events",
        [
            "CASE WHEN event_id % 9 = 0 THEN NULL ELSE 'U' || CAST(user_id AS STRING) || ' ' END AS city",
            "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'c' || CAST(user_id AS STRING) END AS country",
            "CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN '' ELSE 'EAST side' END AS region",
            "value AS temperature_c",
            "CAST(event_id % 100 AS DOUBLE) AS humidity",
            "value * 2 AS wind_speed_kmh",
            "CASE WHEN event_id % 5 = 0 THEN NULL ELSE ' ' || event_type END AS weather_desc",
            "CAST(ts AS STRING) AS timestamp",
        ],
    ),
    "flights": (
        "orders",
        [
            "CAST(o_orderkey AS STRING) AS flight_id",
            "' ' || lower(o_orderpriority) || ' ' AS flight_number",
            "CASE WHEN o_orderkey % 10 = 0 THEN 'XXX' ELSE 'C' || CAST(o_custkey AS STRING) END AS airline_iata",
            "'U' || CAST(o_custkey AS STRING) AS departure_airport_iata",
            "'A' || CAST(o_custkey AS STRING) AS arrival_airport_iata",
            "o_orderpriority AS aircraft_type",
            "o_totalprice AS distance_km",
            "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS status",
        ],
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = VIEWS[name]
    return table(spark, sf_dir, source).selectExpr(*columns)


def view_sql(name: str) -> str:
    source, columns = VIEWS[name]
    return f"SELECT {', '.join(columns)} FROM {source}"


def initcap_sql(text: str) -> str:
    """Capitalised words in SQL without an ``initcap`` function."""
    parts = f"list_transform(string_split(lower({text}), ' '), lambda w: upper(w[1]) || w[2:])"
    return f"array_to_string({parts}, ' ')"


def titled_sql(column: str, default: str | None = None) -> str:
    value = f"coalesce({column}, '{default}')" if default is not None else column
    # A null text has no words; keep it null.
    return f"CASE WHEN {value} IS NULL THEN NULL ELSE {initcap_sql(f'trim({value})')} END AS {column}"


def coded_sql(column: str, default: str | None = None) -> str:
    value = f"coalesce({column}, '{default}')" if default is not None else column
    return f"upper(trim({value})) AS {column}"


def filled_sql(column: str, default: str) -> str:
    return f"coalesce({column}, '{default}') AS {column}"


# The cleaned datasets, written out column by column.
CLEANED = {
    "airlines": ", ".join(
        ["id", titled_sql("name", "UNKNOWN"), coded_sql("iata", "XXX"), "icao", "callsign",
         "country_code", coded_sql("country", "UNKNOWN"), "hub", "status", "created_at",
         "updated_at"]
    ),
    "airports": ", ".join(
        ["id", "airport_id", coded_sql("iata_code", "XXX"), "icao_code", "country_iso2",
         coded_sql("country_name", "UNKNOWN"), titled_sql("airport_name")]
    ),
    "countries": ", ".join(
        ["id", titled_sql("name", "UNKNOWN"), coded_sql("iso2", "XX"),
         titled_sql("capital", "UNKNOWN"), coded_sql("continent", "UNKNOWN"), "population"]
    ),
    "cities": ", ".join(
        ["id", coded_sql("iata_code", "XXX"), titled_sql("city_name", "UNKNOWN"),
         coded_sql("country_iso2", "XX"), "latitude", "longitude", filled_sql("timezone", "UTC")]
    ),
    "weather": ", ".join(
        [titled_sql("city", "UNKNOWN"), coded_sql("country", "UNKNOWN"),
         titled_sql("region", "UNKNOWN"), "temperature_c", "humidity", "wind_speed_kmh",
         coded_sql("weather_desc", "UNKNOWN"), "timestamp"]
    ),
    "flights": ", ".join(
        ["flight_id", coded_sql("flight_number"), "airline_iata", "departure_airport_iata",
         "arrival_airport_iata", "aircraft_type", "distance_km", filled_sql("status", "UNKNOWN")]
    ),
}


def cleaned_sql(dataset: str, source: str) -> str:
    """``source`` (a table name or a query in brackets) cleaned as ``dataset``."""
    return f"SELECT DISTINCT {CLEANED[dataset]} FROM {source}"


def with_sql(**parts: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({query})" for name, query in parts.items())
