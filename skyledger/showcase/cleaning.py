"""Cleaning queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import callsign, coded, day_path, first_word, iso_text, time_digits, titled
from ..operators import CleanSpec, clean, standardize_all_strings
from ..plans import specs
from ..sources import with_base_name
from .registry import shown
from .standins import cleaned_sql, initcap_sql, table, titled_sql, view, view_sql, with_sql


def _twice(df: DataFrame) -> DataFrame:
    return df.union(df)


def _twice_sql(name: str) -> str:
    return f"({view_sql(name)} UNION ALL {view_sql(name)}) AS twice"


@shown(cleaned_sql("countries", _twice_sql("supplier_countries")))
def clean_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_twice(view(spark, sf_dir, "supplier_countries")), specs.COUNTRIES)


@shown(cleaned_sql("cities", _twice_sql("cities")))
def clean_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_twice(view(spark, sf_dir, "cities")), specs.CITIES)


@shown(cleaned_sql("weather", _twice_sql("weather")))
def clean_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_twice(view(spark, sf_dir, "weather")), specs.WEATHER)


@shown(cleaned_sql("airlines", _twice_sql("airlines")))
def clean_airlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_twice(view(spark, sf_dir, "airlines")), specs.AIRLINES)


@shown(cleaned_sql("airports", _twice_sql("airports")))
def clean_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_twice(view(spark, sf_dir, "airports")), specs.AIRPORTS)


@shown(cleaned_sql("flights", _twice_sql("flights")))
def clean_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(_twice(view(spark, sf_dir, "flights")), specs.FLIGHTS)


# Many copies of few rows: what is left is one row per kind of line.
LINES = ["' ' || l_returnflag AS flag", "l_linestatus AS state", "l_linenumber AS line"]


@shown(
    "SELECT DISTINCT upper(trim(flag)) AS flag, state, line "
    f"FROM (SELECT {', '.join(LINES)} FROM lineitem) AS lines"
)
def clean_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(*LINES)
    return clean(lines, CleanSpec(upper=("flag",)))


BLANKS = [
    "c_custkey AS id",
    "CASE WHEN c_custkey % 3 = 0 THEN '   ' WHEN c_custkey % 3 = 1 THEN NULL ELSE c_name END AS name",
]


@shown(
    f"SELECT id, {titled_sql('name', 'UNKNOWN')} "
    f"FROM (SELECT {', '.join(BLANKS)} FROM customer) AS blanks"
)
def fill_before_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanks = table(spark, sf_dir, "customer").selectExpr(*BLANKS)
    return clean(blanks, CleanSpec(fill={"name": "UNKNOWN"}, initcap=("name",), dedupe=False))


PARTS = [
    "p_partkey",
    "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE '  ' || upper(p_name) END AS p_name",
    "p_brand", "p_type", "p_size", "p_retailprice",
]


@shown(
    "SELECT p_partkey, "
    + ", ".join(titled_sql(c, "UNKNOWN") for c in ("p_name", "p_brand", "p_type"))
    + f", p_size, p_retailprice FROM (SELECT {', '.join(PARTS)} FROM part) AS parts"
)
def standardize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_all_strings(table(spark, sf_dir, "part").selectExpr(*PARTS))


@shown(
    f"SELECT doc_id, upper(trim(t)) AS coded, {initcap_sql('trim(t)')} AS titled "
    "FROM (SELECT doc_id, replace(text, 'ß', 'ss') AS t FROM documents) AS d"
)
def case_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The sharp s has no single upper-case form; engines differ, so it is spelt out.
    text = F.replace(F.col("text"), F.lit("ß"), F.lit("ss"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", coded(text).alias("coded"), titled(text).alias("titled")
    )


@shown(
    "SELECT p_partkey, substring(upper(replace(p_name, ' ', '')), 1, 8) AS callsign, "
    "split_part(p_name, ' ', 1) AS first_word FROM part"
)
def callsigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey", callsign(name).alias("callsign"), first_word(name).alias("first_word")
    )


@shown(
    "SELECT event_id, strftime(ts, '%Y/%m/%d') AS day_path, strftime(ts, '%H%M%S') AS digits, "
    "CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') "
    "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS iso FROM events"
)
def time_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return table(spark, sf_dir, "events").select(
        "event_id",
        day_path(ts).alias("day_path"),
        time_digits(ts).alias("digits"),
        iso_text(ts).alias("iso"),
    )


@shown("SELECT page_id, regexp_replace(url, '.*/', '') AS file_name FROM pages")
def file_basename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_base_name(table(spark, sf_dir, "pages").select("page_id", "url"), "url").drop("url")


# The cleaned datasets under their own names, for queries that build on them.
CLEANED_VIEWS = with_sql(
    **{f"raw_{n}": view_sql(n) for n in ("airlines", "airline_batch", "flights", "weather",
                                          "cities", "countries", "airports")},
    airlines=cleaned_sql("airlines", "raw_airlines"),
    airline_batch=cleaned_sql("airlines", "raw_airline_batch"),
    flights=cleaned_sql("flights", "raw_flights"),
    weather=cleaned_sql("weather", "raw_weather"),
    cities=cleaned_sql("cities", "raw_cities"),
    countries=cleaned_sql("countries", "raw_countries"),
    airports=cleaned_sql("airports", "raw_airports"),
)
