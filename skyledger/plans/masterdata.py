"""Additions to and changes of the master files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import (
    apply_updates, assign_ids, merge_upsert, new_members,
)
from ..operators.members import code_length, number_rows, with_free_codes
from ..sinks import publish
from ..sources import read_csv, read_latest
from .gold import PLACEHOLDERS
from .silver import Layers
from .specs import DAILY_FOLDER, ID_BASE


# What generated names begin with.
CAPITAL_OF, UPDATED, NEW = "Capital ", "Updated ", "New "


def next_start(master: DataFrame, base: int, id_col: str = "id") -> int:
    """How far ids above ``base`` are used: the first free offset."""
    top = master.agg(F.max(F.col(id_col).cast("long"))).first()[0]
    return 0 if top is None else max(0, top - base + 1)


def discover_countries(
    weather: DataFrame, countries: DataFrame, stamp: str | Column,
    weather_col: str = "country", master_col: str = "iso2", start: int | None = None,
    continent: str | None = None, population: str | None = None,
) -> DataFrame:
    """Master rows for countries the weather feed names and the master lacks.

    The default compares the feed's names with the master's codes; pass
    ``master_col="name"`` when the feed holds full names.
    """
    base = ID_BASE["countries"]
    found = new_members(weather, countries, weather_col, master_col)
    first = next_start(countries, base) if start is None else start
    name = F.col(weather_col)
    when = stamp if isinstance(stamp, Column) else F.lit(stamp)
    return assign_ids(found, weather_col, base, first).select(
        "id",
        name.alias("name"),
        F.upper(F.substring(name, 1, 2)).alias("iso2"),
        F.concat(F.lit(CAPITAL_OF), name).alias("capital"),
        F.lit(continent).cast("string").alias("continent"),
        F.lit(population).cast("string").alias("population"),
        when.alias("created_at"),
        when.alias("updated_at"),
    )


def store_members(spark: SparkSession, layers: Layers, dimension: str, rows: DataFrame) -> None:
    """Merge new or changed rows into the dimension's silver table."""
    table = layers.silver_table(dimension)
    publish(merge_upsert(spark.table(table), rows, "id"), table)


def add_countries_from_weather(
    spark: SparkSession, layers: Layers, stamp: str | Column, master_col: str = "iso2",
    run_date: date | None = None,
) -> bool:
    """Add the countries of the newest weather file; whether there was such a file.

    ``run_date`` lists that day's folder only, instead of every day's.
    """
    folder = DAILY_FOLDER["weather"]
    day = f"{run_date:%Y/%m/%d}" if run_date else "*/*/*"
    weather = read_latest(spark, f"{layers.root}/{day}/csv/{folder}", folder, read_csv)
    if weather is None:
        return False
    countries = spark.table(layers.silver_table("countries"))
    found = discover_countries(weather, countries, stamp, master_col=master_col)
    store_members(spark, layers, "countries", found)
    return True


def add_members(
    master: DataFrame, candidates: DataFrame, dimension: str, codes: dict[str, int],
    order_by: str, stamp: str | Column, start: int | None = None, longer: bool = False,
    reserved: Sequence[str] = (),
) -> DataFrame:
    """New rows of a dimension: the candidates with ids, free codes and time stamps.

    ``codes`` maps a code column to its length; the n-th candidate gets the
    n-th code that no master row uses and ``reserved`` does not name. Running
    out of codes makes the query fail; with ``longer`` all new codes are as long
    as the number of candidates needs.
    """
    base = ID_BASE[dimension]
    first = next_start(master, base) if start is None else start
    when = stamp if isinstance(stamp, Column) else F.lit(stamp)
    rows = number_rows(candidates, order_by, "__place")
    for col, length in codes.items():
        held = F.explode(F.array(*map(F.lit, reserved))) if reserved else F.lit(None).cast("string")
        used = master.select(col).union(master.sparkSession.range(1).select(held))
        if longer:
            length = code_length(used, col, length, rows.count())
        rows = with_free_codes(rows, "__place", used, col, length)
    new_id = (F.col("__place") + F.lit(base + first)).cast("string")
    stamped = rows.withColumns({"id": new_id, "created_at": when, "updated_at": when})
    return stamped.drop("__place")


def store_airlines(spark: SparkSession, layers: Layers, names: DataFrame, stamp: str | Column) -> None:
    """Add airlines, by ``name``, to their silver table with free two- and three-letter codes, longer if these run out."""
    master = spark.table(layers.silver_table("airlines"))
    rows = add_members(master, names, "airlines", {"iata": 2, "icao": 3}, "name", stamp, longer=True, reserved=PLACEHOLDERS)
    store_members(spark, layers, "airlines", rows)


def store_airports(spark: SparkSession, layers: Layers, airports: DataFrame, stamp: str | Column) -> None:
    """Add airports, by ``airport_name``, to their silver table with free three- and four-letter codes."""
    master = spark.table(layers.silver_table("airports"))
    codes = {"iata_code": 3, "icao_code": 4}
    rows = add_members(master, airports, "airports", codes, "airport_name", stamp, longer=True, reserved=PLACEHOLDERS)
    store_members(spark, layers, "airports", rows)


def store_cities(spark: SparkSession, layers: Layers, cities: DataFrame, stamp: str | Column) -> None:
    """Add cities, by ``city_name``, to their silver table with free three-letter codes."""
    master = spark.table(layers.silver_table("cities"))
    rows = add_members(master, cities, "cities", {"iata_code": 3}, "city_name", stamp, longer=True, reserved=PLACEHOLDERS)
    store_members(spark, layers, "cities", rows)


def update_airlines(airlines: DataFrame, changes: DataFrame, stamp: str | Column) -> DataFrame:
    """``changes``: id with new status and hub."""
    return apply_updates(airlines, changes.select("id", "status", "hub"), "id", "updated_at", stamp)


def update_airports(airports: DataFrame, changes: DataFrame, stamp: str | Column) -> DataFrame:
    """``changes``: id with a new country_iso2; the airport's name is marked as updated."""
    marked = F.concat(F.lit(UPDATED), F.col("airport_name"))
    return apply_updates(
        airports, changes.select("id", "country_iso2"), "id", "updated_at", stamp,
        derive={"airport_name": marked},
    )


def update_countries(countries: DataFrame, changes: DataFrame, stamp: str | Column) -> DataFrame:
    """``changes``: id with a new population; the capital's name is marked as new."""
    marked = F.concat(F.lit(NEW), F.col("capital"))
    return apply_updates(
        countries, changes.select("id", "population"), "id", "updated_at", stamp,
        derive={"capital": marked},
    )


def update_cities(cities: DataFrame, changes: DataFrame, stamp: str | Column) -> DataFrame:
    """``changes``: id with new timezone, latitude and longitude (kept to six digits)."""
    rounded = changes.select(
        "id",
        "timezone",
        *[F.round(F.col(c).cast("double"), 6).alias(c) for c in ("latitude", "longitude")],
    )
    return apply_updates(cities, rounded, "id", "updated_at", stamp)
