"""Marts brought up to date by change: only the partitions that a change touches are written.

A mart is partitioned like the rows that drive it. Beside it lie a fingerprint
of each driving partition and the looked-up columns of its dimensions, as the
mart last saw them. A partition is built again if its fingerprint differs, or if
it holds a key whose dimension rows differ; the others are not read. State is
stored after the mart, so a refresh that was stopped is simply done again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich
from ..session import pin
from ..sinks import ensure_namespace, publish, recover
from ..sources import read_files, read_or_empty, table_exists
from . import gold
from .gold import matched
from .silver import Layers
from .specs import GOLD_AIRPORTS, GOLD_CITIES, GOLD_FLIGHTS

#: Marts of dimensions have this many partitions, by a hash of the id.
DIMENSION_PARTS = 64
#: The partition of rows that belong to no driving one.
ALONE = "none"


@dataclass(frozen=True)
class Lookup:
    """What a mart takes from a dimension: ``rows`` with just the columns used, and how a driving row names its key."""

    rows: DataFrame
    key: Column
    driving_key: Column


@dataclass(frozen=True)
class Mart:
    """How one mart is made.

    ``driving`` has the partition column ``part``; ``prints`` gives ``part`` and
    ``fingerprint`` of each of its partitions. ``build`` makes the rows of some
    partitions from driving rows and the dimensions' rows; ``alone`` makes the
    rows of partition ``ALONE``, if there are such, at each refresh.
    """

    table: str
    part: str
    driving: DataFrame
    prints: DataFrame
    lookups: Sequence[Lookup]
    build: Callable[[DataFrame, Sequence[DataFrame]], DataFrame]
    alone: Callable[[Sequence[DataFrame]], DataFrame] | None = None


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'")
    return described.first()["data_type"]


def file_prints(spark: SparkSession, table: str, part: str) -> DataFrame:
    """A fingerprint of each partition from names, sizes and times of its files; no file is opened."""
    listing = read_or_empty(
        spark, lambda: read_files(spark, table_location(spark, table), "*.parquet").select("path", "modificationTime", "length"),
        spark.createDataFrame([], "path string, modificationTime timestamp, length long").schema,
    )
    value = F.url_decode(F.regexp_extract("path", f"/{part}=([^/]*)/", 1))
    return listing.groupBy(value.alias("part")).agg(
        _print(F.xxhash64("path", "modificationTime", "length")).alias("fingerprint")
    )


def content_prints(driving: DataFrame, part: str) -> DataFrame:
    """A fingerprint of each partition from its rows, for small tables that are written as a whole."""
    columns = [F.to_json(F.struct(F.struct(*[F.col(f"`{c}`") for c in driving.columns]).alias("r")))]
    return driving.groupBy(F.col(part).cast("string").alias("part")).agg(_print(F.xxhash64(*columns)).alias("fingerprint"))


def _print(digest: Column) -> Column:
    return F.concat_ws(" ", F.count("*"), F.bit_xor(digest), F.bit_xor(F.xxhash64(digest)), F.sum(digest % 1_000_003))


def _differing(now: DataFrame, before: DataFrame, key: Column) -> DataFrame:
    """Keys of rows that only one of both has."""
    parts = [a.exceptAll(b).select(key.alias("key")) for a, b in ((now, before), (before, now))]
    return parts[0].union(parts[1]).where("key IS NOT NULL").distinct()


def refresh(spark: SparkSession, mart: Mart) -> list[str] | None:
    """Bring a mart up to date. The partitions written, or None if all were."""
    seen, held = f"{mart.table}__prints", [f"{mart.table}__seen{k}" for k in range(len(mart.lookups))]
    for table in (mart.table, seen, *held):
        recover(spark, table)
    # What is compared, used and stored is the same, whatever is loaded meanwhile.
    prints, rows = pin(mart.prints), [pin(x.rows) for x in mart.lookups]
    known = all(table_exists(spark, t) for t in (mart.table, seen, *held))
    touched: set[str] = set()
    if not known:
        everything = _with_alone(mart, mart.driving, rows)
        publish(everything, mart.table, partition_by=[mart.part])
    else:
        old = spark.table(seen).withColumnRenamed("fingerprint", "old")
        both = prints.join(old, "part", "full_outer")
        touched = {r["part"] for r in both.where(~F.col("fingerprint").eqNullSafe(F.col("old"))).select("part").collect()}
        for lookup, now, table in zip(mart.lookups, rows, held, strict=True):
            keys = _differing(now, spark.table(table).select(*now.columns), lookup.key)
            places = mart.driving.select(F.col(mart.part).cast("string").alias("part"), lookup.driving_key.alias("key"))
            touched |= {r["part"] for r in places.join(keys, "key", "left_semi").select("part").distinct().collect()}
        _write_parts(spark, mart, rows, touched)
    for state, table in ((prints, seen), *zip(rows, held, strict=True)):
        publish(state, table)
    return sorted(touched) if known else None


def _with_alone(mart: Mart, driving: DataFrame, rows: Sequence[DataFrame]) -> DataFrame:
    built = mart.build(driving, rows)
    return built if mart.alone is None else built.unionByName(mart.alone(rows))


def _write_parts(spark: SparkSession, mart: Mart, rows: Sequence[DataFrame], touched: set[str]) -> None:
    parts = {p for p in touched if p is not None}
    if not parts and mart.alone is None:
        return
    chosen = mart.driving.where(F.col(mart.part).cast("string").isin(*sorted(parts)))
    built = pin(_with_alone(mart, chosen, rows))
    publish(built, mart.table, mode="overwrite_partitions", partition_by=[mart.part])
    written = {r[0] for r in built.select(F.col(mart.part).cast("string")).distinct().collect()}
    gone = parts | ({ALONE} if mart.alone is not None else set())
    for part in sorted(gone - written):
        text = part.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {mart.table} DROP IF EXISTS PARTITION (`{mart.part}` = '{text}')")


def flights_mart(spark: SparkSession, layers: Layers) -> Mart:
    """Flights by their day, with their airline's name."""
    table = layers.silver_table("flights")
    airlines = spark.table(layers.silver_table("airlines")).select("iata", "name")
    return Mart(
        f"{layers.gold}.{GOLD_FLIGHTS}", "ingest_date", spark.table(table), file_prints(spark, table, "ingest_date"),
        [Lookup(airlines, matched("iata"), matched("airline_iata"))],
        lambda flights, dims: gold.flight_performance(flights, dims[0], keep=("ingest_date",)),
    )


def airports_mart(spark: SparkSession, layers: Layers) -> Mart:
    """Airports in partitions by a hash of their id, with their country."""
    part = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(DIMENSION_PARTS)).cast("string")
    airports = spark.table(layers.silver_table("airports")).withColumn("id_part", part)
    countries = spark.table(layers.silver_table("countries")).select("iso2", "name", "continent", "population")
    return Mart(
        f"{layers.gold}.{GOLD_AIRPORTS}", "id_part", airports, content_prints(airports, "id_part"),
        [Lookup(countries, matched("iso2"), matched("country_iso2"))],
        lambda rows, dims: gold.airport_capacity(rows, dims[0], keep=("id_part",)),
    )


def cities_mart(spark: SparkSession, layers: Layers) -> Mart:
    """Weather readings by their day with their city and country; cities without any are in a partition of their own."""
    table = layers.silver_table("weather")
    weather = spark.table(table)
    cities = gold.named_cities(spark.table(layers.silver_table("cities")), spark.table(layers.silver_table("countries")), "iata_code")
    columns = gold.CITY_WEATHER

    def build(readings: DataFrame, dims: Sequence[DataFrame]) -> DataFrame:
        keyed = readings.withColumn("__key", matched("city")).where("__key IS NOT NULL")
        found = dims[0].where("__key IS NOT NULL").withColumn("__met", F.lit(True))
        joined = enrich(
            keyed.select("__key", "ingest_date", *gold.READINGS), found, on={"__key": "__key"},
            take={c: c for c in ("city_name", "country_iso2", "country_name", "latitude", "longitude", "__met")},
        )
        return joined.where("__met").select(*columns, "ingest_date")

    def alone(dims: Sequence[DataFrame]) -> DataFrame:
        there = weather.select(matched("city").alias("__key")).where("__key IS NOT NULL").distinct()
        lone = dims[0].join(there, "__key", "left_anti")
        kinds = weather.schema
        empty = {c: F.lit(None).cast(kinds[c].dataType) for c in gold.READINGS}
        return lone.withColumns(empty).select(*columns, F.lit(ALONE).alias("ingest_date"))

    return Mart(
        f"{layers.gold}.{GOLD_CITIES}", "ingest_date", weather, file_prints(spark, table, "ingest_date"),
        [Lookup(cities, F.col("__key"), matched("city"))], build, alone,
    )


def refresh_gold(spark: SparkSession, layers: Layers, with_weather: bool = False) -> dict[str, list[str] | None]:
    """Bring the marts up to date; for each its partitions written, None where all were.

    The marts have the columns of ``load_gold``'s and one more, their partition.
    """
    ensure_namespace(spark, layers.gold)
    makers = [flights_mart, airports_mart, *([cities_mart] if with_weather else [])]
    marts = [make(spark, layers) for make in makers]
    return {m.table: refresh(spark, m) for m in marts}
