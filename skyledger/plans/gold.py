"""Silver tables to marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import attach_facts, dedupe_latest, enrich

# Columns of the marts, in table order.
FLIGHT_PERFORMANCE = (
    "flight_id", "flight_number", "airline_iata", "airline_name", "aircraft_type",
    "departure_airport_iata", "arrival_airport_iata", "distance_km", "flight_status",
)
AIRPORT_CAPACITY = (
    "airport_id", "airport_name", "country_iso2", "country_name", "continent", "population",
)
CITY_WEATHER = (
    "city_name", "country_iso2", "country_name", "latitude", "longitude", "temperature_c",
    "humidity", "wind_speed_kmh", "weather_desc",
)
READINGS = ("temperature_c", "humidity", "wind_speed_kmh", "weather_desc")


# What cleaning puts where a code or name is missing.
PLACEHOLDERS = ("XX", "XXX", "UNKNOWN", "")


def matched(code: str) -> Column:
    """A code as joins compare it: upper case, no spaces around; placeholders match nothing."""
    key = F.upper(F.trim(F.col(code).cast("string")))
    return F.when(~key.isin(*PLACEHOLDERS), key)


def _keyed(df: DataFrame, code: str) -> DataFrame:
    return df.withColumn("__key", matched(code))


def flight_performance(
    flights: DataFrame, airlines: DataFrame, unique_dim: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Flights with the name of their airline; ``keep`` names further columns of theirs."""
    joined = enrich(
        _keyed(flights.withColumnRenamed("status", "flight_status"), "airline_iata"),
        _keyed(airlines, "iata").where("__key IS NOT NULL"),
        on={"__key": "__key"}, take={"name": "airline_name"}, unique_dim=unique_dim,
    )
    return joined.select(*FLIGHT_PERFORMANCE, *keep)


def flight_weather(
    flights: DataFrame, airlines: DataFrame, weather: DataFrame, city_col: str = "city"
) -> DataFrame:
    """Flight performance with the latest weather at the departure place.

    Weather is cut to one row per place before the join: joining all readings
    of a place to all its flights would pair them all.
    """
    readings = _keyed(weather, city_col).where("__key IS NOT NULL")
    latest = dedupe_latest(
        readings.select("__key", "timestamp", "weather_desc", "temperature_c", "wind_speed_kmh"),
        "__key", "timestamp",
    )
    return enrich(
        _keyed(flight_performance(flights, airlines), "departure_airport_iata"), latest,
        on={"__key": "__key"},
        take={
            "weather_desc": "weather_condition",
            "temperature_c": "temperature_c",
            "wind_speed_kmh": "wind_speed_kmh",
        },
    ).drop("__key")


def airport_capacity(
    airports: DataFrame, countries: DataFrame, unique_dim: bool = False, keep: Sequence[str] = ()
) -> DataFrame:
    """Airports with the name, continent and population of their country; ``keep`` names further columns."""
    own = airports.select("airport_id", "airport_name", "country_iso2", *keep)
    joined = enrich(
        _keyed(own, "country_iso2"), _keyed(countries, "iso2").where("__key IS NOT NULL"),
        on={"__key": "__key"},
        take={"name": "country_name", "continent": "continent", "population": "population"},
        unique_dim=unique_dim,
    )
    return joined.select(*AIRPORT_CAPACITY, *keep)


def city_weather(
    cities: DataFrame, weather: DataFrame, countries: DataFrame, city_key: str = "iata_code",
    weather_key: str = "city",
) -> DataFrame:
    """Cities with their weather readings and country; a city without readings keeps a row.

    Places and codes are compared in upper case; placeholders match nothing.
    """
    joined = attach_facts(
        named_cities(cities, countries, city_key), _keyed(weather, weather_key).where("__key IS NOT NULL"),
        on={"__key": "__key"}, take={c: c for c in READINGS},
    )
    return joined.select(*CITY_WEATHER)


def named_cities(cities: DataFrame, countries: DataFrame, city_key: str) -> DataFrame:
    """Cities with their country's name, and in ``__key`` the code their readings are found by."""
    named = enrich(
        _keyed(cities.select(city_key, "city_name", "country_iso2", "latitude", "longitude"), "country_iso2"),
        _keyed(countries, "iso2").where("__key IS NOT NULL"),
        on={"__key": "__key"}, take={"name": "country_name"},
    )
    return _keyed(named, city_key)
