"""What each dataset's job needs to know."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql.types import StructType

from .. import schemas
from ..operators import CleanSpec, Expectation

# Defaults and cased columns of the six datasets.
COUNTRIES = CleanSpec(
    fill={"name": "UNKNOWN", "iso2": "XX", "capital": "UNKNOWN", "continent": "UNKNOWN"},
    initcap=("name", "capital"),
    upper=("iso2", "continent"),
)
CITIES = CleanSpec(
    fill={"city_name": "UNKNOWN", "country_iso2": "XX", "iata_code": "XXX", "timezone": "UTC"},
    initcap=("city_name",),
    upper=("country_iso2", "iata_code"),
)
WEATHER = CleanSpec(
    fill={"city": "UNKNOWN", "country": "UNKNOWN", "region": "UNKNOWN", "weather_desc": "UNKNOWN"},
    initcap=("city", "region"),
    upper=("country", "weather_desc"),
)
AIRLINES = CleanSpec(
    fill={"name": "UNKNOWN", "country": "UNKNOWN", "iata": "XXX"},
    initcap=("name",),
    upper=("country", "iata"),
)
AIRPORTS = CleanSpec(
    fill={"country_name": "UNKNOWN", "iata_code": "XXX"},
    initcap=("airport_name",),
    upper=("country_name", "iata_code"),
)
FLIGHTS = CleanSpec(fill={"status": "UNKNOWN"}, upper=("flight_number",))

# First id of new master rows and the columns the quality job asks for.
ID_BASE = {"airlines": 1000000, "airports": 2000000, "countries": 3000000, "cities": 4000000}
EXPECTED_COLUMNS = {
    "countries": ("name", "iso2", "capital", "continent", "population2", "id"),
}


def expectations(
    dataset: str, schema: StructType, expected: Mapping[str, Sequence[str]] = EXPECTED_COLUMNS
) -> list[Expectation]:
    """The dataset's own list, else all columns of its layout."""
    return [Expectation(c) for c in expected.get(dataset, schema.fieldNames())]


@dataclass(frozen=True)
class Dataset:
    """A raw dataset and the silver table it goes to. ``daily`` ones are facts."""

    name: str
    fmt: str
    schema: StructType
    spec: CleanSpec
    table: str
    daily: bool = False
    partition_by: tuple[str, ...] = ()


# Folder names, formats and table names.
DATASETS = {
    d.name: d
    for d in (
        Dataset("countries", "csv", schemas.COUNTRIES, COUNTRIES, "countries_data"),
        Dataset("cities", "csv", schemas.CITIES, CITIES, "cities_data"),
        Dataset("airlines", "json", schemas.AIRLINES, AIRLINES, "airline_data"),
        Dataset("airports", "json", schemas.AIRPORTS, AIRPORTS, "airport_data"),
        Dataset("weather", "csv", schemas.WEATHER, WEATHER, "weather_data", True),
        Dataset("flights", "json", schemas.FLIGHTS, FLIGHTS, "flight_data", True, ("status",)),
    )
}
DAILY_FOLDER = {"weather": "weather_data", "flights": "flight_data"}
GOLD_FLIGHTS = "flight_performance_summary_v1"
GOLD_AIRPORTS = "airport_capacity_analysis_v1"
GOLD_CITIES = "city_weather_analysis_v1"
IMAGE_TEXT_TABLE = "image_metadata_with_text"
IMAGE_FLIGHTS_TABLE = "flight_table_ocr_json"
