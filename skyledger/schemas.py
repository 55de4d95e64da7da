"""Column layouts of the raw datasets."""

from __future__ import annotations

from pyspark.sql import types as T


def _text(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column names of the raw files, in file order.
COUNTRIES = _text(
    "id", "name", "iso2", "capital", "continent", "population", "created_at", "updated_at",
)
CITIES = _text(
    "id", "iata_code", "city_name", "country_iso2", "latitude", "longitude", "timezone",
    "created_at", "updated_at",
)
WEATHER = _text(
    "city", "country", "region", "temperature_c", "humidity", "wind_speed_kmh", "weather_desc",
    "timestamp", "created_at", "updated_at",
)
AIRLINES = _text(
    "id", "name", "iata", "icao", "callsign", "country_code", "country", "hub", "status",
    "created_at", "updated_at",
)
AIRPORTS = _text(
    "id", "airport_id", "iata_code", "icao_code", "country_iso2", "country_name", "airport_name",
    "created_at", "updated_at",
)
FLIGHTS = T.StructType(
    [
        T.StructField("flight_id", T.StringType()),
        T.StructField("flight_number", T.StringType()),
        T.StructField("airline_iata", T.StringType()),
        T.StructField("departure_airport_iata", T.StringType()),
        T.StructField("arrival_airport_iata", T.StringType()),
        T.StructField("aircraft_type", T.StringType()),
        T.StructField("distance_km", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
# Fields of one parsed flight line, in line order.
FLIGHT_LINE = ("Flight", "Airline", "From", "To", "Aircraft", "Distance", "Status")
