from datetime import datetime, timezone

from helpers import rows

from skyledger.functions import (
    callsign, day_path, first_word, iso_text, stripped, time_digits, utc_iso_now, words,
)
from skyledger.operators import CleanSpec, clean, clean_rows, standardize_all_strings
from skyledger.plans import specs
from pyspark.sql import functions as F


def test_countries(spark):
    one = ("1", " united STATES ", "us ", "washington", "na", "331")
    df = spark.createDataFrame(
        [
            one, one,
            ("2", None, None, None, None, None),
            ("3", "   ", "  ", "", "eu", "5"),
            ("4", "GUINEA-BISSAU", "gw", "são tomé", "af", "9"),
        ],
        "id string, name string, iso2 string, capital string, continent string, population string",
    )
    assert rows(clean(df, specs.COUNTRIES)) == [
        ("1", "United States", "US", "Washington", "NA", "331"),
        ("2", "Unknown", "XX", "Unknown", "UNKNOWN", None),
        ("3", "", "", "", "EU", "5"),
        ("4", "Guinea-bissau", "GW", "São Tomé", "AF", "9"),
    ]


def test_airports_keep_a_missing_name(spark):
    df = spark.createDataFrame(
        [("1", " heathrow INTL ", None, None), ("2", None, "uk", "lhr")],
        "id string, airport_name string, country_name string, iata_code string",
    )
    assert rows(clean(df, specs.AIRPORTS)) == [
        ("1", "Heathrow Intl", "UNKNOWN", "XXX"), ("2", None, "UK", "LHR"),
    ]


def test_weather_blank_region_is_not_a_missing_one(spark):
    df = spark.createDataFrame(
        [
            ("new york", "usa", None, "light rain"), ("new york ", "USA", None, "LIGHT RAIN"),
            ("new york", "usa", "", "light rain"),
        ],
        "city string, country string, region string, weather_desc string",
    )
    assert rows(clean(df, specs.WEATHER)) == [
        ("New York", "USA", "", "LIGHT RAIN"), ("New York", "USA", "Unknown", "LIGHT RAIN"),
    ]


def test_cities_flights_airlines(spark):
    cities = spark.createDataFrame(
        [(None, None, None, None)],
        "city_name string, country_iso2 string, iata_code string, timezone string",
    )
    assert rows(clean(cities, specs.CITIES)) == [("Unknown", "XX", "XXX", "UTC")]
    flights = spark.createDataFrame([(" ab1 ", None)], "flight_number string, status string")
    assert rows(clean(flights, specs.FLIGHTS)) == [("AB1", "UNKNOWN")]
    airlines = spark.createDataFrame(
        [(" us AIR", "usa", None)], "name string, country string, iata string"
    )
    assert rows(clean(airlines, specs.AIRLINES)) == [("Us Air", "USA", "XXX")]


def test_rows_only_keeps_duplicates(spark):
    df = spark.createDataFrame([(" a",), (" a",)], "x string")
    assert rows(clean_rows(df, CleanSpec(trim=("x",)))) == [("a",), ("a",)]
    assert rows(clean(df, CleanSpec())) == [(" a",)]


def test_all_strings(spark):
    df = spark.createDataFrame(
        [(1, " new york ", None), (1, " new york ", None), (2, None, "x")], "n int, a string, b string"
    )
    assert rows(standardize_all_strings(df)) == [
        (1, "New York", "Unknown"), (2, "Unknown", "X"),
    ]


def test_text_functions(spark):
    df = spark.createDataFrame([("\t United  States　Air\n",)], "t string")
    got = df.select(
        stripped(F.col("t")), words(F.col("t")), first_word(F.col("t")),
        callsign(F.lit("United Airways")),
    ).first()
    assert tuple(got) == (
        "United  States　Air", ["United", "States", "Air"], "United", "UNITEDAI",
    )


def test_time_texts(spark):
    df = spark.sql(
        "SELECT timestamp_ntz'2024-01-05 23:59:59.5' AS t UNION ALL SELECT timestamp_ntz'2024-12-31 00:00:00'"
    )
    t = F.col("t")
    assert rows(df.select(day_path(t), time_digits(t), iso_text(t))) == [
        ("2024/01/05", "235959", "2024-01-05T23:59:59.500000"),
        ("2024/12/31", "000000", "2024-12-31T00:00:00"),
    ]
    before = datetime.now(timezone.utc).replace(tzinfo=None)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        now = datetime.fromisoformat(spark.range(1).select(utc_iso_now()).first()[0])
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert abs((now - before).total_seconds()) < 60
