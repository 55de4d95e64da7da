"""The day's jobs end to end on small raw files, run twice."""

import csv
import json
import os
import re
import uuid
from datetime import date

import pytest
from helpers import png, rows
from pyspark.sql import functions as F

from skyledger import schemas
from skyledger.operators import failures
from skyledger.plans import gold, increments, masterdata, specs
from skyledger.plans.images import ingest_images, load_images
from skyledger.plans.increments import refresh_gold
from skyledger.plans.run import load_gold, run
from skyledger.plans.serving import load_raw, table_from_csv
from skyledger.plans.silver import Layers, load_dimension, load_fact
from skyledger.sinks import ensure_namespace
from skyledger.sources import read_jdbc

DAY = date(2024, 1, 5)
NEXT = date(2024, 1, 6)


def put_csv(path, schema, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as f:
        writer = csv.DictWriter(f, schema.fieldNames())
        writer.writeheader()
        writer.writerows({c: r.get(c, "") for c in schema.fieldNames()} for r in records)


def put_json(path, schema, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps([{c: r.get(c) for c in schema.fieldNames()} for r in records]))


def put_day(root, day, tag):
    folder = root / f"{day:%Y/%m/%d}"
    weather = {"city": " new york", "country": "usa", "weather_desc": "rain", "temperature_c": "5"}
    put_csv(folder / "csv/weather_data/w1.csv", schemas.WEATHER, [weather, {**weather, "city": "NEW YORK "}])
    put_csv(folder / "csv/weather_data/w2.csv", schemas.WEATHER, [{**weather, "city": "oslo"}])
    flight = {"flight_number": "ab1", "airline_iata": "AA", "distance_km": 5.5}
    put_json(
        folder / "json/flight_data/f.json", schemas.FLIGHTS,
        [{**flight, "flight_id": f"{tag}1", "status": "landed"}, {**flight, "flight_id": f"{tag}2"},
         {**flight, "flight_id": f"{tag}2"}, {**flight, "flight_id": f"{tag}3", "airline_iata": "ZZ"}],
    )


def put_masters(root):
    put_csv(root / "master/countries_data.csv", schemas.COUNTRIES,
            [{"id": "1", "name": "germany", "iso2": "de", "continent": "eu", "population": "80", "created_at": "t0"}])
    put_csv(root / "master/cities_data.csv", schemas.CITIES,
            [{"id": "1", "iata_code": "nyc", "city_name": "new york", "country_iso2": "us"}])
    put_json(root / "master/airlines_data.json", schemas.AIRLINES,
             [{"id": "1", "name": "american air", "iata": "aa"}, {"id": "2", "name": None, "iata": None}])
    put_json(root / "master/airports_data.json", schemas.AIRPORTS,
             [{"id": "1", "airport_id": "1", "airport_name": "munich", "country_iso2": "DE"}])


@pytest.fixture
def layers(spark, tmp_path):
    tag = tmp_path.name.replace("-", "_")
    made = Layers(str(tmp_path / "raw"), f"s_{tag}", f"g_{tag}")
    yield made
    for name in (made.silver, made.gold):
        spark.sql(f"DROP NAMESPACE IF EXISTS {name} CASCADE")


def test_days(spark, tmp_path, layers):
    root = tmp_path / "raw"
    put_masters(root)
    put_day(root, DAY, "d")
    table = lambda name: spark.table(name)

    for _ in range(2):
        report = run(spark, layers, DAY, with_weather=True)
        assert rows(failures(report), "dataset", "column") == [("countries", "population2")]
        assert rows(table(layers.silver_table("countries")), "name", "iso2", "capital", "created_at") == [
            ("Germany", "DE", "Unknown", "t0")
        ]
        assert rows(table(layers.silver_table("airlines")), "name", "iata") == [
            ("American Air", "AA"), ("Unknown", "XXX")
        ]
        assert rows(table(layers.silver_table("weather")), "city", "region", "ingest_date") == [
            ("New York", "Unknown", "2024-01-05"), ("Oslo", "Unknown", "2024-01-05")
        ]
        assert rows(table(layers.silver_table("flights")), "flight_id", "status") == [
            ("d1", "landed"), ("d2", "UNKNOWN"), ("d3", "UNKNOWN")
        ]
        flights = table(f"{layers.gold}.flight_performance_summary_v1")
        assert tuple(flights.columns) == gold.FLIGHT_PERFORMANCE
        assert rows(flights, "flight_id", "airline_name") == [
            ("d1", "American Air"), ("d2", "American Air"), ("d3", None)
        ]
        assert rows(table(f"{layers.gold}.airport_capacity_analysis_v1")) == [
            ("1", "Munich", "DE", "Germany", "EU", "80")
        ]
        assert table(f"{layers.gold}.city_weather_analysis_v1").count() == 1

    put_day(root, NEXT, "e")
    put_csv(root / "master/countries_data.csv", schemas.COUNTRIES,
            [{"id": "1", "name": "deutschland", "iso2": "de"}, {"id": "2", "name": "france", "iso2": "fr"}])
    run(spark, layers, NEXT)
    assert table(layers.silver_table("flights")).count() == 6
    assert rows(table(layers.silver_table("countries")), "id", "name", "continent", "population", "created_at") == [
        ("1", "Deutschland", "UNKNOWN", "80", "t0"), ("2", "France", "UNKNOWN", None, None)
    ]
    # The fixed merge lists of some users leave the time stamps out.
    load_dimension(spark, layers, "countries", columns=("id", "name", "population"))
    assert rows(table(layers.silver_table("countries"))) == [("1", "Deutschland", "80"), ("2", "France", None)]


def test_repeated_ids(spark, tmp_path, layers):
    repeated = [{"id": "1", "name": n, "updated_at": n} for n in ("a", "c", "b")]
    put_csv(tmp_path / "raw/master/countries_data.csv", schemas.COUNTRIES, repeated)
    ensure_namespace(spark, layers.silver)
    table = layers.silver_table("countries")
    for _ in range(2):
        load_dimension(spark, layers, "countries")
        assert rows(spark.table(table), "id", "name") == [("1", "C")]
    spark.sql(f"DROP TABLE {table}")
    load_dimension(spark, layers, "countries", latest_by=None)
    assert spark.table(table).count() == 3


def test_countries_grow_from_the_newest_weather_file(spark, tmp_path, layers):
    put_masters(tmp_path / "raw")
    ensure_namespace(spark, layers.silver)
    load_dimension(spark, layers, "countries")
    assert not masterdata.add_countries_from_weather(spark, layers, "t1")
    for number, (day, name) in enumerate(((DAY, "oman"), (NEXT, "chad"))):
        file = tmp_path / "raw" / f"{day:%Y/%m/%d}" / "csv/weather_data/w.csv"
        put_csv(file, schemas.WEATHER, [{"country": name}, {"country": "Germany"}, {"country": name}])
        os.utime(file, (5_000 - number, 5_000 - number))
    for _ in range(2):
        assert masterdata.add_countries_from_weather(spark, layers, "t1", master_col="name")
        assert rows(spark.table(layers.silver_table("countries")), "id", "name", "iso2", "capital") == [
            ("1", "Germany", "DE", "Unknown"), ("3000000", "oman", "OM", "Capital oman")
        ]


def test_a_failed_merge_keeps_the_table(spark, tmp_path, layers):
    put_masters(tmp_path / "raw")
    ensure_namespace(spark, layers.silver)
    load_dimension(spark, layers, "countries")
    (tmp_path / "raw/master/countries_data.csv").write_text("id,oops\n1,2\n")
    with pytest.raises(Exception):
        load_dimension(spark, layers, "countries")
    assert spark.table(layers.silver_table("countries")).count() == 1


def test_images_of_all_days(spark, tmp_path, layers):
    for day in ("2024/01/05", "2024/01/06"):
        folder = tmp_path / "raw" / day / "images"
        folder.mkdir(parents=True)
        (folder / f"p{day[-1]}.jpg").write_bytes(png(2, 1, 3, range(6)))
    load_images(spark, layers, lambda h, w, c, d: f"AA1 UA JFK LHR Boeing {h}x{w} 9km landed")
    assert rows(spark.table(f"{layers.silver}.image_metadata_with_text"), "file_name", "width", "mode") == [
        ("p5.jpg", 2, "RGB"), ("p6.jpg", 2, "RGB")
    ]
    found = spark.table(f"{layers.silver}.flight_table_ocr_json").first()["ocr_text"]
    assert json.loads(found) == [{
        "Flight": "AA1", "Airline": "UA", "From": "JFK", "To": "LHR", "Aircraft": "Boeing 1x2",
        "Distance": "9", "Status": "landed",
    }]


def test_raw_files_to_a_database_and_a_table(spark, tmp_path, layers):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    put_day(tmp_path, DAY, "d")
    day = tmp_path / f"{DAY:%Y/%m/%d}"
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for _ in range(2):
        load_raw(spark, f"{day}/csv/weather_data/*.csv", f"{day}/json/flight_data/*.json", url, props)
    weather = read_jdbc(spark, url, "weather_data_csv", props)
    assert weather.count() == 3 and dict(weather.dtypes)["temperature_c"] == "int"
    assert read_jdbc(spark, url, "flight_data_json", props).count() == 4
    ensure_namespace(spark, layers.silver)
    table_from_csv(spark, f"{day}/csv/weather_data/*.csv", f"{layers.silver}.raw_weather")
    assert spark.table(f"{layers.silver}.raw_weather").count() == 3


def test_a_corrected_day_takes_the_place_of_the_old_one(spark, tmp_path, layers):
    root = tmp_path / "raw"
    flights = lambda: rows(spark.table(layers.silver_table("flights")), "flight_id", "status", "ingest_date")
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {layers.silver}")

    def land_flights(day, *pairs):
        put_json(root / f"{day:%Y/%m/%d}/json/flight_data/flights.json", schemas.FLIGHTS,
                 [{"flight_id": i, "status": s} for i, s in pairs])
        load_fact(spark, layers, "flights", day)

    land_flights(NEXT, ("9", "LANDED"))
    land_flights(DAY, ("1", "SCHEDULED"), ("2", "CANCELLED"))
    land_flights(DAY, ("1", "LANDED"))
    other = ("9", "LANDED", f"{NEXT:%Y-%m-%d}")
    assert flights() == [("1", "LANDED", f"{DAY:%Y-%m-%d}"), other]
    land_flights(DAY)
    assert flights() == [other]


@pytest.mark.parametrize("stop", range(6))
def test_a_stop_anywhere_in_a_replacement_loses_nothing(spark, tmp_path, layers, monkeypatch, stop):
    root, table = tmp_path / "raw", layers.silver_table("countries")
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {layers.silver}")
    path = root / "master/countries_data.csv"
    put_csv(path, schemas.COUNTRIES, [{"id": "1", "name": "germany", "iso2": "de"}, {"id": "2", "name": "france", "iso2": "fr"}])
    load_dimension(spark, layers, "countries")
    put_csv(path, schemas.COUNTRIES, [{"id": "3", "name": "spain", "iso2": "es"}])
    said, real = [], type(spark).sql

    def stopped(self, text, *args, **kwargs):
        if "__next" in text or "__old" in text:
            said.append(text)
            if len(said) > stop:
                raise RuntimeError("stopped")
        return real(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", stopped)
    try:
        load_dimension(spark, layers, "countries")
    except RuntimeError:
        pass
    monkeypatch.undo()
    load_dimension(spark, layers, "countries")
    assert rows(spark.table(table), "id") == [("1",), ("2",), ("3",)]
    load_dimension(spark, layers, "countries")
    assert spark.table(table).count() == 3


def written(spark, table, part):
    """Files of each partition of a table."""
    found = spark.table(table).select(F.col(part).cast("string").alias("p"), F.col("_metadata.file_path").alias("f")).distinct().collect()
    out = {}
    for r in found:
        out.setdefault(r["p"], set()).add(r["f"])
    return out


def test_marts_follow_changes_by_partition(spark, tmp_path, layers):
    root = tmp_path / "raw"
    put_masters(root)
    marts = {f"{layers.gold}.{n}": p for n, p in (
        (specs.GOLD_FLIGHTS, "ingest_date"), (specs.GOLD_AIRPORTS, "id_part"), (specs.GOLD_CITIES, "ingest_date"))}
    flights, airports, cities = marts
    again = Layers(layers.root, layers.silver, f"{layers.gold}_full")

    def go():
        """Refresh; the marts equal full rebuilds, and untouched partitions keep their files."""
        before = {t: written(spark, t, p) if spark.catalog.tableExists(t) else {} for t, p in marts.items()}
        done = refresh_gold(spark, layers, with_weather=True)
        load_gold(spark, again, with_weather=True)
        for table, part in marts.items():
            full = table.replace(layers.gold, again.gold)
            assert rows(spark.table(table).drop(part)) == rows(spark.table(full))
            if done[table] is not None:
                now = written(spark, table, part)
                for p in now.keys() & before[table].keys() - {"none"}:
                    assert (now[p] == before[table][p]) == (p not in done[table]), (table, p)
        return done

    def land(day, tag):
        put_day(root, day, tag)
        load_fact(spark, layers, "flights", day)
        load_fact(spark, layers, "weather", day)

    ensure_namespace(spark, layers.silver)
    for name in ("countries", "cities", "airlines", "airports"):
        load_dimension(spark, layers, name)
    land(DAY, "d")
    assert set(go().values()) == {None}
    assert go() == {flights: [], airports: [], cities: []}
    land(NEXT, "e")
    assert go() == {flights: ["2024-01-06"], airports: [], cities: ["2024-01-06"]}
    # An airline of all days gets another name; one that no flight names changes nothing.
    put_json(root / "master/airlines_data.json", schemas.AIRLINES, [{"id": "1", "name": "other air", "iata": "aa"}, {"id": "9", "name": "none", "iata": "QQ"}])
    load_dimension(spark, layers, "airlines")
    assert go() == {flights: ["2024-01-05", "2024-01-06"], airports: [], cities: []}
    # A new airport is one partition; a country's new population touches its airports.
    put_json(root / "master/airports_data.json", schemas.AIRPORTS,
             [{"id": "7", "airport_id": "7", "airport_name": "lyon", "country_iso2": "FR"}])
    load_dimension(spark, layers, "airports")
    assert len(go()[airports]) == 1
    put_csv(root / "master/countries_data.csv", schemas.COUNTRIES, [{"id": "1", "population": "81"}])
    load_dimension(spark, layers, "countries")
    assert len(go()[airports]) == 1
    # A city that readings name; a day corrected; a day emptied.
    put_csv(root / "master/cities_data.csv", schemas.CITIES, [{"id": "2", "iata_code": "oslo", "city_name": "oslo"}])
    load_dimension(spark, layers, "cities")
    assert go()[cities] == ["2024-01-05", "2024-01-06"]
    put_json(root / f"{DAY:%Y/%m/%d}/json/flight_data/f.json", schemas.FLIGHTS, [{"flight_id": "x", "airline_iata": "AA"}])
    load_fact(spark, layers, "flights", DAY)
    assert go()[flights] == ["2024-01-05"]
    for file in (root / f"{NEXT:%Y/%m/%d}").rglob("*.*"):
        file.write_text("[]" if file.suffix == ".json" else ",".join(schemas.WEATHER.fieldNames()) + "\n")
    load_fact(spark, layers, "flights", NEXT)
    load_fact(spark, layers, "weather", NEXT)
    done = go()
    assert done[flights] == ["2024-01-06"] and done[cities] == ["2024-01-06"]
    assert set(written(spark, flights, "ingest_date")) == {"2024-01-05"}
    spark.sql(f"DROP NAMESPACE {again.gold} CASCADE")


def test_a_stopped_refresh_is_done_again(spark, tmp_path, layers, monkeypatch):
    root = tmp_path / "raw"
    put_masters(root)
    ensure_namespace(spark, layers.silver)
    for name in ("countries", "cities", "airlines", "airports"):
        load_dimension(spark, layers, name)
    put_day(root, DAY, "d")
    load_fact(spark, layers, "flights", DAY)
    refresh_gold(spark, layers)
    put_day(root, NEXT, "e")
    load_fact(spark, layers, "flights", NEXT)
    real = increments.publish

    def stopped(df, table, **kwargs):
        if table.endswith("__prints"):
            raise RuntimeError("stopped")
        real(df, table, **kwargs)

    monkeypatch.setattr(increments, "publish", stopped)
    with pytest.raises(RuntimeError):
        refresh_gold(spark, layers)
    monkeypatch.undo()
    assert refresh_gold(spark, layers)[f"{layers.gold}.{specs.GOLD_FLIGHTS}"] == ["2024-01-06"]
    assert spark.table(f"{layers.gold}.{specs.GOLD_FLIGHTS}").count() == 6


def test_an_untouched_day_is_not_read(spark, tmp_path, layers):
    root = tmp_path / "raw"
    put_masters(root)
    ensure_namespace(spark, layers.silver)
    load_dimension(spark, layers, "airlines")
    put_day(root, DAY, "d")
    load_fact(spark, layers, "flights", DAY)
    mart = increments.flights_mart(spark, layers)
    chosen = mart.build(mart.driving.where(F.col("ingest_date").isin("2024-01-05")), [x.rows for x in mart.lookups])
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ingest_date", plan)
    listing = increments.file_prints(spark, layers.silver_table("flights"), "ingest_date")
    assert "content" not in re.search(r"ReadSchema: \S+", listing._jdf.queryExecution().executedPlan().toString())[0]


def test_members_are_added_to_the_tables(spark, tmp_path, layers):
    put_masters(tmp_path / "raw")
    ensure_namespace(spark, layers.silver)
    for name in ("cities", "airlines", "airports"):
        load_dimension(spark, layers, name)
    frame = lambda ddl, *values: spark.createDataFrame([(v,) for v in values], ddl)
    table = lambda name: spark.table(layers.silver_table(name))
    masterdata.store_airlines(spark, layers, frame("name string", "Zeta", "Alpha"), "t1")
    assert rows(table("airlines").where("created_at = 't1'"), "id", "name", "iata", "icao") == [
        ("1000000", "Alpha", "AB", "AAA"), ("1000001", "Zeta", "AC", "AAB"),
    ]
    masterdata.store_airports(spark, layers, frame("airport_name string", "Bergen"), "t1")
    masterdata.store_airports(spark, layers, frame("airport_name string", "Aarhus"), "t2")
    assert rows(table("airports").where("created_at IN ('t1', 't2')"), "id", "airport_name", "iata_code", "icao_code") == [
        ("2000000", "Bergen", "AAA", "AAAA"), ("2000001", "Aarhus", "AAB", "AAAB"),
    ]
    masterdata.store_cities(spark, layers, frame("city_name string", "Oslo"), "t1")
    assert rows(table("cities").where("created_at = 't1'"), "id", "city_name", "iata_code") == [("4000000", "Oslo", "AAA")]
    assert table("airlines").count() == 4 and table("airports").count() == 3 and table("cities").count() == 2


def test_each_picture_is_read_once(spark, tmp_path, layers):
    calls = tmp_path / "calls"
    calls.mkdir()

    def read(h, w, c, d):
        (calls / uuid.uuid4().hex).touch()
        return f"AA1 UA JFK LHR Boeing {h}x{w} 9km landed"

    def put(day, *widths):
        folder = tmp_path / "raw" / day / "images"
        folder.mkdir(parents=True)
        for w in widths:
            (folder / f"p{day[-1]}{w}.jpg").write_bytes(png(w, 1, 3, [1] * 3 * w))
        (folder / "bad.jpg").write_bytes(b"spoilt")

    def go():
        ingest_images(spark, layers, str(tmp_path / "cp"), read)
        text, flights = (spark.table(f"{layers.silver}.{t}") for t in (specs.IMAGE_TEXT_TABLE, specs.IMAGE_FLIGHTS_TABLE))
        return rows(text, "batch", "file_name", "width", "ocr_text"), flights

    put("2024/01/05", 2, 3)
    found, _ = go()
    assert len(list(calls.iterdir())) == 2 and [r[:3] for r in found] == [("0", "bad.jpg", None), ("0", "p52.jpg", 2), ("0", "p53.jpg", 3)]
    put("2024/01/06", 4)
    for _ in range(2):
        found, flights = go()
        assert len(list(calls.iterdir())) == 3 and len(found) == 5 and found[-1][:3] == ("1", "p64.jpg", 4)
    # Both tables are those of a full load.
    load_images(spark, Layers(layers.root, layers.gold), lambda h, w, c, d: f"AA1 UA JFK LHR Boeing {h}x{w} 9km landed")
    for name, table in ((specs.IMAGE_TEXT_TABLE, None), (specs.IMAGE_FLIGHTS_TABLE, flights)):
        own = spark.table(f"{layers.silver}.{name}") if table is None else table
        assert rows(own.drop("batch")) == rows(spark.table(f"{layers.gold}.{name}"))
    # The last batch is forgotten and runs again: nothing is doubled.
    for name in ("1", ".1.crc"):
        (tmp_path / "cp/commits" / name).unlink(missing_ok=True)
    found, flights = go()
    assert len(found) == 5 == flights.count()
