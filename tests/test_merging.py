import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from skyledger.operators import merging
from skyledger.operators import (
    apply_updates, attach_facts, changed_rows, dedupe_latest, enrich, merge_upsert,
)
from skyledger.plans import gold

SCHEMA = "id int, name string, population int"


def test_upsert_rules(spark):
    target = spark.createDataFrame([(1, "Old", 10), (2, "Keep", 20), (None, "NullT", 30)], SCHEMA)
    source = spark.createDataFrame(
        [(1, None, None), (3, "New", 33), (None, "Nulls", 34), (4, "D1", 1), (4, "D2", 2)], SCHEMA
    ).na.fill({"name": "Unknown"})
    assert rows(merge_upsert(target, source, "id")) == [
        (None, "NullT", 30), (None, "Nulls", 34), (1, "Unknown", 10), (2, "Keep", 20),
        (3, "New", 33), (4, "D1", 1), (4, "D2", 2),
    ]


def test_upsert_columns(spark):
    target = spark.createDataFrame([(1, "a", "old")], "id int, name string, only_target string")
    source = spark.createDataFrame([(1, None, "new"), (2, "b", "n")], "id int, name string, only_source string")
    assert rows(merge_upsert(target, source, "id")) == [(1, "a", "old", "new"), (2, "b", None, "n")]
    subset = merge_upsert(target, source, "id", columns=["id", "name"], fill_after_merge={"name": "?"})
    assert subset.columns == ["id", "name"] and rows(subset) == [(1, "a"), (2, "b")]


def expected_upsert(target, source):
    """Full outer join on the first column, one row at a time."""
    out, met = [], set()
    for s in source:
        matches = [t for t in target if s[0] is not None and t[0] == s[0]]
        met.update(t[0] for t in matches)
        out += [tuple(a if a is not None else b for a, b in zip(s, t)) for t in matches] or [s]
    return out + [t for t in target if t[0] not in met or t[0] is None]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("latest_by", [None, "population"])
@pytest.mark.parametrize("small", [{"target", "source"}, {"source"}, set()])
def test_upsert_equals_full_outer_join(spark, monkeypatch, seed, small, latest_by):
    rng = random.Random(seed)

    def some(n, keys):
        return [
            (rng.choice([None, *range(keys)]), rng.choice([None, "a", "b"]), rng.choice([None, 1, 2]))
            for _ in range(n)
        ]

    # Repeated keys on both sides as well.
    target, source = some(20, 20), some(60, 25)
    # A column of the source alone tells which side is asked about.
    side = lambda df: "source" if "extra" in df.columns else "target"
    monkeypatch.setattr(merging, "looks_small", lambda df: side(df) in small)
    batch = spark.createDataFrame(source, SCHEMA).withColumn("extra", F.lit(1))
    merged = merge_upsert(spark.createDataFrame(target, SCHEMA), batch, "id", latest_by=latest_by)
    got = rows(merged.drop("extra"))
    if latest_by:
        def rank(r):
            return (r[2] is not None, r[2] or 0, r[1] is not None, r[1] or "")

        last = {r[0]: r for r in sorted(source, key=rank) if r[0] is not None}
        source = [r for r in source if r[0] is None] + list(last.values())
    want = rows(spark.createDataFrame(expected_upsert(target, source), SCHEMA))
    assert got == want


def test_two_part_key(spark):
    schema = "a int, b string, v int"
    target = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (1, None, 3)], schema)
    source = spark.createDataFrame([(1, "y", 9), (1, None, 4)], schema)
    assert rows(merge_upsert(target, source, ["a", "b"])) == [
        (1, None, 3), (1, None, 4), (1, "x", 1), (1, "y", 9),
    ]


def test_changed_rows(spark):
    current = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None)], SCHEMA)
    source = spark.createDataFrame([(1, "a", None), (2, "B", 2), (3, "c", 5), (4, "d", 4)], SCHEMA)
    assert rows(changed_rows(current, source, "id")) == [(2, "B", 2), (3, "c", 5), (4, "d", 4)]


def test_dedupe_latest(spark):
    df = spark.createDataFrame(
        [(1, "a", 1), (1, "b", 2), (1, "c", 2), (None, "d", 1), (None, "e", 1), (2, "f", None)], SCHEMA
    )
    assert rows(dedupe_latest(df, "id", "population")) == [
        (None, "d", 1), (None, "e", 1), (1, "c", 2), (2, "f", None),
    ]


def test_updates(spark):
    df = spark.createDataFrame(
        [(1, "Paris", 10, "t0"), (2, "Rome", 20, "t0"), (3, "Oslo", 30, "t0"), (None, "?", 0, "t0")],
        "id int, capital string, population int, updated_at string",
    )
    updates = spark.createDataFrame([("1", 11), ("2", None), (None, 5)], "id string, population int")
    got = apply_updates(
        df, updates, "id", "updated_at", "t1", derive={"capital": F.concat(F.lit("New "), "capital")}
    )
    assert rows(got) == [
        (None, "?", 0, "t0"), (1, "New Paris", 11, "t1"), (2, "New Rome", 20, "t1"),
        (3, "Oslo", 30, "t0"),
    ]
    twice = spark.createDataFrame([("1", 11, 1), ("1", 12, 2)], "id string, population int, seq int")
    latest = apply_updates(df, twice, "id", order_by="seq")
    assert (1, "Paris", 12, "t0") in rows(latest)
    with pytest.raises(Exception, match="more than one row for key 1"):
        apply_updates(df, twice.drop("seq"), "id").collect()


def test_enrich_repeats_or_refuses_repeated_dimension_keys(spark):
    fact = spark.createDataFrame([(1, "XXX"), (2, "AA"), (3, None)], "f int, code string")
    dim = spark.createDataFrame([("XXX", "x1"), ("XXX", "x2"), ("AA", "a"), (None, "n")], "iata string, name string")
    on, take = {"code": "iata"}, {"name": "airline_name"}
    assert rows(enrich(fact, dim, on, take)) == [
        (1, "XXX", "x1"), (1, "XXX", "x2"), (2, "AA", "a"), (3, None, None),
    ]
    with pytest.raises(Exception, match="more than one row for key XXX"):
        enrich(fact, dim, on, take, unique_dim=True).collect()
    unique = dim.where("name <> 'x2'")
    assert rows(enrich(fact, unique, on, take, unique_dim=True)) == [
        (1, "XXX", "x1"), (2, "AA", "a"), (3, None, None),
    ]


def test_attach_facts_is_a_left_join(spark):
    dim = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "code string, n int")
    fact = spark.createDataFrame([("A", 10), ("A", 11), ("Z", 12), (None, 13)], "city string, temp int")
    got = attach_facts(dim, fact, {"code": "city"}, {"temp": "temp"})
    assert got.columns == ["code", "n", "temp"]
    assert rows(got) == [(None, 3, None), ("A", 1, 10), ("A", 1, 11), ("B", 2, None)]


def test_marts(spark):
    flights = spark.createDataFrame(
        [("f1", "AB1", "AA", "JFK", "LHR", "A320", 5.0, "landed", "x")],
        "flight_id string, flight_number string, airline_iata string, departure_airport_iata string, "
        "arrival_airport_iata string, aircraft_type string, distance_km double, status string, created_at string",
    )
    airlines = spark.createDataFrame([("1", "Air", "AA", "gone")], "id string, name string, iata string, status string")
    got = gold.flight_performance(flights, airlines)
    assert tuple(got.columns) == gold.FLIGHT_PERFORMANCE
    assert rows(got) == [("f1", "AB1", "AA", "Air", "A320", "JFK", "LHR", 5.0, "landed")]
    weather = spark.createDataFrame(
        [("JFK", "t1", "Rain", "1", "2"), ("JFK", "t2", "Sun", "3", "4")],
        "city string, timestamp string, weather_desc string, temperature_c string, wind_speed_kmh string",
    )
    assert rows(gold.flight_weather(flights, airlines, weather), "weather_condition", "temperature_c") == [("Sun", "3")]


@pytest.mark.parametrize("small", [True, False])
def test_names_with_dots(spark, monkeypatch, small):
    monkeypatch.setattr(merging, "looks_small", lambda df: small)
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], "`k.id` int, `v.x` string, `v.y` int")
    source = spark.createDataFrame([(1, "A", None), (3, "C", 4)], "`k.id` int, `v.x` string, `v.y` int")
    want = [(None, "n", 3), (1, "A", 1), (2, "b", 2), (3, "C", 4)]
    assert rows(merge_upsert(target, source, "k.id", fill_after_merge={"v.x": "?"})) == want
    assert rows(merge_upsert(target, source, "k.id", latest_by="v.y")) == want
    assert rows(changed_rows(target, source, "k.id")) == [(1, "A", 1), (3, "C", 4)]
    assert rows(dedupe_latest(target.union(source), "k.id", "v.y")) == [(None, "n", 3), (1, "a", 1), (2, "b", 2), (3, "C", 4)]
    changes = spark.createDataFrame([("1", "Z")], "`k.id` string, `v.x` string")
    assert rows(apply_updates(target, changes, "k.id")) == [(None, "n", 3), (1, "Z", 1), (2, "b", 2)]
