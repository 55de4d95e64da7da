"""Every registered query against its SQL on a given scale."""

import os

import pytest
from oracle import connect, difference

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, SQL[name]) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


SHUFFLED = (
    "merge_airlines", "merge_repeated_and_null_ids", "merge_latest_changes", "changed_airlines",
    "update_airlines_by_id", "silver_to_gold", "airport_capacity", "city_weather",
)


@pytest.mark.parametrize("threshold", ["-1", "30KB"])
def test_same_results_when_sides_are_big(spark, con, threshold):
    """The shuffled plans, with partitions cut as if they were hot, and the small-batch plans."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": threshold,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        wrong = {n: difference(QUERIES[n](spark, SF_DIR), con, SQL[n]) for n in SHUFFLED}
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert not any(wrong.values()), wrong
