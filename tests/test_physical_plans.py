"""The plans the operators count on at scale: small shuffles, split hot keys, pruned scans."""

import re
from contextlib import contextmanager

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from skyledger.operators import (
    as_of, assign_ids, attach_facts, available_codes, clean, code_pool, dedupe_latest, enrich, files,
    merge_upsert, new_members, parse_flight_table, read_history, validate, write_commit, Expectation,
)
from skyledger.plans import specs
from skyledger.sinks import publish
from skyledger.sources import read_files

SF = "/root/testdata/sf0.01"
SMALL_PARTITIONS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "100KB",
}
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def conf(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """60 000 rows, a third under one key and some without a key; and 2 000 keys with a row each."""
    base = tmp_path_factory.mktemp("hot")
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 2000)
    many = spark.range(60_000).select(
        key.cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("text"), F.col("id").alias("n")
    )
    many.repartition(24).write.parquet(f"{base}/many")
    ones = spark.range(2_000).select(F.col("id").cast("string").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("old"))
    ones.write.parquet(f"{base}/ones")
    return spark.read.parquet(f"{base}/many"), spark.read.parquet(f"{base}/ones")


def split(plan):
    return re.search(r"(SortMergeJoin|ShuffledHashJoin)\(skew=true\)", plan) is not None


def test_no_operator_pairs_everything(spark, hot):
    many, ones = hot
    plans = [
        merge_upsert(ones, many, "k"), enrich(many, ones, {"k": "k"}, {"old": "old"}),
        attach_facts(ones, many, {"k": "k"}, {"n": "n"}),
        new_members(many, ones, "k", "k"), code_pool(spark, 3),
        available_codes(code_pool(spark, 3), ones, "k"),
    ]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        assert "SinglePartition" not in plan


def test_small_batch_does_not_shuffle_the_target(spark, hot):
    many, ones = hot
    batch = ones.select("k", F.lit("t").alias("text")).limit(50)
    with conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "500KB"}):
        plan = plan_of(merge_upsert(many.select("k", "text"), batch, "k"))
    final = plan.split("Initial Plan")[0]
    assert "SortMergeJoin" not in final and "ShuffledHashJoin" not in final
    # Read once in full, and once for the key alone.
    assert "RightOuter, BuildLeft" in final and "LeftSemi, BuildRight" in final
    assert final.count("ReadSchema: struct<k:string,text:string>") == 1


def test_big_batch_reuses_the_target_shuffle_and_splits_hot_keys(spark, hot):
    many, ones = hot
    with conf(spark, {**NO_BROADCAST, **SMALL_PARTITIONS}):
        plan = plan_of(merge_upsert(ones, many.withColumnRenamed("text", "old"), "k")).split("Initial Plan")[0]
    assert split(plan) and "ReusedExchange" in plan
    assert "FullOuter" not in plan


def test_big_batch_cut_to_the_latest_is_one_join(spark, hot):
    many, ones = hot
    with conf(spark, NO_BROADCAST):
        batch = many.withColumnRenamed("text", "old")
        plan = plan_of(merge_upsert(ones, batch, "k", ["k", "old"], latest_by="n")).split("Initial Plan")[0]
    assert plan.count("FullOuter") == 1 and "LeftAnti" not in plan
    # One shuffle each: the batch lies by key after its latest rows are picked.
    assert plan.count("Exchange hashpartitioning") == 2


def test_hot_fact_key_is_split(spark, hot):
    many, ones = hot
    with conf(spark, {**NO_BROADCAST, **SMALL_PARTITIONS}):
        joined = enrich(many, ones, {"k": "k"}, {"old": "old"}, unique_dim=True)
        assert split(plan_of(joined)) and joined.count() == 60_000
        attached = attach_facts(ones, many, {"k": "k"}, {"text": "text"})
        assert split(plan_of(attached))


def test_dedupe_latest_cuts_before_the_shuffle(spark, hot):
    many, _ = hot
    plan = plan_of(dedupe_latest(many, "k", "n")).split("Initial Plan")[0]
    below = plan[plan.index("Exchange"):]
    assert re.search(r"WindowGroupLimit .*Partial", below)
    assert "IsNull(k)" in plan  # rows without a key are picked by the scan, not shuffled


def test_copies_meet_before_the_shuffle(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_returnflag", "l_linestatus")
    df = clean(lines, specs.CleanSpec(upper=("l_returnflag",)))
    plan = plan_of(df).split("Initial Plan")[0]
    assert plan.count("HashAggregate") == 2 and plan.index("Exchange") < plan.rindex("HashAggregate")
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in plan


def test_hot_partition_is_written_by_several_tasks(spark, hot, tmp_path):
    many, _ = hot
    with conf(spark, SMALL_PARTITIONS):
        spark.sql("DROP TABLE IF EXISTS hot_parts")
        publish(many.selectExpr("n", "text", "n % 3 = 0 AS part"), "hot_parts", partition_by=["part"])
        listed = files(spark.table("hot_parts"))
        per_part = listed.groupBy(F.regexp_extract("file_path", "part=(\\w+)", 1)).agg(F.max("n_rows")).collect()
        assert listed.count() > 4 and all(r[1] < 40_000 for r in per_part)
        assert spark.table("hot_parts").count() == 60_000
        spark.sql("DROP TABLE hot_parts")


def test_ids_come_without_a_global_window(spark, hot):
    many, _ = hot
    df = assign_ids(many.select("n"), "n")
    plan = plan_of(df).split("Initial Plan")[0]
    single = plan[plan.index("SinglePartition"):]
    # Only the slice counts come together.
    assert "partial_count" in single and plan.count("SinglePartition") == 1


def test_only_wanted_commits_and_columns_are_read(spark, hot, tmp_path):
    many, _ = hot
    for n in (1, 2):
        write_commit(many.limit(10), str(tmp_path / "h"), n)
    old = as_of(read_history(spark, str(tmp_path / "h")), 1)
    plan = plan_of(old.select("k"))
    assert re.search(r"PartitionFilters: \[.*commit_id", plan) and "ReadSchema: struct<k:string>" in plan


def test_listing_reads_no_bytes(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"123")
    listing = read_files(spark, str(tmp_path)).select("path", "modificationTime").where(F.col("path").contains("x"))
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in plan_of(listing)


def test_text_stays_in_its_task(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plan = parse_flight_table(documents, "text")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_checks_read_no_columns(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = plan_of(validate(orders, "orders", [Expectation("o_orderkey")]))
    assert "ReadSchema: struct<>" in plan
