"""Queries that write files of whole tables and read them back."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from ..sinks import export_csv, export_json, land
from ..sources import (
    read_csv, read_csv_folded, read_day, read_json_array, read_json_lines, read_latest, read_or_empty, union_files,
    with_file_name,
)
from .registry import shown
from .standins import table, view, view_sql, with_sql


@shown(
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, "
    "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE ' ' || o_orderpriority END AS priority, "
    "o_totalprice FROM orders"
)
def roundtrip_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "csv")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_custkey",
        "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE ' ' || o_orderpriority END AS priority",
        "o_totalprice",
    )
    export_csv(orders, path)
    return read_csv(spark, path).withColumn("o_totalprice", F.col("o_totalprice").cast("double"))


@shown("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def roundtrip_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "infer")
    export_csv(table(spark, sf_dir, "customer"), path)
    back = read_csv(spark, path, infer=True)
    return back.withColumn("c_custkey", F.col("c_custkey").cast("long"))


@shown(
    "SELECT o_orderkey AS key, CASE o_orderkey % 3 WHEN 0 THEN floor(o_totalprice) WHEN 1 THEN o_totalprice END AS price, "
    "CASE WHEN o_orderkey % 3 <> 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ordered, "
    "CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey AS VARCHAR) WHEN 1 THEN o_orderpriority END AS mark, "
    "'bigint double timestamp string' AS kinds FROM orders"
)
def types_over_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order files that differ in columns and, read alone, in types; each column gets the type that holds all."""
    path = work_dir(spark, "types")
    orders = table(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered")
    kinds = (
        [F.floor("o_totalprice").cast("long").alias("price"), day, F.col("o_custkey").cast("string").alias("mark")],
        [F.col("o_orderpriority").alias("mark"), F.col("o_totalprice").alias("price")],
        [day, F.lit(None).cast("string").alias("price")],
    )
    for k, columns in enumerate(kinds):
        rows = orders.where(F.col("o_orderkey") % 3 == k)
        export_csv(rows.select(*columns, F.col("o_orderkey").alias("key")), f"{path}/{k}")
    back = read_csv_folded(spark, f"{path}/*/*.csv")
    kinds = F.concat_ws(" ", *[F.typeof(c) for c in ("key", "price", "ordered", "mark")])
    return back.select("key", "price", F.date_format("ordered", "yyyy-MM-dd").alias("ordered"), "mark", kinds.alias("kinds"))


@shown("SELECT event_id, user_id, event_type, value, props, CAST(ts AS VARCHAR) AS ts FROM events")
def roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "json")
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    export_json(events, path)
    return read_json_lines(spark, path, events.schema)


ARRAY_ROWS = 1000


@shown("SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders")
def json_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in JSON-array files of at most a thousand elements; types inferred on reading."""
    path = work_dir(spark, "arrays")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"
    )
    arrays = orders.groupBy(F.floor(F.col("o_orderkey") / ARRAY_ROWS)).agg(
        F.to_json(F.collect_list(F.struct(*orders.columns))).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_json_array(spark, path)


WEATHER_BACK = (
    "city, country, region, temperature_c, humidity, timestamp"
)


@shown(f"{with_sql(weather=view_sql('weather'))} SELECT {WEATHER_BACK} FROM weather")
def day_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day folders written by timestamp and read back over all days."""
    root = work_dir(spark, "landing")
    weather = view(spark, sf_dir, "weather").select(
        "city", "country", "region", "temperature_c", "humidity", "timestamp"
    )
    land(weather, root, "weather_data", "csv", "timestamp")
    land(weather, root, "weather_data", "csv", "timestamp", replace_days=True)
    return read_day(spark, root, "weather_data", "csv", None, weather.schema, layout="landed")


@shown("SELECT strftime(ts, '%Y-%m-%d') AS day, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def rows_per_day_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "days")
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    land(events, root, "events", "jsonl", "ts")
    parts = [F.regexp_extract("folder", f"{p}=([0-9]+)", 1) for p in ("year", "month", "day")]
    back = read_json_lines(spark, f"{root}/jsonl/events", "event_id long, ts string")
    folders = back.select(F.col("_metadata.file_path").alias("folder"))
    return folders.groupBy(F.concat_ws("-", *parts).alias("day")).agg(F.count("*").alias("n"))


@shown(
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS nation "
    "FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier"
)
def union_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_mktsegment AS segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS name", "CAST(s_nationkey AS DOUBLE) AS nation"
    )
    return union_files([customers, suppliers])


@shown("SELECT o_orderkey, o_orderstatus FROM orders")
def missing_folder_is_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    missing = work_dir(spark, "missing")
    nothing = read_or_empty(spark, lambda: read_csv(spark, f"{missing}/*.csv"), orders.schema)
    return union_files([nothing, orders])


@shown("SELECT event_type AS country, CAST(count(*) AS VARCHAR) AS readings FROM events GROUP BY 1")
def latest_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of three landed files, the newest weather file; each holds a summary of a table."""
    root = work_dir(spark, "latest")
    parts = (
        ("weather_data/run=1", "orders", "o_orderstatus"),
        ("weather_data/run=2", "events", "event_type"),
        ("flight_data/run=3", "lineitem", "l_returnflag"),
    )
    for folder, name, column in parts:
        counts = table(spark, sf_dir, name).groupBy(F.col(column).alias("country"))
        # A handful of groups: one file each, as a feed would deliver it.
        export_csv(counts.agg(F.count("*").alias("readings")).coalesce(1), f"{root}/{folder}")
        time.sleep(1.1)  # object stores keep whole seconds
    return read_latest(spark, root, "weather_data", read_csv, glob="*.csv")


@shown("SELECT doc_id, source AS folder FROM documents")
def file_provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written by source; each row names the file it came from."""
    path = work_dir(spark, "names")
    documents = table(spark, sf_dir, "documents").select("doc_id", "source")
    documents.withColumn("folder", F.col("source")).write.partitionBy("folder").json(path)
    back = with_file_name(read_json_lines(spark, path, "doc_id long, source string"), "file_name")
    named = F.when(F.col("file_name").endswith(".json"), F.col("source"))
    return back.select("doc_id", named.alias("folder"))
