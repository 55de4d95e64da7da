"""Raw files to silver tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, dedupe_latest, merge_upsert
from ..sinks import publish, recover
from ..sources import read_csv, read_day, read_json_array, table_exists
from .specs import DAILY_FOLDER, DATASETS, Dataset


@dataclass(frozen=True)
class Layers:
    """Where things are: the raw root folder and the namespaces of the tables."""

    root: str
    silver: str = "silver_layer"
    gold: str = "gold_layer"

    def master_path(self, dataset: Dataset) -> str:
        return f"{self.root}/master/{dataset.name}_data.{dataset.fmt}"

    def silver_table(self, name: str) -> str:
        return f"{self.silver}.{DATASETS[name].table}"


def read_raw(
    spark: SparkSession, layers: Layers, dataset: Dataset, run_date: date | None = None
) -> DataFrame:
    """The dataset's raw rows: its master file, or one day's files for a fact."""
    if dataset.daily:
        folder = DAILY_FOLDER[dataset.name]
        return read_day(spark, layers.root, folder, dataset.fmt, run_date, dataset.schema)
    reader = read_csv if dataset.fmt == "csv" else read_json_array
    return reader(spark, layers.master_path(dataset), dataset.schema)


def load_dimension(
    spark: SparkSession, layers: Layers, name: str, columns: Sequence[str] | None = None,
    latest_by: str | None = "updated_at",
) -> None:
    """Clean a master file and merge it into its table, creating the table when absent.

    Of several rows with one id the latest by ``latest_by`` counts. With None
    they all stay, and every later merge of that id pairs old with new ones.
    """
    dataset = DATASETS[name]
    table = layers.silver_table(name)
    rows = clean(read_raw(spark, layers, dataset), dataset.spec)
    recover(spark, table)
    if table_exists(spark, table):
        rows = merge_upsert(spark.table(table), rows, "id", columns, latest_by=latest_by)
    elif latest_by:
        rows = dedupe_latest(rows, "id", latest_by)
    publish(rows, table)


def load_fact(spark: SparkSession, layers: Layers, name: str, run_date: date) -> None:
    """Clean one day of a fact and put it in place of all that day's rows.

    Tables are partitioned by the day first. A corrected day takes the place of
    the old one, whatever its other partition values; an empty day empties it.
    """
    dataset = DATASETS[name]
    rows = clean(read_raw(spark, layers, dataset, run_date), dataset.spec)
    day = f"{run_date:%Y-%m-%d}"
    publish(
        rows.withColumn("ingest_date", F.lit(day)), layers.silver_table(name), mode="replace_slice",
        partition_by=("ingest_date", *dataset.partition_by), within={"ingest_date": day},
    )
