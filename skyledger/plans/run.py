"""One day from raw files to marts, in order."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..sinks import ensure_namespace, publish
from . import gold
from .checks import quality_report
from .increments import refresh_gold
from .silver import Layers, load_dimension, load_fact
from .specs import DATASETS, GOLD_AIRPORTS, GOLD_CITIES, GOLD_FLIGHTS


def load_silver(spark: SparkSession, layers: Layers, run_date: date) -> None:
    ensure_namespace(spark, layers.silver)
    for dataset in DATASETS.values():
        if dataset.daily:
            load_fact(spark, layers, dataset.name, run_date)
        else:
            load_dimension(spark, layers, dataset.name)


def load_gold(spark: SparkSession, layers: Layers, with_weather: bool = False) -> None:
    """Rebuild the marts; the city mart only on request."""
    ensure_namespace(spark, layers.gold)
    silver = {name: spark.table(layers.silver_table(name)) for name in DATASETS}
    marts = {
        GOLD_FLIGHTS: gold.flight_performance(silver["flights"], silver["airlines"]),
        GOLD_AIRPORTS: gold.airport_capacity(silver["airports"], silver["countries"]),
    }
    if with_weather:
        marts[GOLD_CITIES] = gold.city_weather(
            silver["cities"], silver["weather"], silver["countries"]
        )
    for name, rows in marts.items():
        publish(rows, f"{layers.gold}.{name}")


def run(
    spark: SparkSession, layers: Layers, run_date: date, on_fail: str = "report",
    with_weather: bool = False, by_change: bool = False,
) -> DataFrame:
    """Check the raw data, load silver, bring gold up to date. Returns the quality report.

    Gold is rebuilt, or with ``by_change`` only the partitions that the day's changes touch.
    """
    report = quality_report(spark, layers, run_date, on_fail=on_fail)
    load_silver(spark, layers, run_date)
    if by_change:
        refresh_gold(spark, layers, with_weather)
    else:
        load_gold(spark, layers, with_weather)
    return report
