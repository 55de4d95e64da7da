"""The quality report over the day's raw data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from ..operators import validate_files
from ..sources import file_columns, read_or_empty, union_files
from .silver import Layers
from .specs import DAILY_FOLDER, DATASETS, EXPECTED_COLUMNS, expectations

CHECKED = ("countries", "cities", "weather")


def quality_report(
    spark: SparkSession, layers: Layers, run_date: date, datasets: Sequence[str] = CHECKED,
    on_fail: str = "report", expected: Mapping[str, Sequence[str]] = EXPECTED_COLUMNS,
) -> DataFrame:
    """One report row per dataset, raw file and expected column.

    The files' own headers and keys are asked, not the declared layout.
    ``expected`` lists columns of some datasets; the others must have all of
    their layout. A dataset without files has no rows.
    """
    found = StructType().add("file", StringType()).add("columns", ArrayType(StringType())).add("n_rows", LongType())

    def files(name: str) -> DataFrame:
        dataset = DATASETS[name]
        path = layers.master_path(dataset)
        if dataset.daily:
            path = f"{layers.root}/{run_date:%Y/%m/%d}/{dataset.fmt}/{DAILY_FOLDER[name]}/*.{dataset.fmt}"
        return read_or_empty(spark, lambda: file_columns(spark, path, dataset.fmt), found)

    return union_files(
        validate_files(files(name), name, expectations(name, DATASETS[name].schema, expected), on_fail)
        for name in datasets
    )
