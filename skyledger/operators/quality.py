"""Checks on datasets, reported as rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class QualityError(Exception):
    """Raised by ``validate(..., on_fail="raise")``."""


@dataclass(frozen=True)
class Expectation:
    """The dataset has a column of this name."""

    column: str
    name: str = "expect_column_to_exist"


def validate(
    df: DataFrame, dataset: str, expectations: Sequence[Expectation], on_fail: str = "report"
) -> DataFrame:
    """One row per expectation: dataset, expectation, column, status, success, n_rows, detail.

    A dataset without rows is ``skipped`` and ``success`` is null. The default
    only reports; ``on_fail="raise"`` raises when something failed.
    """
    if on_fail not in ("report", "raise"):
        raise ValueError(f"unknown on_fail {on_fail!r}")
    checks = F.array(
        *[
            F.struct(
                F.lit(e.name).alias("expectation"),
                F.lit(e.column).alias("column"),
                F.lit(e.column in df.columns).alias("ok"),
            )
            for e in expectations
        ]
    )
    counted = df.agg(F.count("*").alias("n_rows"))
    rows = counted.select("n_rows", F.explode(checks).alias("check")).select("n_rows", "check.*")
    skipped = F.col("n_rows") == 0
    report = rows.select(
        F.lit(dataset).alias("dataset"),
        "expectation",
        "column",
        F.when(skipped, "skipped")
        .when(F.col("ok"), "passed")
        .otherwise("failed")
        .alias("status"),
        F.when(~skipped, F.col("ok")).alias("success"),
        "n_rows",
        F.when(~skipped & ~F.col("ok"), F.concat(F.lit("no column "), "column")).alias("detail"),
    )
    if on_fail == "raise":
        missing = [r["detail"] for r in failures(report).collect()]  # one row per expectation
        if missing:
            raise QualityError(f"{dataset}: {'; '.join(missing)}")
    return report


def validate_files(
    found: DataFrame, dataset: str, expectations: Sequence[Expectation], on_fail: str = "report"
) -> DataFrame:
    """One report row per file and expectation, from what each file really holds.

    ``found`` has ``file``, ``columns`` and ``n_rows``. A file without rows is
    ``skipped``. Rows are as in ``validate``, with ``file``.
    """
    if on_fail not in ("report", "raise"):
        raise ValueError(f"unknown on_fail {on_fail!r}")
    checks = F.array(*[F.struct(F.lit(e.name).alias("expectation"), F.lit(e.column).alias("column")) for e in expectations])
    rows = found.select("file", "columns", "n_rows", F.explode(checks).alias("check")).select("*", "check.*")
    ok, skipped = F.array_contains("columns", F.col("column")), F.col("n_rows") == 0
    report = rows.select(
        F.lit(dataset).alias("dataset"), "file", "expectation", "column",
        F.when(skipped, "skipped").when(ok, "passed").otherwise("failed").alias("status"),
        F.when(~skipped, ok).alias("success"), "n_rows",
        F.when(~skipped & ~ok, F.concat(F.lit("no column "), "column")).alias("detail"),
    )
    if on_fail == "raise":
        missing = [f"{r['file']}: {r['detail']}" for r in failures(report).limit(20).collect()]
        if missing:
            raise QualityError(f"{dataset}: {'; '.join(missing)}")
    return report


def failures(report: DataFrame) -> DataFrame:
    return report.where(~F.col("success"))


def passed(report: DataFrame) -> DataFrame:
    """One row per dataset: whether nothing failed. Skipped checks do not fail."""
    all_good = F.coalesce(F.bool_and("success"), F.lit(True))
    return report.groupBy("dataset").agg(all_good.alias("success"), F.count("*").alias("n_checks"))
