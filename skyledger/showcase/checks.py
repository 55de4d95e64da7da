"""Quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import Expectation, failures, passed, validate
from ..plans.specs import EXPECTED_COLUMNS
from ..sources import union_files
from .registry import shown
from .standins import table, view


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = [Expectation(c) for c in EXPECTED_COLUMNS["countries"]]
    weather = view(spark, sf_dir, "weather")
    return union_files(
        [
            validate(view(spark, sf_dir, "supplier_countries"), "countries", asked),
            validate(weather, "weather", [Expectation("city"), Expectation("weather_desc")]),
            validate(
                table(spark, sf_dir, "orders").where("o_totalprice < 0"), "empty",
                [Expectation("o_orderkey"), Expectation("no_such_column")],
            ),
        ]
    )


REPORT_SQL = (
    "WITH counted AS (SELECT (SELECT count(*) FROM supplier) AS suppliers, "
    "(SELECT count(*) FROM events) AS readings), report AS ("
    "SELECT 'countries' AS dataset, col AS \"column\", "
    "CASE WHEN col = 'population2' THEN 'failed' ELSE 'passed' END AS status, "
    "col <> 'population2' AS success, CAST(suppliers AS BIGINT) AS n_rows, "
    "CASE WHEN col = 'population2' THEN 'no column population2' END AS detail "
    "FROM counted, (VALUES ('name'), ('iso2'), ('capital'), ('continent'), ('population2'), ('id')) AS c(col) "
    "UNION ALL SELECT 'weather', col, 'passed', TRUE, readings, NULL "
    "FROM counted, (VALUES ('city'), ('weather_desc')) AS c(col) "
    "UNION ALL SELECT 'empty', col, 'skipped', NULL, 0, NULL "
    "FROM (VALUES ('o_orderkey'), ('no_such_column')) AS c(col))"
)


@shown(
    f"{REPORT_SQL} SELECT * REPLACE (CAST(success AS VARCHAR) AS success), "
    "'expect_column_to_exist' AS expectation FROM report"
)
def validate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _report(spark, sf_dir).withColumn("success", F.col("success").cast("string"))


@shown(f"{REPORT_SQL} SELECT dataset, \"column\", detail FROM report WHERE status = 'failed'")
def failed_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(_report(spark, sf_dir)).select("dataset", "column", "detail")


@shown(
    f"{REPORT_SQL} SELECT dataset, count(*) FILTER (WHERE status = 'failed') = 0 AS success, "
    "CAST(count(*) AS BIGINT) AS n_checks FROM report GROUP BY dataset"
)
def datasets_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passed(_report(spark, sf_dir))
