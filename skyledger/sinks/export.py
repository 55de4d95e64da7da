"""Landed day folders and plain exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .publish import clustered

# Keep spaces at the ends of text, which the CSV writer drops by default, and double quotes
# inside quotes, so that a backslash is only a backslash.
CSV_OPTIONS = {
    "header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
    "escape": '"',
}
DAY = ("year", "month", "day")


def land(
    df: DataFrame, root: str, dataset: str, fmt: str, ts_col: str, replace_days: bool = False
) -> None:
    """Add raw rows to the day folders of ``ts_col``; ``fmt`` is csv or jsonl.

    ``replace_days`` replaces the days that occur in ``df`` instead of adding
    files to them.
    """
    ts = F.col(ts_col).cast("timestamp_ntz")
    dated = df.withColumns(
        {
            "year": F.date_format(ts, "yyyy"),
            "month": F.date_format(ts, "MM"),
            "day": F.date_format(ts, "dd"),
        }
    )
    writer = clustered(dated, DAY).write.partitionBy(*DAY)
    if replace_days:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    path = f"{root}/{fmt}/{dataset}"
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    else:
        writer.json(path)


def export_csv(df: DataFrame, path: str) -> bool:
    """Write CSV with a header; an empty frame is not written. Returns whether it was."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return True


def export_json(df: DataFrame, path: str) -> None:
    """Write one JSON object per line."""
    df.write.mode("overwrite").json(path)
