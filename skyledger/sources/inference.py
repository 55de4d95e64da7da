"""Column types over many CSV files that each look different.

Each value is one bit: whole number, number, time or other text; nothing is no
bit. The bits of a column are folded with OR, task by task and file by file, in
any order, and the type is read off the fold: the narrowest that holds all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .files import exact_path, file_headers, read_csv, read_csv_by_name

WHOLE, REAL, TIME, TEXT = 1, 2, 4, 8


def type_bit(value: Column) -> Column:
    """The bit of a text value; 0 for null and blank ones."""
    plain = F.trim(value)
    whole = plain.rlike(r"^[+-]?\d+$") & plain.try_cast("bigint").isNotNull()
    real = plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    time = plain.rlike(r"^\d{4}-\d\d?-\d\d?([ T].*)?$") & plain.try_cast("timestamp").isNotNull()
    empty = value.isNull() | (plain == "")
    return F.when(empty, 0).when(whole, WHOLE).when(real, REAL).when(time, TIME).otherwise(TEXT)


def type_of_bits(bits: int) -> str:
    """The narrowest type of values with these bits; a column of nothing is text."""
    if bits & TEXT or bits & TIME and bits & (WHOLE | REAL) or not bits:
        return "string"
    return "timestamp" if bits & TIME else "double" if bits & REAL else "bigint"


def file_types(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``column`` and ``bits`` of each column of each CSV file with rows.

    Files of one header are one scan with partial aggregates; headers reach the driver.
    """
    return _file_types(spark, _by_header(spark, path))


def _by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    found: dict[tuple[str, ...], list[str]] = {}
    for row in file_headers(spark, path).where(F.size("columns") > 0).collect():
        found.setdefault(tuple(row["columns"]), []).append(exact_path(row["file"]))
    return found


def _file_types(spark: SparkSession, by_header: dict[tuple[str, ...], list[str]]) -> DataFrame:
    parts = [spark.createDataFrame([], "file string, column string, bits int")]
    for names, files in by_header.items():
        rows = read_csv(spark, files, StructType([StructField(n, StringType()) for n in names]))
        bits = [F.bit_or(type_bit(F.col(f"`{n.replace('`', '``')}`"))).alias(f"bits{k}") for k, n in enumerate(names)]
        folded = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*bits)
        pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"bits{k}").alias("bits")) for k, n in enumerate(names)])
        parts.append(folded.select("file", F.explode(pairs).alias("p")).select("file", "p.*"))
    return reduce(DataFrame.unionByName, parts)


def read_csv_folded(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files joined by column name, each column in the narrowest type that holds it in all files.

    Whole numbers and numbers meet as double; times and numbers, or anything and
    other text, as string. What a file lacks is null, and so are blank fields of
    columns that are not text. One pass folds the types, one reads the rows.
    """
    by_header = _by_header(spark, path)
    bits = {name: 0 for names in by_header for name in names}
    folds = _file_types(spark, by_header).groupBy("column").agg(F.bit_or("bits").alias("bits"))
    bits |= {row["column"]: row["bits"] for row in folds.collect()}  # one row per column
    texts = read_csv_by_name(spark, path, StructType([StructField(n, StringType()) for n in bits]))
    columns = []
    for name, found in bits.items():
        column, kind = F.col(f"`{name.replace('`', '``')}`"), type_of_bits(found)
        columns.append((column if kind == "string" else F.trim(column).try_cast(kind)).alias(name))
    return texts.select(*columns)
