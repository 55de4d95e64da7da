"""File scans."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import base_name


# What this library's writers leave apart: an empty field is null, a quoted empty one an empty
# text. Any mark that no file holds makes the reader tell them apart.
BLANKS_STAY = {"nullValue": "\x00"}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None,
    infer: bool = False, line_breaks: bool = True, **options,
) -> DataFrame:
    """CSV with a header row. Without a schema every column is text, unless ``infer`` is set.

    With a schema the header names are checked against it, so a file whose
    columns moved fails instead of filling the wrong columns; ``infer`` costs
    one extra pass over the files. Empty fields, quoted or not, are null;
    ``**BLANKS_STAY`` keeps quoted ones as empty text. Quoted text may hold line breaks, so a file
    is one task; ``line_breaks=False`` splits big files known to have none.
    """
    reader = spark.read.options(header=True, multiLine=line_breaks, escape='"').options(**options)
    if schema is not None:
        return reader.option("enforceSchema", False).schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_json_array(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, **options
) -> DataFrame:
    """Files that each hold one JSON array; one row per element.

    Such a file cannot be split, so it is one task. Land big feeds as many
    files, or as JSON lines.
    """
    reader = spark.read.option("multiLine", True).options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_lines(
    spark: SparkSession, path: str | list[str], schema: StructType | None = None, **options
) -> DataFrame:
    """Files with one JSON object per line; splittable."""
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def exact_path(uri: str) -> str:
    """The path of a file's URI as a reader takes it: decoded, its pattern signs escaped."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def _header_names(head: Column) -> Column:
    """The names of a CSV header line: commas within quotes part nothing, doubled quotes are one."""
    parts = F.split(F.regexp_replace(head, "^\ufeff", ""), ',(?=(?:[^"]*"[^"]*")*[^"]*$)')

    def name(part: Column) -> Column:
        plain = F.trim(part)
        inner = F.replace(F.regexp_extract(plain, '(?s)^"(.*)"$', 1), F.lit('""'), F.lit('"'))
        return F.when(plain.rlike('(?s)^".*"$'), inner).otherwise(plain)

    return F.filter(F.transform(parts, name), lambda c: c != "")


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The header of each CSV file: ``file`` and ``columns``. Rows are not parsed."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), "value", "_metadata.file_block_start",
        F.monotonically_increasing_id().alias("at"),
    )
    head = lines.where("file_block_start = 0").groupBy("file").agg(F.min_by("value", "at").alias("head"))
    return head.select("file", _header_names(F.col("head")).alias("columns"))


def file_columns(spark: SparkSession, path: str | list[str], fmt: str) -> DataFrame:
    """What each file really holds: ``file``, ``columns`` and ``n_rows``.

    CSV: the header line. JSON: all keys of its objects. A scan passes over
    files of no bytes; a file of a header only has no rows.
    """
    if fmt == "csv":
        heads = file_headers(spark, path)
        # One column is enough to count rows, and needs no look into files for more.
        some = spark.read.options(header=True, multiLine=True, escape='"').schema("row string").csv(path)
        counted = some.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n_rows"))
    else:
        kind = "array<map<string,string>>" if fmt == "json" else "map<string,string>"
        texts = spark.read.text(path, wholetext=fmt == "json")
        parsed = texts.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", kind).alias("v"))
        rows = parsed.select("file", F.explode("v").alias("v")) if fmt == "json" else parsed
        rows = rows.where(F.col("v").isNotNull())
        heads = rows.select("file", F.explode(F.map_keys("v")).alias("c")).groupBy("file").agg(
            F.array_sort(F.collect_set("c")).alias("columns")
        )
        counted = rows.groupBy("file").agg(F.count("*").alias("n_rows"))
    found = heads.join(counted, "file", "full_outer")
    return found.select("file", F.coalesce("columns", F.array().cast("array<string>")).alias("columns"), F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))


def read_csv_by_name(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV files whose headers may differ, joined by column name; what a file lacks is null.

    Only one header per file reaches the driver; files of one header are one scan.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for row in file_headers(spark, path).where(F.size("columns") > 0).collect():
        by_header.setdefault(tuple(row["columns"]), []).append(exact_path(row["file"]))
    kinds = {f.name: f.dataType for f in schema.fields}
    parts = [spark.createDataFrame([], schema)]
    for names, files in by_header.items():
        own = StructType([StructField(n, kinds.get(n, StringType())) for n in names])
        parts.append(read_csv(spark, files, own).select(*[F.col(f"`{n}`") for n in names if n in kinds]))
    return union_files(parts).select(*schema.fieldNames())


READERS = {"csv": read_csv, "json": read_json_array, "jsonl": read_json_lines}


def read_day(
    spark: SparkSession, root: str, dataset: str, fmt: str, run_date: date | None,
    schema: StructType | None = None, layout: str = "folders",
) -> DataFrame:
    """One day of a landed dataset, or all days when ``run_date`` is None.

    ``layout="folders"`` is ``root/YYYY/MM/DD/<fmt>/<dataset>/*``; ``"landed"``
    is what :func:`skyledger.sinks.land` writes. The day is part of the path,
    so only its own folder is listed. With a schema, a missing day is empty, and
    CSV files are joined by column name.
    """
    if layout == "landed":
        path = f"{root}/{fmt}/{dataset}"
        if run_date:
            path += f"/year={run_date:%Y}/month={run_date:%m}/day={run_date:%d}"
    else:
        suffix = "csv" if fmt == "csv" else "json"
        day = f"{run_date:%Y/%m/%d}" if run_date else "*/*/*"
        path = f"{root}/{day}/{suffix}/{dataset}/*.{suffix}"
    if schema is None:
        rows = READERS[fmt](spark, path)
    else:
        reader = read_csv_by_name if fmt == "csv" and layout == "folders" else READERS[fmt]
        options = BLANKS_STAY if fmt == "csv" and layout == "landed" else {}
        rows = read_or_empty(spark, lambda: reader(spark, path, schema, **options), schema)
    return rows.drop("year", "month", "day") if layout == "landed" else rows


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Whole files below ``path`` as rows: path, modificationTime, length, content."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
    )


def read_images(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """Images decoded on the executors; an undecodable file has size -1."""
    return spark.read.format("image").option("dropInvalid", drop_invalid).load(path)


def with_file_name(df: DataFrame, out: str = "file_name") -> DataFrame:
    """Add the name of the file each row came from, as in its URI. Call it right on a file scan."""
    return df.withColumn(out, F.col("_metadata.file_name"))


def with_base_name(df: DataFrame, path_col: str, out: str = "file_name") -> DataFrame:
    """Add the last part of a path or URL column."""
    return df.withColumn(out, base_name(F.col(path_col)))


def read_latest(
    spark: SparkSession, root: str, contains: str,
    reader: Callable[[SparkSession, str], DataFrame], glob: str = "*",
) -> DataFrame | None:
    """Read the newest file below ``root`` whose path contains ``contains``; None without one.

    Only paths and times are read to find it, and each task keeps one row.
    ``root`` may be a pattern; the narrower, the fewer folders are listed.
    """
    listing = read_or_empty(
        spark, lambda: read_files(spark, root, glob).select("path", "modificationTime"),
        StructType().add("path", "string").add("modificationTime", "timestamp"),
    )
    newest = (
        listing.where(F.col("path").contains(contains))
        .orderBy(F.desc("modificationTime"), "path")
        .first()
    )
    return None if newest is None else reader(spark, exact_path(newest["path"]))


def read_or_empty(
    spark: SparkSession, reader: Callable[[], DataFrame], schema: StructType
) -> DataFrame:
    """``reader()``, or no rows when its path does not exist. Other errors surface."""
    try:
        return reader()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def union_files(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of same-kind frames; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
