"""Queries over text and images."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import base_name
from ..operators import extract_text, extract_text_in_batches, flight_table_json, image_metadata, parse_flight_table
from ..plans import images as image_plans
from ..plans.silver import Layers
from ..plans.specs import IMAGE_FLIGHTS_TABLE, IMAGE_TEXT_TABLE
from ..session import work_dir
from ..sinks import ensure_namespace
from ..sources import read_files, read_images
from .registry import shown
from .standins import table

SPACE = (
    "[\\x{9}-\\x{d}\\x{1c}-\\x{20}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"
)
LINES_SQL = (
    "WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents), "
    "tokens AS (SELECT doc_id, list_filter(string_split_regex(line, '" + SPACE + "'), lambda x: x <> '') "
    "AS p FROM lines), rows AS (SELECT doc_id, p[1] AS Flight, p[2] AS Airline, p[3] AS \"From\", "
    "p[4] AS \"To\", array_to_string(p[5:len(p) - 2], ' ') AS Aircraft, "
    "replace(p[len(p) - 1], 'km', '') AS Distance, p[len(p)] AS Status FROM tokens WHERE len(p) >= 7)"
)


@shown(f"{LINES_SQL} SELECT * FROM rows")
def flight_rows_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_flight_table(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


JSON_SQL = (
    "SELECT doc_id, CAST(to_json(list_transform(list_filter(list_transform("
    "string_split(text, chr(10)), lambda l: list_filter(string_split_regex(l, '" + SPACE + "'), "
    "lambda x: x <> '')), lambda p: len(p) >= 7), lambda p: struct_pack(Flight := p[1], "
    "Airline := p[2], \"From\" := p[3], \"To\" := p[4], "
    "Aircraft := array_to_string(p[5:len(p) - 2], ' '), "
    "Distance := replace(p[len(p) - 1], 'km', ''), Status := p[len(p)]))) AS VARCHAR) "
    "AS ocr_text FROM documents"
)


@shown(JSON_SQL)
def flight_json_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flight_table_json(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


@shown(
    "SELECT page_id, CASE WHEN regexp_matches(html, '<title>([^<]*)</title>') THEN 'SUCCESS' "
    "ELSE 'ERROR: no title' END AS decode_status, "
    "regexp_extract(html, '<title>([^<]*)</title>', 1) AS ocr_text FROM pages"
)
def text_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's reader on every page; pages it cannot read get a status."""

    # Readers are local functions, so they travel to the executors by value.
    def title(html: str) -> str:
        found = re.search("<title>([^<]*)</title>", html)
        if not found:
            raise ValueError("no title")
        return found.group(1)

    return extract_text(table(spark, sf_dir, "pages").select("page_id", "html"), title, ["html"])


@shown(
    "SELECT page_id, CASE WHEN regexp_matches(html, '<title>([^<]*)</title>') THEN 'SUCCESS' "
    "ELSE 'ERROR: no title' END AS decode_status, "
    "CASE WHEN regexp_matches(html, '<title>([^<]*)</title>') THEN '1 ' ELSE '' END || "
    "regexp_extract(html, '<title>([^<]*)</title>', 1) AS ocr_text FROM pages"
)
def reader_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that is started once a worker; its texts tell how often their worker has started it."""
    counter = f"SKYLEDGER_STARTS_{uuid.uuid4().hex}"

    def start() -> Callable[[Sequence[tuple]], list]:
        # The environment belongs to the worker's process and outlives its tasks.
        os.environ[counter] = str(int(os.environ.get(counter, "0")) + 1)
        title = re.compile("<title>([^<]*)</title>")

        def read(rows: Sequence[tuple]) -> list:
            found = [title.search(html) for (html,) in rows]
            return [f"{os.environ[counter]} {m.group(1)}" if m else ValueError("no title") for m in found]

        return read

    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    # Four tasks for each core: every worker is given several.
    pages = pages.repartition(4 * spark.sparkContext.defaultParallelism)
    return extract_text_in_batches(pages, start, ["html"])


def _le(value: Column, size: int) -> Column:
    """Little-endian hex of a number."""
    digits = F.lpad(F.hex(value), size * 2, "0")
    return F.concat(*[F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))])


def _bitmap(key: Column, width: Column, height: Column) -> Column:
    """A 24-bit bitmap file of one row of pixels repeated: pixel x is (key, x, 7) mod 100."""
    padding = (F.lit(4) - width * 3 % 4) % 4
    pixel = F.transform(
        F.sequence(F.lit(0), width - 1),
        lambda x: F.concat(F.lit("07"), _le(x % 100, 1), _le(key % 100, 1)),
    )
    row = F.concat(F.array_join(pixel, ""), F.repeat(F.lit("00"), padding.cast("int")))
    size = (width * 3 + padding) * height
    header = F.concat(
        F.lit("424D"), _le(size + 54, 4), F.lit("00000000"), _le(F.lit(54), 4),
        _le(F.lit(40), 4), _le(width, 4), _le(height, 4), F.lit("01001800"), F.lit("00000000"),
        _le(size, 4), F.repeat(F.lit("00"), F.lit(16)),
    )
    return F.unhex(F.concat(header, F.repeat(row, height.cast("int"))))


#: Folders that pictures are dealt into where their folder need not tell which they are.
PICTURE_FOLDERS = 64


def picture_files(
    spark: SparkSession, sf_dir: str, path: str | None = None, which: str = "true", named: bool = True
) -> str:
    """One small bitmap per supplier, every seventh spoilt; written by Spark's text sink.

    ``named``: each in a folder that holds its number. Else many share a folder: making,
    renaming and listing a folder for each takes most of the time once they are many.
    """
    path = path or work_dir(spark, "images")
    key = F.col("s_suppkey")
    bitmap = _bitmap(key, key % 5 + 1, key % 3 + 1).cast("string")
    (
        table(spark, sf_dir, "supplier")
        .where(which)
        .select(key.alias("picture"), F.pmod(F.xxhash64(key), F.lit(PICTURE_FOLDERS)).alias("folder"), F.when(key % 7 == 0, F.lit("spoilt")).otherwise(bitmap).alias("value"))
        # Making many files is slow work: give every core its share.
        .repartition(spark.sparkContext.defaultParallelism, "picture")
        .drop("folder" if named else "picture")
        .write.partitionBy("picture" if named else "folder")
        .option("maxRecordsPerFile", 1)
        .text(path)
    )
    return path


def _numbers(rows: DataFrame) -> DataFrame:
    """Sizes as doubles: engines agree on how those show a missing value."""
    return rows.withColumns({c: F.col(c).cast("double") for c in ("height", "width", "n_channels")})


PIXELS_SQL = (
    "(SELECT s_suppkey AS picture, s_suppkey % 7 = 0 AS bad, s_suppkey % 5 + 1 AS w, s_suppkey % 3 + 1 AS h, "
    "'[' || (s_suppkey % 100) || ', 0, 7]' AS p0, ', [' || (s_suppkey % 100) || ', 1, 7]' AS p1 FROM supplier) AS s"
)
SAMPLE_SQL = (
    "'[' || '[' || p0 || CASE WHEN w > 1 THEN p1 ELSE '' END || ']' || "
    "CASE WHEN h > 1 THEN ', [' || p0 || CASE WHEN w > 1 THEN p1 ELSE '' END || ']' ELSE '' END || ']'"
)


@shown(
    "SELECT picture, CASE WHEN bad THEN 'ERROR: undecodable' ELSE 'SUCCESS' END AS decode_status, "
    "CASE WHEN NOT bad THEN CAST(h AS DOUBLE) END AS height, "
    "CASE WHEN NOT bad THEN CAST(w AS DOUBLE) END AS width, "
    "CASE WHEN NOT bad THEN CAST(3 AS DOUBLE) END AS n_channels, CASE WHEN NOT bad THEN 'RGB' END AS mode, "
    f"CASE WHEN bad THEN '' ELSE {SAMPLE_SQL} END AS pixel_data FROM {PIXELS_SQL}"
)
def image_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = read_images(spark, picture_files(spark, sf_dir))
    rows = _numbers(image_metadata(images).drop("file_name"))
    return rows.withColumn("picture", F.col("picture").cast("long"))


@shown(
    "SELECT picture, CASE WHEN bad THEN 'ERROR: undecodable' ELSE 'SUCCESS' END AS decode_status, "
    "CASE WHEN NOT bad THEN CAST(h AS DOUBLE) END AS height, "
    "CASE WHEN NOT bad THEN CAST(w AS DOUBLE) END AS width, CASE WHEN NOT bad THEN CAST(3 AS DOUBLE) END AS n_channels, "
    "CASE WHEN bad THEN '' ELSE '[{\"Flight\":\"A' || (picture % 100) || '\",\"Airline\":\"B\","
    "\"From\":\"JFK\",\"To\":\"LHR\",\"Aircraft\":\"Boeing ' || w || ' x ' || h || "
    "'\",\"Distance\":\"3\",\"Status\":\"landed\"}]' END AS ocr_text "
    f"FROM {PIXELS_SQL}"
)
def image_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flight rows a reader finds on pictures; the picture's number is its folder's name."""

    def timetable(height: int, width: int, channels: int, data: bytes) -> str:
        return f"A{data[2]} B JFK LHR Boeing {width} x {height} {channels}km landed\n\nshort line"

    images = read_images(spark, picture_files(spark, sf_dir))
    folder = F.regexp_extract("image.origin", "picture=([0-9]+)", 1)
    fields = [F.col("image")[f].alias(f) for f in ("height", "width", "nChannels", "mode", "data")]
    named = images.select(F.struct(folder.alias("origin"), *fields).alias("image"))
    rows = _numbers(image_plans.flight_table_ocr_json(named, timetable))
    return rows.select(F.col("file_name").cast("long").alias("picture"), "*").drop("file_name")


@shown(
    "SELECT CASE WHEN picture % 2 = 0 THEN '0' ELSE '1' END AS batch, "
    "CASE WHEN bad THEN 'ERROR: undecodable' ELSE 'SUCCESS' END AS decode_status, "
    "CASE WHEN bad THEN '' ELSE 'read ' || w || ' x ' || h END AS ocr_text, CAST(count(*) AS BIGINT) AS pictures, "
    f"CAST(count(*) AS BIGINT) AS tables FROM {PIXELS_SQL} GROUP BY ALL"
)
def images_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pictures land in two parts; each run adds its own to both tables."""
    root, silver = work_dir(spark, "raw"), f"silver_{uuid.uuid4().hex}"
    ensure_namespace(spark, silver, work_dir(spark, "tables"))
    layers, progress = Layers(root, silver), work_dir(spark, "progress")

    def size(height: int, width: int, channels: int, data: bytes) -> str:
        return f"read {width} x {height}"

    for part in range(2):
        picture_files(spark, sf_dir, f"{root}/2024/01/{part + 5:02}/images", f"s_suppkey % 2 = {part}", named=False)
        image_plans.ingest_images(spark, layers, progress, size, glob="*/*/*/images/*/*.txt")
    text, flights = (spark.table(f"{silver}.{t}") for t in (IMAGE_TEXT_TABLE, IMAGE_FLIGHTS_TABLE))
    by = ["batch", "decode_status"]
    counted = text.groupBy(*by, "ocr_text").agg(F.count("*").alias("pictures"))
    again = flights.groupBy(*by, "height", "width").agg(F.count("*").alias("tables"))
    shown_as = F.when(F.col("height").isNull(), "").otherwise(F.format_string("read %d x %d", "width", "height"))
    return counted.join(again.withColumn("ocr_text", shown_as).drop("height", "width"), [*by, "ocr_text"])


@shown(
    "SELECT source, CAST(count(*) AS BIGINT) AS n, CAST(sum(strlen(text) + 1) AS BIGINT) AS n_bytes "
    "FROM documents GROUP BY source"
)
def bytes_of_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole files as rows: sizes add up to the text that was written, one byte per line end."""
    path = work_dir(spark, "binary")
    documents = table(spark, sf_dir, "documents").select("source", "text")
    documents.write.partitionBy("source").text(path)
    counts = documents.groupBy("source").agg(F.count("*").alias("n"))
    folder = F.regexp_extract("path", "source=([^/]+)/", 1)
    sizes = (
        read_files(spark, path, "*.txt")
        .select(base_name(F.col("path")).alias("file_name"), folder.alias("source"), "length")
        .where(F.col("file_name").startswith("part-"))
        .groupBy("source")
        .agg(F.sum("length").alias("n_bytes"))
    )
    return counts.join(sizes, "source")
