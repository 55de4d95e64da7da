"""Pictures to silver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract_text, flight_table_json, image_metadata
from ..sinks import ensure_namespace, publish
from ..sources import read_images, table_exists
from ..streaming.ingest import kept, run_once
from .silver import Layers
from .specs import IMAGE_FLIGHTS_TABLE, IMAGE_TEXT_TABLE

# Columns of the two tables, in table order.
METADATA_TEXT = (
    "file_name", "decode_status", "height", "width", "n_channels", "mode", "pixel_data", "ocr_text",
)
FLIGHT_JSON = ("file_name", "decode_status", "height", "width", "n_channels", "ocr_text")

# What Spark's image source gives.
IMAGE_SCHEMA = "image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>"
IMAGE_FIELDS = ("height", "width", "nChannels", "data")


def _with_text(images: DataFrame, read_text: Callable[..., str] | None) -> DataFrame:
    """Metadata plus the text ``read_text(height, width, channels, bytes)`` finds.

    The bytes are the decoded picture, rows from the top, channels in blue,
    green, red, alpha order.
    """
    if read_text is None:
        return image_metadata(images).withColumn("ocr_text", F.lit(""))
    fields = {f"__{f}": F.col("image")[f] for f in IMAGE_FIELDS}
    return extract_text(
        image_metadata(images.withColumns(fields)), read_text, inputs=tuple(fields)
    )


def image_metadata_with_text(
    images: DataFrame, read_text: Callable[..., str] | None = None
) -> DataFrame:
    """Metadata, pixel sample and text of a ``read_images`` frame; failures null the numbers."""
    rows = _with_text(images, read_text)
    failed = F.col("decode_status") != "SUCCESS"
    numbers = ("height", "width", "n_channels", "mode")
    cleared = {c: F.when(~failed, F.col(c)) for c in numbers}
    cleared["pixel_data"] = F.when(failed, "").otherwise(F.col("pixel_data"))
    return rows.withColumns(cleared).select(*METADATA_TEXT)


def flight_table_ocr_json(
    images: DataFrame, read_text: Callable[..., str] | None = None
) -> DataFrame:
    """Size and parsed flight rows (JSON) of each picture; empty text where reading failed."""
    return _flights_of(image_metadata_with_text(images, read_text))


def _flights_of(rows: DataFrame) -> DataFrame:
    parsed = flight_table_json(rows, "ocr_text")
    text = F.when(F.col("decode_status") == "SUCCESS", F.col("ocr_text")).otherwise("")
    return parsed.withColumn("ocr_text", text).select(*FLIGHT_JSON)


def load_images(
    spark: SparkSession, layers: Layers, read_text: Callable[..., str] | None = None,
    timetable_text: Callable[..., str] | None = None, glob: str = "*/*/*/images/*.jpg",
) -> None:
    """Rebuild both image tables from all days' pictures.

    The two tables may use different readers; ``timetable_text`` defaults to
    ``read_text``.
    """
    ensure_namespace(spark, layers.silver)
    images = read_images(spark, f"{layers.root}/{glob}")
    publish(image_metadata_with_text(images, read_text), f"{layers.silver}.{IMAGE_TEXT_TABLE}")
    flights = flight_table_ocr_json(images, timetable_text or read_text)
    publish(flights, f"{layers.silver}.{IMAGE_FLIGHTS_TABLE}")


def ingest_images(
    spark: SparkSession, layers: Layers, checkpoint: str, read_text: Callable[..., str] | None = None,
    timetable_text: Callable[..., str] | None = None, glob: str = "*/*/*/images/*.jpg",
    files_per_batch: int | None = None,
) -> None:
    """Add the pictures that came since the last run to both image tables.

    Each picture is decoded and read once: the batch is held, and one table made
    of the other's text unless ``timetable_text`` is a reader of its own. The
    tables have the columns of ``load_images``'s and ``batch``, by which they are
    partitioned: a batch that is run again takes the place of what it wrote.
    """
    ensure_namespace(spark, layers.silver)

    def handle(images: DataFrame, batch_id: int) -> None:
        with kept(image_metadata_with_text(images, read_text)) as rows:
            own = timetable_text is None or timetable_text is read_text
            flights = _flights_of(rows) if own else flight_table_ocr_json(images, timetable_text)
            for table, found in ((IMAGE_TEXT_TABLE, rows), (IMAGE_FLIGHTS_TABLE, flights)):
                publish(
                    found.withColumn("batch", F.lit(str(batch_id))), f"{layers.silver}.{table}", mode="replace_slice",
                    partition_by=("batch",), within={"batch": str(batch_id)},
                )

    run_once(spark, f"{layers.root}/{glob}", "image", IMAGE_SCHEMA, checkpoint, files_per_batch, handle)
    # Batches are written from a session of the stream's own; this one's listing of the files is old.
    for table in (IMAGE_TEXT_TABLE, IMAGE_FLIGHTS_TABLE):
        if table_exists(spark, f"{layers.silver}.{table}"):
            spark.catalog.refreshTable(f"{layers.silver}.{table}")
