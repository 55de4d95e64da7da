"""Facts about images, and a hook for reading text off them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import base_name, colour_mode, pixel_sample

Rows = Sequence[tuple[Any, ...]]
Engine = Callable[[Rows], Iterable[Any]]

SUCCESS = "SUCCESS"
UNDECODABLE = "ERROR: undecodable"


def image_metadata(images: DataFrame, image_col: str = "image") -> DataFrame:
    """Name, decode status, size, channels, mode and pixel sample of a ``read_images`` frame.

    An undecodable file gives null numbers, an empty sample and an error
    status. Other columns stay. The pictures never leave the executors.
    """
    image = F.col(image_col)
    good = image["mode"] >= 0
    others = [c for c in images.columns if c != image_col]
    return images.select(
        *others,
        base_name(image["origin"]).alias("file_name"),
        F.when(good, F.lit(SUCCESS)).otherwise(F.lit(UNDECODABLE)).alias("decode_status"),
        F.when(good, image["height"]).alias("height"),
        F.when(good, image["width"]).alias("width"),
        F.when(good, image["nChannels"]).alias("n_channels"),
        F.when(good, colour_mode(image)).alias("mode"),
        F.when(good, pixel_sample(image)).otherwise(F.lit("")).alias("pixel_data"),
    )


def extract_text(
    df: DataFrame, fn: Callable[..., str], inputs: Sequence[str], out: str = "ocr_text",
    status: str = "decode_status",
) -> DataFrame:
    """Run a user's reader on each row: ``fn(*inputs)`` gives the text in ``out``.

    A row whose call fails gets empty text and ``ERROR: <message>`` in
    ``status``; a row that already has an error status is not called. ``inputs``
    are dropped from the result. Rows go to Python in Arrow batches bounded by
    ``spark.sql.execution.arrow.maxBytesPerBatch``, so big inputs make short batches.
    """

    def read(rows: Rows) -> list[str | Exception]:
        return [_tried(fn, row) for row in rows]

    return _with_text(df, lambda: read, inputs, out, status)


def extract_text_in_batches(
    df: DataFrame, start: Callable[[], Engine], inputs: Sequence[str], out: str = "ocr_text",
    status: str = "decode_status",
) -> DataFrame:
    """``extract_text`` with a reader that is costly to start or reads many rows at once.

    ``start()`` makes the reader, once in each Python worker, however many tasks
    that worker is given. The reader takes the input tuples of one Arrow batch
    and gives as many texts, in order; an exception in a text's place is that
    row's error. If it raises, its rows are tried one by one, so one bad row does
    not spoil its batch.
    """
    key = uuid.uuid4().hex

    def begin() -> Engine:
        engine = _started(key, start)

        def alone(*row: Any) -> str | Exception:
            (text,) = engine([row])
            return text

        def read(rows: Rows) -> list[str | Exception]:
            try:
                texts = list(engine(rows))
            except Exception:  # noqa: BLE001 - some row's fault; the rows tell which
                return [_tried(alone, row) for row in rows]
            if len(texts) != len(rows):
                raise ValueError(f"the reader gave {len(texts)} texts for {len(rows)} rows")
            return texts

        return read

    return _with_text(df, begin, inputs, out, status)


_ENGINES: dict[str, Engine] = {}


def _started(key: str, start: Callable[[], Engine]) -> Engine:
    """The reader of this worker; earlier queries' readers are let go."""
    if key not in _ENGINES:
        _ENGINES.clear()
        _ENGINES[key] = start()
    return _ENGINES[key]


def _tried(fn: Callable[..., Any], row: tuple[Any, ...]) -> Any:
    try:
        return fn(*row)
    except Exception as error:  # noqa: BLE001 - the contract is: any failure is a status
        return error


def _with_text(
    df: DataFrame, begin: Callable[[], Callable[[Rows], list[str | Exception]]], inputs: Sequence[str], out: str, status: str
) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name not in (*inputs, out, status)]
    schema = StructType(
        [*kept, StructField(status, StringType()), StructField(out, StringType())]
    )
    names = [f.name for f in kept]
    has_status = status in df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read = begin()
        for batch in batches:
            before = list(batch[status]) if has_status else [None] * len(batch)
            rows = list(zip(*[batch[c] for c in inputs], strict=True))
            asked = [k for k, b in enumerate(before) if b is None or b == SUCCESS]
            results = [(b, "") for b in before]
            for k, text in zip(asked, read([rows[k] for k in asked]), strict=True):
                results[k] = (f"ERROR: {text}", "") if isinstance(text, Exception) else (SUCCESS, text)
            texts = pd.DataFrame(results, columns=[status, out], index=batch.index, dtype=object)
            yield pd.concat([batch[names], texts], axis=1)

    return df.select(*names, *([status] if has_status else []), *inputs).mapInPandas(run, schema)
