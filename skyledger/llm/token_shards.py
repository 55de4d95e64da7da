"""Token ids as binary shards: one id array, Elias-Fano document boundaries and ids.

A shard is one value of bytes: a head, the document ids and the boundaries as
Elias-Fano sequences (``elias_fano``), then the ids of all its documents as
little-endian 16- or 32-bit numbers. Spark's own Parquet writer stores shards,
one row each, so a lost executor's shards are written again and half-written
ones never show. Documents are dealt by ranges of ``doc_id`` and sorted inside,
so shards in order of (part, seq) hold the corpus in ascending order.

Defined results: a null text is empty and has only its end id; null ids come
first; rows with the same id follow each other in the order of a hash of their
text, then of the text; an empty table gives no shards; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import elias_fano
from .tokens import default_path, encoder

MAGIC = b"SKTS"
_HEAD = struct.Struct("<4sBBIIqI")  # magic, version, id bytes, documents, null ids, first id, bytes of ids' sequence
#: A shard is closed when it holds so many ids.
SHARD_TOKENS = 1 << 24
#: Up to so many shards their starts are broadcast; beyond, they are joined.
MOST_BROADCAST = 100_000
SHARDS = "part int, seq int, n_docs long, n_tokens long, shard binary"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"
_SHARDS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("shard", pa.binary())])
_READ = pa.schema([(f.split()[0], pa.int64()) for f in READ.split(", ")])


def to_shard(doc_ids: list[int | None], ids: list[np.ndarray], kind: np.dtype) -> bytes:
    """Bytes of one shard; ``doc_ids`` rise, nulls first."""
    nulls = sum(d is None for d in doc_ids)
    known = doc_ids[nulls:]
    first = known[0] if known else 0
    names = elias_fano.encode(np.array([d - first for d in known], np.uint64))
    ends = elias_fano.encode(np.cumsum([0, *map(len, ids)]))
    body = np.concatenate([np.zeros(0, kind), *ids]).astype(kind).tobytes()
    return _HEAD.pack(MAGIC, 1, kind.itemsize, len(doc_ids), nulls, first, len(names)) + names + ends + body


class Shard:
    """Reads documents of a shard without unpacking the rest."""

    def __init__(self, raw: bytes) -> None:
        raw = memoryview(raw)
        magic, version, width, self.n, self.nulls, self.first, named = _HEAD.unpack_from(raw)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token shard")
        at = _HEAD.size
        self.names = elias_fano.Reader(raw[at : at + named])
        self.ends = elias_fano.Reader(raw[at + named :])
        self.ids = np.frombuffer(raw[at + named + self.ends.size :], f"<u{width}")

    def doc_id(self, i: int) -> int | None:
        return None if i < self.nulls else self.first + self.names.select(i - self.nulls)

    def doc(self, i: int) -> np.ndarray:
        return self.ids[self.ends.select(i) : self.ends.select(i + 1)]


def write(
    docs: DataFrame, path: str, *, tokenizer: str | None = None, end_id: int = 2,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode ``docs`` (``doc_id``, ``text``), an end id after each, into shards at ``path``."""
    tokenizer = tokenizer or default_path()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        kind = worker.kind
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            row = [[part], [seq], [len(names)], [held], [to_shard(names, ids, kind)]]
            return pa.record_batch([pa.array(v, t.type) for v, t in zip(row, _SHARDS, strict=True)], schema=_SHARDS)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                names += rows.column(0).to_pylist()
                new = [np.append(x, kind.type(end_id)) for x in worker.encode(rows.column(1).to_pylist())]
                ids += new
                held += sum(map(len, new))
                if held >= shard_tokens:
                    yield close()
                    names, ids, held, seq = [], [], 0, seq + 1
        if names:
            yield close()

    order = [F.col("doc_id"), F.xxhash64("text")]
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order, "text")
        .mapInArrow(shards, SHARDS)
        .write.parquet(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shards at ``path``: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    The driver sees one row of counts per shard, to tell where each starts.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    counts = sorted(tuple(r) for r in shards.select("part", "seq", "n_tokens").collect())
    starts = accumulate((n for _, _, n in counts), initial=0)
    firsts = spark.createDataFrame(
        [(p, s, at) for (p, s, _), at in zip(counts, starts, strict=False)], "part int, seq int, first long"
    )

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(raw.as_buffer())
                ends = shard.ends.all()
                names = [None] * shard.nulls + (shard.names.all() + shard.first).tolist()
                body = memoryview(shard.ids.astype("<u4").tobytes())
                crcs = [zlib.crc32(body[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
                columns = [names, ends[:-1] + first, np.diff(ends), crcs]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=_READ)

    if len(counts) <= MOST_BROADCAST:  # three numbers a shard
        firsts = F.broadcast(firsts)
    return shards.join(firsts, ["part", "seq"]).select("first", "shard").mapInArrow(documents, READ)
