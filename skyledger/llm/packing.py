"""Packs token ids into sequences of several context sizes with almost no padding.

Each task packs its own documents block by block, so nothing is shuffled and
memory stays near one block of ids. A document longer than the largest context
gives full windows; what remains goes to the smallest tier that holds it. Tiers
are packed from long to short: a document opens a window of its tier, the gap
takes the largest shorter documents that fit, and last a cut piece of one. A
window that stays open hands its pieces to the next block; at a task's end the
leftovers are cut at powers of two, which need no padding. Sequences are dealt
to step groups of equal token counts, longest first.

Defined results: a null text is empty; an empty document still has its end id;
null and repeated ``doc_id`` values are carried as they are, each row packed by
itself; an empty table gives no pieces; extra columns are ignored.
``sequence_id`` holds the task in its upper bits; which rows share a sequence
depends on how the table is split into tasks, their ids and pieces do not.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import default_path, encoder

TIERS = (256, 512, 1024, 2048)
BLOCK_TOKENS, GROUP_TOKENS = 1 << 22, 1 << 15
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, tier long, step_group long"
)
_ARROW = pa.schema([(f.split()[0], pa.int64()) for f in SCHEMA.split(", ")])

Piece = tuple[int, int, int]  # length, document, start


class Packer:
    """Packs pieces of documents; ``sequences`` come out as (tier, pieces).

    The pool is one stack for each length, and a number whose set bits are the
    lengths at hand, so that a piece is put in or taken in constant time.
    """

    def __init__(self, tiers: tuple[int, ...] = TIERS) -> None:
        self.tiers = tuple(sorted(tiers))
        self.pool: list[list[Piece]] = [[] for _ in range(self.tiers[-1])]  # by length
        self.lengths = 0

    def add(self, doc: int, tokens: int) -> Iterator[tuple[int, list[Piece]]]:
        """Full windows of a document; the rest waits in the pool."""
        top = self.tiers[-1]
        for k in range(tokens // top):
            yield top, [(top, doc, k * top)]
        if tokens % top:
            self._put((tokens % top, doc, tokens // top * top))

    def _put(self, piece: Piece) -> None:
        self.pool[piece[0]].append(piece)
        self.lengths |= 1 << piece[0]

    def _take(self, n: int) -> Piece:
        stack = self.pool[n]
        piece = stack.pop()
        if not stack:
            self.lengths ^= 1 << n
        return piece

    def _longest(self, most: int) -> int:
        """The greatest length at hand up to ``most``; 0 if there is none."""
        return max(0, (self.lengths & (2 << most) - 1).bit_length() - 1)

    def _shortest(self) -> int:
        return (self.lengths & -self.lengths).bit_length() - 1

    def pack(self) -> Iterator[tuple[int, list[Piece]]]:
        """Windows filled from the pool, long tiers first; what fills none goes back."""
        back: list[Piece] = []
        for under, tier in reversed(list(zip((0, *self.tiers), self.tiers, strict=False))):
            while (n := self._longest(tier)) > under:
                window, gap = [self._take(n)], tier - n
                while gap and self.lengths:
                    if n := self._longest(gap):
                        piece = self._take(n)
                    else:  # all are longer: cut the shortest
                        n, doc, start = self._take(self._shortest())
                        piece = (gap, doc, start)
                        self._put((n - gap, doc, start + gap))
                    window.append(piece)
                    gap -= piece[0]
                if gap:
                    back += window
                else:
                    yield tier, window
        for piece in back:
            self._put(piece)

    def close(self) -> Iterator[tuple[int, list[Piece]]]:
        """The leftovers in sequences as long as a power of two, at most the largest tier."""
        rest = [piece for stack in reversed(self.pool) for piece in stack]
        left = sum(p[0] for p in rest)
        self.pool, self.lengths = [[] for _ in self.pool], 0
        while left:
            size = min(self.tiers[-1], 1 << left.bit_length() - 1)
            left -= size
            window, gap = [], size
            while gap:
                n, doc, start = rest.pop()
                window.append((min(n, gap), doc, start))
                if n > gap:
                    rest.append((n - gap, doc, start + gap))
                gap -= min(n, gap)
            yield size, window


def _rows(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, tiers: tuple[int, ...],
    block_tokens: int, group_tokens: int,
) -> Iterator[pa.RecordBatch]:
    encode = encoder(path).encode
    packer, docs, next_doc, held = Packer(tiers), {}, 0, 0
    base = TaskContext.get().partitionId() << 40
    sequence, group = base, base
    ready: list[tuple[int, list[Piece]]] = []
    left: dict[int, int] = {}  # ids of a document not yet in a sequence

    def emit() -> pa.RecordBatch:
        nonlocal sequence, group
        rows, filled = [], 0
        for tier, pieces in sorted(ready, key=lambda s: -s[0]):
            offset = 0
            for n, doc, start in pieces:
                doc_id, ids, tokens = docs[doc]
                crc = zlib.crc32(memoryview(ids)[4 * start : 4 * (start + n)])
                rows.append((doc_id, start, n, crc, tokens, sequence, offset, tier, group + filled // group_tokens))
                offset += n
                left[doc] -= n
                if not left[doc]:
                    del docs[doc], left[doc]
            sequence += 1
            filled += tier
        group += -(-filled // group_tokens)
        ready.clear()
        columns = zip(*rows, strict=True) if rows else [[]] * len(_ARROW)
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns], schema=_ARROW)

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            texts = encode(part.column(1).to_pylist())
            for doc_id, ids in zip(part.column(0).to_pylist(), texts, strict=True):
                tokens = len(ids) + 1
                docs[next_doc] = (doc_id, np.append(ids, end_id).astype("<u4").tobytes(), tokens)
                left[next_doc] = tokens
                ready += packer.add(next_doc, tokens)
                next_doc, held = next_doc + 1, held + tokens
            if held >= block_tokens:
                ready += packer.pack()
                yield emit()
                held = 0
    ready += packer.pack()
    ready += packer.close()
    yield emit()


def pack(
    docs: DataFrame, *, path: str | None = None, end_id: int = 1, tiers: tuple[int, ...] = TIERS,
    block_tokens: int = BLOCK_TOKENS, group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece of ``docs`` (``doc_id``, ``text``): where it lies in which sequence.

    ``tiers`` are powers of two; ``group_tokens`` is a multiple of the largest.
    """
    if any(t & (t - 1) for t in tiers) or group_tokens % max(tiers):
        raise ValueError("tiers must be powers of two that divide group_tokens")
    path = path or default_path()
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        lambda batches: _rows(batches, path, end_id, tiers, block_tokens, group_tokens), SCHEMA
    )
