"""SentencePiece encoding and decoding over a relational lattice of the distinct words.

Texts are cut into words where no piece of the model reaches across. Substrings
of each distinct word, up to the longest piece, are exploded and joined to the
piece table; the matches of a word are its edges. A fold over them gives its
ids: for a unigram model the best path (Viterbi) by an ``aggregate`` along the
word; for a BPE model, whose ids are not the path of best score, an
``aggregate`` that joins the best-ranked pair of neighbours at each step, on a
bit mask of the cuts that are left. Characters without a piece become byte ids
where the model has them.

Documents do not travel: a task keeps blocks of them as numbers into a list of
the block's distinct words, and only those words are looked up.

Defined results: a null or empty text has no ids; white space is kept as it is,
and a leading one is added, as the model files here say; a null or repeated
``doc_id`` is carried as it is; an empty table gives an empty result; extra
columns are ignored. Words over ``LONGEST`` characters, which do not fit the
mask, go through the same joining of pairs in a task of their own.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stored

SPACE = "▁"
#: Words up to this length fit the mask of a long.
LONGEST = 62
#: Bytes of text in a block.
BLOCK_BYTES = 1 << 25
#: A piece table is broadcast; models with more pieces are refused.
MOST_PIECES = (1 << 20) - 1
#: Stands for the id of a character without a piece.
NO_PIECE = (1 << 20) - 1


@dataclass(frozen=True)
class Model:
    pieces: tuple[tuple[str, int, float], ...]  # text, id, score
    byte_ids: tuple[int, ...]  # of the 256 bytes; empty if the model has none
    unknown: int
    bpe: bool
    texts: tuple[str, ...]  # by id

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    @property
    def ranks(self) -> dict[str, int]:
        return {p: k for k, (p, _, _) in enumerate(sorted(self.pieces, key=lambda x: (-x[2], x[1])))}

    def words(self) -> re.Pattern[str]:
        """Cuts between which every piece stays, as no piece holds a space after another sign."""
        if any(SPACE in p.lstrip(SPACE) for p, _, _ in self.pieces):
            raise ValueError("a piece of this model reaches across words")
        gaps = "".join(c for c in "\n\t\r" if not any(c in p and len(p) > 1 for p, _, _ in self.pieces))
        own = f"|[{gaps}]" if gaps else ""
        return re.compile(f"{SPACE}*[^{SPACE}{gaps}]+|{SPACE}+{own}")


def load(path: str | None = None) -> Model:
    import public_tokenizers
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    path = path or public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    ids = range(sp.get_piece_size())
    plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    as_bytes = {sp.id_to_piece(i): i for i in ids if sp.is_byte(i)}
    byte_ids = tuple(as_bytes[f"<0x{b:02X}>"] for b in range(256)) if len(as_bytes) == 256 else ()
    return Model(
        tuple((sp.id_to_piece(i), i, sp.get_score(i)) for i in plain), byte_ids, sp.unk_id(),
        proto.trainer_spec.model_type == 2, tuple(sp.id_to_piece(i) for i in ids),
    )


# Words to ids


def _piece_table(spark, model: Model) -> DataFrame:
    if len(model.pieces) > MOST_PIECES:
        raise ValueError("too many pieces to broadcast")
    ranks = model.ranks
    rows = pd.DataFrame([(p, ranks[p], s, i) for p, i, s in model.pieces], columns=["piece", "rank", "score", "id"])
    return F.broadcast(spark.createDataFrame(rows, "piece string, rank int, score double, id int"))


def _fallback(char: Column, model: Model) -> Column:
    """The ids of a character without a piece."""
    if not model.byte_ids:
        return F.array(F.lit(model.unknown))
    table = F.array(*[F.lit(i) for i in model.byte_ids])
    codes = F.regexp_extract_all(F.hex(F.encode(char, "UTF-8")), F.lit("(..)"), 1)
    return F.transform(codes, lambda c: F.get(table, F.conv(c, 16, 10).cast("int")))


def _matches(words: DataFrame, model: Model) -> DataFrame:
    """Every piece in a word, and every character without one: ``word``, ``piece``, ``rank``, ``score``, ``id``, ``a``, ``b``.

    The explode and the broadcast join keep words where they are, so grouping
    edges by word needs no second shuffle.
    """
    longest = model.longest
    spots = words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("s"))
    most = F.least(F.lit(longest), F.length("word") - F.col("s") + 1)
    parts = spots.select("word", "s", F.explode(F.sequence(F.lit(1), most)).alias("n"))
    parts = parts.withColumn("piece", F.substr("word", F.col("s"), F.col("n")))
    found = parts.join(_piece_table(words.sparkSession, model), "piece", "left").where((F.col("n") == 1) | F.col("id").isNotNull())
    return found.withColumns({"a": F.col("s") - 1, "b": F.col("s") - 1 + F.col("n")})


def lattice(words: DataFrame, model: Model) -> DataFrame:
    """``(word, edges)``: an edge has its ends ``a`` and ``b``, its ``score`` and its ``ids``."""
    least = min(s for _, _, s in model.pieces)
    edge = F.struct(
        "a", "b", F.coalesce("score", F.lit(least - 10.0)).alias("score"),
        F.when(F.col("id").isNotNull(), F.array("id")).otherwise(_fallback(F.col("piece"), model)).alias("ids"),
    )
    return _matches(words, model).groupBy("word").agg(F.collect_list(edge).alias("edges"))


def packed_lattice(words: DataFrame, model: Model) -> DataFrame:
    """``(word, edges)`` of words up to ``LONGEST``, an edge as one number that sorts by rank, then place.

    From the top: rank, id (``NO_PIECE`` for a character without one), ``a``, ``b``.
    """
    number = lambda c, by: F.call_function("shiftleft", F.col(c).cast("long"), F.lit(by))
    whole = _matches(words, model).withColumns({
        "rank": F.coalesce("rank", F.lit(len(model.pieces))), "id": F.coalesce("id", F.lit(NO_PIECE)),
    })
    edge = number("rank", 32) + number("id", 12) + number("a", 6) + F.col("b").cast("long")
    return whole.groupBy("word").agg(F.collect_list(edge).alias("edges"))


def viterbi(word: Column, edges: Column) -> Column:
    """Ids of the path with the best summed score; of equal paths the one with larger ids."""
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids")))

    def step(best: Column, i: Column) -> Column:
        into = F.filter(edges, lambda e: e["b"] == i)
        paths = F.transform(into, lambda e: F.struct(
            (F.get(best, e["a"])["score"] + e["score"]).alias("score"),
            F.concat(F.get(best, e["a"])["ids"], e["ids"]).alias("ids"),
        ))
        return F.concat(best, F.array(F.array_max(paths)))

    return F.aggregate(F.sequence(F.lit(1), F.length(word)), start, step, lambda best: F.element_at(best, -1)["ids"])


def joined(word: Column, edges: Column, model: Model) -> Column:
    """Ids after joining, again and again, the leftmost best-ranked pair of neighbours.

    ``edges`` are packed; the state is a mask of the cuts left, and the edges of
    more than one character, best first, as masks of their ends and insides.
    """
    one = F.lit(1).cast("long")
    bit = lambda k: F.call_function("shiftleft", one, k)
    part = lambda e, by, bits: F.call_function("shiftright", e, F.lit(by)).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")
    start, end = (lambda e: part(e, 6, 6)), (lambda e: part(e, 0, 6))

    def masks(e: Column) -> Column:
        a, b = start(e), end(e)
        return F.struct((bit(a) + bit(b)).alias("ends"), (bit(b) - bit(a + 1)).alias("inner"), a.alias("a"), part(e, 12, 20).alias("id"))

    all_edges = F.transform(F.array_sort(edges), masks)
    first = F.struct((bit(F.length(word) + 1) - 1).alias("cuts"), all_edges.alias("all"), F.filter(all_edges, lambda e: e["inner"] != 0).alias("pairs"))

    def step(state: Column, _: Column) -> Column:
        cuts = state["cuts"]
        fits = F.filter(state["pairs"], lambda e: (cuts.bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(cuts.bitwiseAND(e["inner"])) == 1))
        inner = F.coalesce(F.get(fits, F.lit(0))["inner"], F.lit(0).cast("long"))
        return F.struct(cuts.bitwiseAND(F.bitwise_not(inner)).alias("cuts"), state["all"].alias("all"), state["pairs"].alias("pairs"))

    def ids(state: Column) -> Column:
        cuts = state["cuts"]
        kept = F.filter(state["all"], lambda e: (cuts.bitwiseAND(e["ends"]) == e["ends"]) & (cuts.bitwiseAND(e["inner"]) == 0))
        by_place = F.array_sort(F.transform(kept, lambda e: F.struct(e["a"].alias("a"), e["id"].alias("id"))))
        char = lambda e: F.substr(word, e["a"] + 1, F.lit(1))
        return F.flatten(F.transform(by_place, lambda e: F.when(e["id"] != NO_PIECE, F.array(e["id"])).otherwise(_fallback(char(e), model))))

    return F.aggregate(F.sequence(F.lit(1), F.length(word)), first, step, ids)


def join_pairs(word: str, ranks: dict[str, int]) -> list[str]:
    """The same joining for one long word, with a heap."""
    n = len(word)
    nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [1] * n  # alive: length, 0 if joined away
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = nxt[i]
        if i >= 0 and j < n:
            r = ranks.get(word[i : j + alive[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, alive[i], alive[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, x, y = heapq.heappop(heap)
        j = nxt[i]
        if alive[i] != x or j >= n or alive[j] != y or not x:
            continue
        alive[i], alive[j] = x + y, 0
        nxt[i] = nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
        offer(i)
        if prv[i] >= 0:
            offer(prv[i])
    return [word[i : i + alive[i]] for i in range(n) if alive[i]]


def _long_words(words: DataFrame, model: Model) -> DataFrame:
    ids = {p: i for p, i, _ in model.pieces}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = model.ranks
        for batch in batches:
            out = []
            for word in batch.column(0).to_pylist():
                row: list[int] = []
                for p in join_pairs(word, ranks):
                    row += [ids[p]] if p in ids else [model.byte_ids[b] for b in p.encode()] if model.byte_ids else [model.unknown]
                out.append(row)
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.int32()))], names=["word", "ids"])

    return words.mapInArrow(run, "word string, ids array<int>")


def encode_words(words: DataFrame, model: Model) -> DataFrame:
    """``(word, ids)`` of each distinct non-empty ``word``; spaces are written as the model writes them."""
    words = words.select("word").distinct()
    if not model.bpe:
        return lattice(words, model).select("word", viterbi(F.col("word"), F.col("edges")).alias("ids"))
    short = packed_lattice(words.where(F.length("word") <= LONGEST), model)
    short = short.select("word", joined(F.col("word"), F.col("edges"), model).alias("ids"))
    return short.union(_long_words(words.where(F.length("word") > LONGEST), model))


# Texts to blocks of words, and back


def _blocks(docs: DataFrame, pattern: re.Pattern[str], block_bytes: int) -> DataFrame:
    """Blocks of documents: their distinct words, and each text as numbers into them, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        words: dict[str, int] = {}
        ids: list = []
        codes: list[np.ndarray] = []
        crcs: list[int] = []
        size = 0

        def out() -> pa.RecordBatch:
            flat = np.concatenate([np.zeros(0, np.uint32), *codes])
            row = [[block], [ids], [list(map(len, codes))], [crcs], [list(words)], [zlib.compress(flat.astype("<u4").tobytes(), 1)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary()]
            return pa.record_batch([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["block", "doc_ids", "sizes", "crcs", "words", "codes"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                found = pattern.findall(SPACE + text.replace(" ", SPACE)) if text else []
                ids.append(doc_id)
                crcs.append(zlib.crc32(text.encode("utf-8", "surrogatepass")))
                codes.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.uint32, len(found)))
                size += len(text)
                if size >= block_bytes:
                    yield out()
                    block, words, ids, codes, crcs, size = block + 1, {}, [], [], [], 0
        if ids:
            yield out()

    return stored(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "block long, doc_ids array<long>, sizes array<int>, crcs array<long>, words array<string>, codes binary"
    ), "blocks")


def decode(ids: list[int] | np.ndarray, model: Model) -> str:
    """The text of ids."""
    return _decoder(model)(ids)


def _decoder(model: Model):
    names = [t.replace(SPACE, " ").encode() for t in model.texts]
    for b, i in enumerate(model.byte_ids):
        names[i] = bytes([b])

    def run(ids) -> str:
        text = b"".join([names[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text

    return run


def encode(docs: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and whether they decode to the text (``round_trip``)."""
    blocks = _blocks(docs, model.words(), block_bytes)
    places = blocks.select("block", F.posexplode("words").alias("place", "word"))
    known = stored(encode_words(places.select("word"), model), "words")
    looked = stored(places.join(known, "word").select("block", "place", "ids"), "looked")
    # A block's words are bounded by its bytes.
    lists = looked.groupBy("block").agg(F.collect_list(F.struct("place", "ids")).alias("found"))
    rows = blocks.drop("words").join(lists, "block", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = _decoder(model)
        for batch in batches:
            for row in range(batch.num_rows):
                doc_ids, sizes, crcs, raw, found = (batch.column(k).slice(row, 1) for k in range(5))
                flat = found.flatten()
                place = flat.field("place").to_numpy().astype(np.int64) if len(flat) else np.zeros(0, np.int64)
                lists = flat.field("ids") if len(flat) else pa.array([], pa.list_(pa.int32()))
                pieces, lengths = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
                starts = np.empty(len(place), np.int64)
                counts = np.empty(len(place), np.int64)
                starts[place], counts[place] = np.cumsum(lengths) - lengths, lengths
                codes = np.frombuffer(zlib.decompress(raw[0].as_py()), "<u4").astype(np.int64)
                at, ids = 0, []
                for size in sizes[0].as_py():
                    own = codes[at : at + size]
                    at += size
                    n = counts[own]
                    shift = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    ids.append(pieces[np.repeat(starts[own], n) + shift])
                same = [zlib.crc32(text_of(x.tolist()).encode("utf-8", "surrogatepass")) == c for x, c in zip(ids, crcs[0].as_py(), strict=True)]
                ends = np.cumsum([0, *map(len, ids)])
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32()))
                yield pa.record_batch(
                    [doc_ids.flatten(), pa.array(np.diff(ends), pa.int64()), column, pa.array(same, pa.bool_())],
                    names=["doc_id", "n_tokens", "ids", "round_trip"],
                )

    return rows.select("doc_ids", "sizes", "crcs", "codes", "found").mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, round_trip boolean"
    )
