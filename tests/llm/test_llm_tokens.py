import random
import time
import zlib
from itertools import product

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import elias_fano, packing, piece_lattice, token_shards
from skyledger.llm.tokens import Encoder, default_path
from skyledger.session import work_dir

PARTS = [" ", " ", "  ", "\n", "\t", "\r\n", "a", "Bc", "é", "'s", "'", "1", "23", "²", ".", ",", "!!", "$", "日", "́", "_", "-", "😀", "ß", "\xa0", "\x85", "\x1c", "<|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Encoder(default_path()).library


def ids_of(library, text, end):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_units_give_the_library_s_ids(library):
    draw = random.Random(5)
    mixed = ["".join(draw.choices(PARTS, k=draw.randint(0, 14))) for _ in range(3000)]
    for encoder in (Encoder(default_path()), Encoder(default_path(), kept_units=50, kept_pieces=20)):
        texts = [*cases.texts(), *mixed]
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("values", [[], [0], [0, 0, 0], [5], [0, 1, 2, 3], [7, 7, 900, 2**40, 2**62], list(range(0, 9000, 3))])
def test_elias_fano_selects(values):
    reader = elias_fano.Reader(elias_fano.encode(np.array(values, np.uint64)) + b"more")
    assert reader.all().tolist() == values
    assert [reader.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        reader.select(len(values))


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(1).integers(1, 2000, 20_000))
    assert len(elias_fano.encode(ends)) * 8 < 20_000 * (2 + np.log2(ends[-1] / 20_000) + 1.5)


@pytest.mark.parametrize("shard_tokens", [1, 700, 1 << 24])
def test_shards_read_back(spark, library, shard_tokens):
    rows = [*((k * 3 - 20, t) for k, t in enumerate(cases.texts())), (None, "no id"), (None, None), (4, "b"), (4, "b"), (2**62, "far")]
    path = work_dir(spark, "test-shards")
    token_shards.write(cases.documents(spark, rows), path, shard_tokens=shard_tokens)
    got = token_shards.read(spark, path).orderBy("start").collect()
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    want = sorted((str(d), len(x), zlib.crc32(x.tobytes())) for d, t in rows for x in [ids_of(library, t, 2)])
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    shard = token_shards.Shard(bytes(spark.read.parquet(path).orderBy("part", "seq").first()["shard"]))
    assert [shard.doc_id(i) for i in range(shard.n)] == ids[: shard.n]
    assert [zlib.crc32(shard.doc(i).astype("<u4").tobytes()) for i in range(shard.n)] == [r["ids_crc32"] for r in got[: shard.n]]


def test_no_documents_no_shards(spark):
    path = work_dir(spark, "test-shards")
    token_shards.write(cases.empty(spark), path)
    assert token_shards.read(spark, path).count() == 0


@pytest.mark.parametrize("block_tokens", [1, 3000, 1 << 22])
def test_packing_places_each_id_once(spark, library, block_tokens):
    rows = [*enumerate(cases.texts()), (None, "no id"), (None, "none")]
    pieces = packing.pack(cases.documents(spark, rows), block_tokens=block_tokens).toPandas()
    want = {k: ids_of(library, t, 1) for k, t in rows if k is not None}
    for doc_id, own in pieces[pieces.doc_id.notna()].groupby("doc_id"):
        at = 0
        for p in own.sort_values("start").itertuples():
            assert p.start == at and p.doc_tokens == len(want[doc_id])
            assert p.ids_crc32 == zlib.crc32(want[doc_id][at : at + p.length].tobytes())
            at += p.length
        assert at == len(want.pop(doc_id))
    assert not want
    assert pieces[pieces.doc_id.isna()].length.sum() == sum(len(ids_of(library, t, 1)) for k, t in rows if k is None)
    for _, own in pieces.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]]
        assert own.length.sum() == own.tier.iloc[0] and own.tier.nunique() == 1 and own.step_group.nunique() == 1
        assert own.tier.iloc[0] <= 2048 and own.tier.iloc[0].bit_count() == 1
    assert pieces.groupby("step_group").length.sum().max() <= packing.GROUP_TOKENS


def test_packing_short_documents_takes_time_in_proportion():
    draw = random.Random(9)

    def seconds(n):
        packer, sizes = packing.Packer(), [draw.randint(1, 8) for _ in range(n)]
        begin = time.process_time()
        full = [w for doc, size in enumerate(sizes) for w in packer.add(doc, size)]
        windows = [*full, *packer.pack(), *packer.close()]
        took = time.process_time() - begin
        assert sum(p[0] for _, w in windows for p in w) == sum(sizes)
        assert all(sum(p[0] for p in w) == tier and tier.bit_count() == 1 for tier, w in windows)
        return took

    assert seconds(400_000) < 12 * max(seconds(100_000), 0.05)


def test_packing_needs_powers_of_two_and_rows(spark):
    with pytest.raises(ValueError):
        packing.pack(cases.empty(spark), tiers=(100, 200))
    assert packing.pack(cases.empty(spark)).count() == 0


def test_pieces_equal_the_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    hard = ["a  b   c\n\n d \t e", "  lead", "trail  \n ", "日本語😀 ﷽ é x", "a" * 200 + " " + "ab" * 100, "<s> <unk> <0x41> ▁ ▁▁x", "\t\r\n", " ", "ﬁ ǅ  xx\n  yy"]
    rows = [*enumerate([*cases.texts(), *hard]), (None, "no id"), (1, "again"), (1, "again")]
    model = piece_lattice.load()
    got = piece_lattice.encode(cases.documents(spark, rows), model, block_bytes=3000).collect()
    want = sorted((str(k), library.encode(t or "")) for k, t in rows)
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    literal = {str(k) for k, t in rows if t and "▁" in t}  # the model cannot tell these from spaces
    assert all(r["round_trip"] for r in got if str(r["doc_id"]) not in literal)
    assert piece_lattice.decode(library.encode("Tea for  two\n"), model) == "Tea for  two\n"
    assert piece_lattice.encode(cases.empty(spark), model).count() == 0


def test_viterbi_finds_the_best_path(spark):
    draw = random.Random(2)
    texts = [c for c in "abc"] + ["".join(x) for n in (2, 3) for x in product("abc", repeat=n) if draw.random() < 0.4]
    pieces = tuple((p, k + 1, -draw.random() * 8 * len(p) ** 0.5) for k, p in enumerate(texts))
    model = piece_lattice.Model(pieces, (), 0, False, ("?", *texts))
    table = {p: (s, k) for p, k, s in pieces}
    least = min(s for _, _, s in pieces) - 10.0

    def best(word):
        if not word:
            return 0.0, []
        ways = []
        for n in range(1, min(3, len(word)) + 1):
            s, k = table.get(word[-n:], (least, 0) if n == 1 else (None, None))
            if s is not None:
                b = best(word[:-n])
                ways.append((b[0] + s, [*b[1], k]))
        return max(ways)

    words = ["".join(draw.choices("abcx", k=draw.randint(1, 9))) for _ in range(80)]
    frame = spark.createDataFrame([(w,) for w in words], "word string")
    for r in piece_lattice.encode_words(frame, model).collect():
        assert list(r["ids"]) == best(r["word"])[1], r["word"]
