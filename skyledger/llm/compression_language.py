"""Tells a text's language by which language's sample helps most to compress it.

Each language has one raw-content dictionary: excerpts of labelled texts. A text
is brought to lower case, all but its letters becomes single spaces, and it is
compressed with every dictionary in pieces of ``PIECE`` bytes; pieces are
independent, so a long text cannot become its own dictionary. The language of
the smallest sum of sizes is the answer; where the next one is hardly larger,
the answer is rejected.

The fit takes at most ``SAMPLE`` distinct texts a language, picked by a hash of
the text over all labelled documents, and one excerpt of ``EXCERPT`` characters
of each, from a place picked by the hash: the dictionaries together have at most
``LANGUAGES`` times ``SAMPLE`` times ``EXCERPT`` characters, whatever the input.
More than ``LANGUAGES`` languages are an error. Scoring covers whole texts, a
row at a time, and shuffles nothing.

Defined results: rows without ``doc_id``, text or ``lang`` teach nothing; a null
text, one without letters, or any text where nothing was learned is ``und`` with
score 0; equal sizes go to the language with more labelled texts, then to the
smaller name; null and repeated ``doc_id`` values are carried as they are;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import held_out

SAMPLE, EXCERPT, LANGUAGES = 256, 512, 1000
LEVEL, PIECE = 9, 512
#: An answer is rejected if the next language needs less than this share of bytes more.
MARGIN = 0.01
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")
SCHEMA = "doc_id long, lang_pred string, score double, margin double, rejected boolean"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("margin", pa.float64()), ("rejected", pa.bool_()),
])


def letters(text: str) -> bytes:
    """The text's words in lower case, one space between them; empty if it has no letter."""
    plain = _OTHER.sub(" ", text.lower()).strip()
    return plain.encode() if any(map(str.isalpha, plain)) else b""


@dataclass(frozen=True)
class Model:
    """A dictionary for each language, languages with more labelled texts first."""

    dictionaries: dict[str, bytes]

    def classifier(self) -> Classifier:
        return Classifier(self)


class Classifier:
    def __init__(self, model: Model) -> None:
        self.languages = list(model.dictionaries)
        self.compressors = []
        for raw in model.dictionaries.values():
            known = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False, write_dict_id=False,
            ))

    def sizes(self, plain: bytes) -> list[int]:
        pieces = [plain[k : k + PIECE] for k in range(0, len(plain), PIECE)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]

    def answer(self, text: str | None) -> tuple[str, float, float | None]:
        """Language, score and margin: the share of bytes the next language needs more."""
        plain = letters(text) if text else b""
        if not plain or not self.languages:
            return UNKNOWN, 0.0, None
        sizes = self.sizes(plain)
        best = min(sizes)
        rivals = sorted(sizes)[1:]
        # A byte more counts as one bit of evidence.
        score = 1.0 / (1.0 + sum(2.0 ** -min(60, s - best) for s in rivals))
        return self.languages[sizes.index(best)], score, (rivals[0] - best) / best if rivals else None


def fit(docs: DataFrame, *, sample: int = SAMPLE, excerpt: int = EXCERPT) -> Model:
    """Dictionaries from the documents that are not held out."""
    rows = docs.where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    ).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("key"))
    # Copies meet inside each task first.
    counted = rows.select("lang", "key").distinct().groupBy("lang").count().limit(LANGUAGES + 1).collect()
    if len(counted) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not counted:
        return Model({})
    totals = {r["lang"]: r["count"] for r in counted}
    shares = F.create_map(*[F.lit(x) for lang, n in totals.items() for x in (lang, int(2**30 * min(1.0, 1.5 * sample / n)))])
    draw = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(2**30))
    room = F.greatest(F.char_length("text") - excerpt + 1, F.lit(1))
    start = F.pmod(F.xxhash64("key", F.lit("place")), room.cast("long")).cast("int") + 1
    picked = (
        rows.where(draw < shares[F.col("lang")])
        .select("lang", "key", draw.alias("draw"), F.substring("text", start, F.lit(excerpt)).alias("part"))
        .groupBy("lang", "key").agg(F.min("draw").alias("draw"), F.min("part").alias("part"))
    )
    parts: defaultdict[str, list[bytes]] = defaultdict(list)
    for r in sorted(picked.collect(), key=lambda r: (r["draw"], r["key"])):
        if len(parts[r["lang"]]) < sample:
            parts[r["lang"]].append(letters(r["part"]))
    by_size = sorted(totals, key=lambda lang: (-totals[lang], lang))
    joined = {lang: b" ".join(x for x in parts[lang] if x) for lang in by_size}
    return Model({lang: raw for lang, raw in joined.items() if raw})


def _rows(batches: Iterator[pa.RecordBatch], model: Model, margin: float) -> Iterator[pa.RecordBatch]:
    classifier = model.classifier()
    for batch in batches:
        answers = [classifier.answer(text.as_py()) for text in batch.column(1)]
        lang, score, apart = zip(*answers, strict=True) if answers else ((), (), ())
        narrow = [a is not None and a < margin for a in apart]
        columns = [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(apart, pa.float64())]
        yield pa.record_batch([*columns, pa.array(narrow, pa.bool_())], schema=_ARROW)


def classify(docs: DataFrame, model: Model, *, margin: float = MARGIN) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score``, ``margin`` and ``rejected`` of every document.

    ``lang_pred`` is the best language also where the answer is rejected.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: _rows(b, model, margin), SCHEMA)


def report(docs: DataFrame, model: Model) -> DataFrame:
    """The answers, with the documents marked that no fit learns from."""
    found = classify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "rejected")
