"""Toxicity: a weighted lexicon found by Aho-Corasick in folded text.

Folding lowers a text, turns look-alike letters of other alphabets into Latin
ones and digits or signs of words into the letters they stand for. The
lexicon is learned from a bounded labelled sample: starts of words and whole
words that toxic documents hold far more often than others, weighted by the log
of that ratio; phrases of a lexicon word and its neighbour that others hold at
least as often become exceptions, and a hit inside an exception does not count.
A text's weighted hits, by themselves and per word, go through a logistic curve.

Defined results: null and empty texts have no hits and score like any text
without; a null or repeated ``doc_id`` is scored by itself (and is not held out
if null); without labels of both classes the lexicon is empty and the score is
the smoothed share of toxic labels; an empty table gives an empty result; extra
columns are ignored. Held-out ids are never learned from.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .base import held_out, labelled_ids, one_a_document, stored

#: Most labelled documents a fit reads; most words in a lexicon.
SAMPLE, LEXICON = 20_000, 3000
#: Starts of words are looked at from and up to these lengths.
SHORT, LONG = 4, 8
#: A task hands its counts on when it holds so many words.
HELD = 300_000
#: Letters of other alphabets that look like Latin ones.
LOOKALIKES = str.maketrans(
    "авеікмнорстухѕјԁԛԝһӏαβεικνορτυχωɑɡıɩ",
    "abeikmhopctyxsjdqwhlabeikvoptuxwagii",
)
#: Digits and signs that stand for letters inside words. A one reads as i or
#: l, so both are written i.
SIGNS = str.maketrans("0134578@$!|", "oieastbasii")
#: Runs of letters, digits and signs that hold one of those.
_SIGNED = re.compile(r"(?<![a-z\d@$!|])[a-z269]*+[0134578@$!|][a-z\d@$!|]*+")
#: Marks that only change how a letter looks, and signs without width.
_UNSEEN = re.compile("[\u0300-\u036f\u200b-\u200d\u2060\ufeff\u00ad]")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .*_-]){3,}[^\W\d_](?![^\W_])")
_DRAWN = re.compile(r"([^\W\d_])\1{2,}")
_WORD = re.compile(r"[^\W\d_]+")


def _read(token: str) -> str:
    """A token as letters, if it holds any; one that ends in digits or signs also without these.

    An end like "3" may be a letter or a number, so both readings stand; "!" and "|" at either
    end are punctuation.
    """
    core = token.strip("!|")
    bare = core.rstrip("0123456789@$")
    if not any("a" <= c <= "z" for c in core):
        return token
    read = core.translate(SIGNS)
    if bare != core:
        read = f"{bare.translate(SIGNS)} {read}"
    return token.replace(core, read, 1)


def fold(text: str) -> list[str]:
    """The words of a text as they read, without accents, drawn-out letters or gaps between letters."""
    text = text.lower()
    if not text.isascii():
        text = _UNSEEN.sub("", unicodedata.normalize("NFKD", text)).lower().translate(LOOKALIKES)
    text = _SIGNED.sub(lambda m: _read(m[0]), text)
    text = _SPACED.sub(lambda m: re.sub(r"[ .*_-]", "", m[0]), text)
    text = _DRAWN.sub(r"\1", text)
    return _WORD.findall(text.replace("l", "i"))


def _forms(word: str) -> list[str]:
    """What a word of any length is filed under: itself with its end, and its starts if it has some."""
    return [f" {word[:n]}" for n in range(SHORT, min(LONG, len(word)) + 1)] + [f" {word} "]


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]  # " start" or " word "
    exceptions: tuple[str, ...]  # " word word "
    curve: tuple[float, float, float]  # bias, weight of hits per word, weight of hits

    def finder(self) -> ahocorasick.Automaton | None:
        if not self.weights:
            return None
        out = ahocorasick.Automaton()
        for form, weight in self.weights.items():
            out.add_word(form, (len(form), weight))
        for phrase in self.exceptions:
            out.add_word(phrase, (len(phrase), None))
        out.make_automaton()
        return out


def hits(words: list[str], finder: ahocorasick.Automaton | None) -> float:
    """Summed weight of the words hit, each by its heaviest form, outside exceptions."""
    if finder is None or not words:
        return 0.0
    found: dict[int, float] = {}
    spared: list[tuple[int, int]] = []
    for end, (size, weight) in finder.iter(f" {' '.join(words)} "):
        start = end - size + 1
        if weight is None:
            spared.append((start, end))
        elif weight > found.get(start, 0.0):
            found[start] = weight
    for a, b in spared:
        for start in [s for s in found if a <= s < b]:
            del found[start]
    return sum(found.values())


def _features(text: str | None, finder: ahocorasick.Automaton | None) -> tuple[float, float]:
    words = fold(text) if text else []
    weight = hits(words, finder)
    return weight / np.sqrt(len(words) + 1), np.log1p(weight)


def _counted(rows: DataFrame, keys) -> DataFrame:
    """``(form, toxic, clean)``: documents of each label that hold a form; ``keys(words)`` gives forms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: Counter[str] = Counter()
        clean: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            forms = list(toxic.keys() | clean.keys())
            columns = [pa.array(forms, pa.string()), pa.array([toxic[f] for f in forms], pa.int64()), pa.array([clean[f] for f in forms], pa.int64())]
            toxic.clear()
            clean.clear()
            return pa.record_batch(columns, names=["form", "toxic", "clean"])

        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update(keys(fold(text or "")))
                if len(toxic) + len(clean) > HELD:
                    yield out()
        yield out()

    counted = rows.select("label", "text").mapInArrow(run, "form string, toxic long, clean long")
    return counted.groupBy("form").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _word_forms(words: list[str]) -> set[str]:
    return {f for w in set(words) for f in _forms(w)}


def _needed(forms: dict[str, tuple[float, int]], share: float = 0.9) -> dict[str, float]:
    """Forms without the starts that one longer form explains: " path" where only " pathetic " was seen."""
    out, ordered = {}, sorted(forms)  # what a form starts follows it
    for k, form in enumerate(ordered):
        rest = (forms[f][1] for f in ordered[k + 1 : next((j for j in range(k + 1, len(ordered)) if not ordered[j].startswith(form)), len(ordered))])
        if max(rest, default=0) < share * forms[form][1]:
            out[form] = forms[form][0]
    return out


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Bias and weights by ridge-damped Newton steps."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        w = w - np.linalg.solve(hess, grad)
    return w


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, lexicon: int = LEXICON, share: float = 0.02) -> Lexicon:
    """Learn ``labels.toxic`` from at most ``sample`` labelled documents that are not held out.

    A form must be in this ``share`` of the toxic documents, and in 5 of them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        F.broadcast(labelled_ids(labels, "toxic", sample)), "doc_id"  # two numbers a row
    )
    # A bounded sample, but costly to read words from: every core has its share.
    rows = one_a_document(rows.withColumn("text_hash", F.xxhash64("text")), ["text"])
    rows = stored(rows.repartition(docs.sparkSession.sparkContext.defaultParallelism * 2), "sample")
    sizes = dict(rows.groupBy("label").count().collect())
    n, p = sum(sizes.values()), sum(v for k, v in sizes.items() if k)
    prior = float(np.log((p + 1) / (n - p + 1)))
    if p in (0, n):
        return Lexicon({}, (), (prior if n else 0.0, 0.0, 0.0))

    least = max(5, round(share * p))
    odds = F.log((F.col("toxic") + 0.5) / (F.lit(p) + 1.0)) - F.log((F.col("clean") + 0.5) / (F.lit(n - p) + 1.0))
    forms = _counted(rows, _word_forms).where((F.col("toxic") >= least) & (odds > 2.0)).withColumn("odds", odds)
    picked = forms.orderBy(F.desc(F.col("odds") * F.sqrt(F.col("toxic"))), "form").limit(lexicon).collect()
    weights = _needed({r["form"]: (r["odds"], r["toxic"]) for r in picked})

    finder = Lexicon(weights, (), (0.0, 0.0, 0.0)).finder()

    def phrases(words: list[str]) -> set[str]:
        hit = {w for w in set(words) if hits([w], finder)}
        pairs = zip(words, words[1:], strict=False)
        return {f" {a} {b} " for a, b in pairs if a in hit or b in hit}

    # Phrases that clean documents hold often: their words do not count there.
    spared = _counted(rows, phrases).where((F.col("clean") >= least) & (F.col("toxic") * (n - p) <= F.col("clean") * p))
    exceptions = tuple(r["form"] for r in spared.orderBy(F.desc("clean"), "form").limit(lexicon).select("form").collect())

    draft = Lexicon(weights, exceptions, (0.0, 0.0, 0.0))
    rated = _rated(rows, draft).toPandas()
    w = _logistic(rated[["density", "total"]].to_numpy(), (rated["label"] > 0).to_numpy(float))
    return Lexicon(weights, exceptions, tuple(w.tolist()))


def _rated(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = lexicon.finder()
        for batch in batches:
            rated = [_features(t, finder) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), *(pa.array(c, pa.float64()) for c in (zip(*rated, strict=True) if rated else [[], []]))]
            yield pa.record_batch(columns, names=["label", "density", "total"])

    return rows.select("label", "text").mapInArrow(run, "label int, density double, total double")


def toxic(text: Column, lexicon: Lexicon) -> Column:
    """Probability that a text is toxic."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = lexicon.finder()
        bias, density, total = lexicon.curve
        for batch in batches:
            x = np.array([_features(t, finder) for t in batch]).reshape(-1, 2)
            yield pd.Series(1 / (1 + np.exp(-np.clip(bias + density * x[:, 0] + total * x[:, 1], -30, 30))))

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, DoubleType())(text)


def score(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), toxic(docs["text"], lexicon).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
