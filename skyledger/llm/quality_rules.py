"""Learned decision lists: ordered threshold rules that reject low-quality documents.

Sequential covering grows one conjunction of thresholds at a time on two
thirds of a bounded labelled sample, prunes it on the rest, takes the rows it
covers out, and stops when the next rule is not precise enough. The list
becomes one ordered Spark conditional, so scoring is a codegen expression over
the statistics.

Defined results: a null text counts as empty; an empty text has no words and
fails the base rule; a null or repeated ``doc_id`` is scored like any other
row; without labels of both classes the list is empty and only the base rule
rejects; an empty table gives an empty result. Extra columns, whatever their
names, are carried by ``filter_documents`` and ignored by ``judge``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import fresh, labelled_ids, one_a_document
from .textstats import COUNTS, counts, ratios

#: Most labelled documents a fit reads.
SAMPLE = 20_000
MIN_WORDS, MAX_REPEAT = 50, 50
CONTRACT = COUNTS[:5]


@dataclass(frozen=True)
class Test:
    name: str
    above: bool
    cut: float

    def rows(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] > self.cut if self.above else x[self.name] <= self.cut

    def column(self, x: dict[str, Column]) -> Column:
        return x[self.name] > F.lit(self.cut) if self.above else x[self.name] <= F.lit(self.cut)


Rule = tuple[Test, ...]


def covers(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for test in rule:
        hit &= test.rows(x)
    return hit


def _cuts(values: np.ndarray, most: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, most + 2)[1:-1], method="lower"))


def grow(x: dict[str, np.ndarray], y: np.ndarray, most_tests: int, most_cuts: int) -> Rule:
    """Add the test with the highest information gain until no negative is covered."""
    rule: list[Test] = []
    hit = np.ones(len(y), bool)
    while len(rule) < most_tests and not y[hit].all():
        p0, n0 = y[hit].sum(), hit.sum()
        base, best = np.log2(max(p0, 1e-9) / n0), (1e-9, None)
        for name, values in x.items():
            v, order = values[hit], np.argsort(values[hit], kind="stable")
            v, t = v[order], np.concatenate([[0], np.cumsum(y[hit][order])])
            for cut in _cuts(v, most_cuts):
                k = np.searchsorted(v, cut, "right")
                for above, p, n in ((False, t[k], k), (True, t[-1] - t[k], n0 - k)):
                    if p and n < n0:
                        gain = p * (np.log2(p / n) - base)
                        if gain > best[0]:  # the cut lies midway to the next value
                            best = (gain, Test(name, above, float((v[k - 1] + v[k]) / 2)))
        if best[1] is None:
            break
        rule.append(best[1])
        hit &= best[1].rows(x)
    return tuple(rule)


def prune(rule: Rule, x: dict[str, np.ndarray], y: np.ndarray) -> Rule:
    """The head of the rule with the best (right - wrong) / covered on rows it was not grown on."""

    def worth(head: Rule) -> float:
        hit = covers(head, x, len(y))
        return (2 * y[hit].sum() - hit.sum()) / hit.sum() if hit.any() else -1.0

    heads = [rule[:k] for k in range(len(rule), 0, -1)]
    return max(heads, key=lambda h: (worth(h), len(h)), default=())


def learn_list(
    x: dict[str, np.ndarray], y: np.ndarray, *, precision: float = 0.8, most_rules: int = 24,
    most_tests: int = 4, most_cuts: int = 48, least: int = 5, seed: int = 7,
) -> list[Rule]:
    """Rules for ``y`` true, in order; each must reach ``precision`` on all rows still uncovered."""
    rules: list[Rule] = []
    left = np.ones(len(y), bool)
    part = np.random.default_rng(seed).random(len(y)) < 2 / 3
    while len(rules) < most_rules and y[left].sum() >= least:
        g, p = left & part, left & ~part
        if not y[g].any():
            break
        rule = grow({k: v[g] for k, v in x.items()}, y[g], most_tests, most_cuts)
        rule = prune(rule, {k: v[p] for k, v in x.items()}, y[p]) if y[p].any() else rule
        hit = covers(rule, x, len(y)) & left
        if not rule or hit.sum() < least or y[hit].mean() < precision:
            break
        rules.append(rule)
        left &= ~hit
    return rules


def decision(rules: list[Rule], x: dict[str, Column]) -> Column:
    """Number of the first rule that covers a row, from 1; 0 when none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        met = rule[0].column(x)
        for test in rule[1:]:
            met = met & test.column(x)
        out = F.when(met, F.lit(k)) if out is None else out.when(met, F.lit(k))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed(c: str) -> Column:
    words, repeat = F.col(f"{c}.n_words"), F.col(f"{c}.n_repeat_words")
    return (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT * words)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[Rule]:
    """Learn from at most ``sample`` labelled documents that pass the base rule, one row of each."""
    ids = labelled_ids(labels, "quality", sample)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(ids), "doc_id")  # at most `sample` rows of two numbers
        .select("doc_id", "label", F.xxhash64("text").alias("text_hash"), counts("text").alias("c"))
        .where(~base_failed("c"))
        .select("doc_id", "label", "text_hash", *[v.alias(k) for k, v in ratios("c").items()])
    )
    rows = one_a_document(rows, list(ratios("c"))).toPandas()
    rows = rows.sort_values(list(rows.columns), ignore_index=True)
    bad = rows.pop("label").to_numpy() == 0
    if not bad.any() or bad.all():
        return []
    return learn_list({k: rows[k].to_numpy(float) for k in rows}, bad)


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``rule`` (0: none) and ``kept`` of every document."""
    rows = docs.select("doc_id", counts("text").alias("c"))
    return rows.select(
        "doc_id", *[F.col(f"c.{n}").alias(n) for n in CONTRACT],
        base_failed("c").alias("base_failed"), decision(rules, ratios("c")).alias("rule"),
        *[F.col(f"c.{n}").alias(n) for n in COUNTS[5:]],
    ).withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def filter_documents(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that neither the base rule nor the list rejects, with all their columns."""
    c = fresh(docs, "_counts")
    kept = ~base_failed(c) & (decision(rules, ratios(c)) == 0)
    return docs.withColumn(c, counts(docs["text"])).where(kept).drop(c)
