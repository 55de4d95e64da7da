"""Sparse rule ensemble: tree paths as rules, lasso logistic weights, one Spark expression.

Shallow trees are grown on random parts of a bounded labelled sample; every
path from a root to a node is a rule, a conjunction of thresholds over text
statistics. An L1-penalised logistic regression weighs the rules, most of them
to zero; the penalty is picked on rows the trees did not see. The rules left
compile into one column expression, so scoring is codegen over the counts.

Defined results: a null text counts as empty and is scored like any other; a
null or repeated ``doc_id`` is scored by itself (and is not held out if null);
with no labels the score is 0.5, with one class its smoothed share; an empty
table gives an empty result; extra columns are ignored. Held-out ids are never
learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import held_out, labelled_ids, one_a_document
from .quality_rules import Rule, Test, covers
from .textstats import counts, ratios

#: Most labelled documents a fit reads.
SAMPLE = 20_000
TREES, DEPTH, LEAST = 60, 3, 10


@dataclass(frozen=True)
class Ensemble:
    bias: float
    rules: tuple[tuple[float, Rule], ...]

    def column(self, x: dict[str, Column]) -> Column:
        """Probability of label 1."""
        total = F.lit(self.bias)
        for weight, rule in self.rules:
            met = rule[0].column(x)
            for test in rule[1:]:
                met = met & test.column(x)
            total = total + F.when(met, F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def predict(self, x: dict[str, np.ndarray], n: int) -> np.ndarray:
        total = np.full(n, self.bias)
        for weight, rule in self.rules:
            total += weight * covers(rule, x, n)
        return 1 / (1 + np.exp(-total))


def _split(x: dict[str, np.ndarray], y: np.ndarray, names: list[str], most_cuts: int = 32) -> Test | None:
    """The cut with the largest fall in Gini impurity, midway between two values."""
    best, found = 1e-7, None
    n, ones = len(y), y.sum()
    whole = ones * (n - ones) / n
    for name in names:
        order = np.argsort(x[name], kind="stable")
        v, t = x[name][order], np.cumsum(y[order])
        ends = np.flatnonzero(v[1:] > v[:-1]) + 1
        ends = ends[(ends >= LEAST) & (ends <= n - LEAST)]
        if len(ends) > most_cuts:
            ends = ends[np.linspace(0, len(ends) - 1, most_cuts).astype(int)]
        if not len(ends):
            continue
        left, right = t[ends - 1], ones - t[ends - 1]
        fall = whole - left * (ends - left) / ends - right * (n - ends - right) / (n - ends)
        k = int(np.argmax(fall))
        if fall[k] > best:
            best, found = fall[k], Test(name, False, float((v[ends[k] - 1] + v[ends[k]]) / 2))
    return found


def paths(x: dict[str, np.ndarray], y: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 5) -> list[Rule]:
    """Distinct rules: the paths to all nodes of ``trees`` random trees."""
    draw, rules = np.random.default_rng(seed), {}

    def grow(rows: np.ndarray, rule: Rule) -> None:
        if rule:
            rules.setdefault(rule, None)
        if len(rule) == depth or len(rows) < 2 * LEAST or y[rows].min() == y[rows].max():
            return
        names = draw.choice(sorted(x), max(2, len(x) // 3), replace=False).tolist()
        test = _split({k: x[k][rows] for k in names}, y[rows], names)
        if test is None:
            return
        below = test.rows({test.name: x[test.name][rows]})
        grow(rows[below], (*rule, test))
        grow(rows[~below], (*rule, Test(test.name, True, test.cut)))

    for _ in range(trees):
        grow(draw.permutation(len(y))[: max(2 * LEAST, len(y) // 2)], ())
    return list(rules)


def lasso(m: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 300) -> tuple[float, np.ndarray]:
    """Bias and weights of an L1-penalised logistic regression, by accelerated proximal steps."""
    n = len(y)
    step = 4 * n / max(1.0, np.linalg.norm(np.column_stack([np.ones(n), m]), 2) ** 2)
    w = z = np.zeros(m.shape[1])
    b = c = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
    t = 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(m @ z + c))) - y
        v = z - step * (m.T @ error) / n
        w_new = np.sign(v) * np.maximum(np.abs(v) - step * penalty, 0)
        b_new = c - step * error.mean()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z, c = w_new + (t - 1) / t_new * (w_new - w), b_new + (t - 1) / t_new * (b_new - b)
        w, b, t = w_new, b_new, t_new
    return b, w


def train(x: dict[str, np.ndarray], y: np.ndarray, seed: int = 5) -> Ensemble:
    """Rules from three quarters of the rows, the penalty from the rest, the weights from all."""
    n = len(y)
    if n == 0 or y.min() == y.max():
        return Ensemble(float(np.log((y.sum() + 1) / (n - y.sum() + 1))) if n else 0.0, ())
    own = np.random.default_rng(seed).random(n) < 0.75
    rules = paths({k: v[own] for k, v in x.items()}, y[own], seed=seed)
    m = np.column_stack([np.zeros(n), *(covers(r, x, n) for r in rules)]).astype(float)
    best = (np.inf, 0.01)
    for penalty in (0.03, 0.01, 0.003, 0.001):
        b, w = lasso(m[own], y[own], penalty)
        p = np.clip(1 / (1 + np.exp(-(m[~own] @ w + b))), 1e-6, 1 - 1e-6)
        loss = -np.mean(np.where(y[~own] > 0, np.log(p), np.log(1 - p))) if (~own).any() else np.inf
        best = min(best, (loss, penalty))
    b, w = lasso(m, y, best[1])
    kept = [(float(v), r) for v, r in zip(w[1:], rules, strict=True) if abs(v) > 1e-6]
    return Ensemble(float(b), tuple(kept))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """Learn ``labels.quality`` from at most ``sample`` labelled documents that are not held out, one row of each."""
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(labelled_ids(labels, "quality", sample)), "doc_id")  # two numbers a row
        .select("doc_id", "label", F.xxhash64("text").alias("text_hash"), counts("text").alias("c"))
        .select("doc_id", "label", "text_hash", *[v.alias(k) for k, v in ratios("c").items()])
    )
    rows = one_a_document(rows, list(ratios("c"))).toPandas()
    rows = rows.sort_values(list(rows.columns), ignore_index=True)
    y = (rows.pop("label").to_numpy() > 0).astype(float)
    return train({k: rows[k].to_numpy(float) for k in rows}, y)


def score(docs: DataFrame, model: Ensemble, threshold: float = 0.3) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document."""
    rows = docs.select("doc_id", counts("text").alias("c"))
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.column(ratios("c")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
