"""The registered queries: each operator over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import (
    compression_language, conversations, line_dedup, packing, periodic_runs, piece_lattice, prefix_trie, quality_rules,
    rule_ensemble, simhash, suffix_dedup, token_shards, topk, toxicity,
)
from .base import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules)


@query
def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL["op2_topk"] = topk.SQL


@query
def op3_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_lattice.encode(table(spark, sf_dir, "documents"), piece_lattice.load())


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query
def op5_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rule_ensemble.score(docs, rule_ensemble.fit(docs, table(spark, sf_dir, "labels")))


@query
def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "shards")
    token_shards.write(table(spark, sf_dir, "documents"), path)
    return token_shards.read(spark, path)


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def planted(doc_id: int | None, words: periodic_runs.Words) -> periodic_runs.Words:
    """The words, in a tenth of the documents with a repeating end."""
    n = len(words)
    if doc_id is None or not n:
        return words
    high, low = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if low:
        return words
    a = high % n
    p = 1 + (n - a) // (3 + high % 8)
    return words[:a] + (words[a : a + p] * ((n - a) // p + 1))[: n - a]


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.report(table(spark, sf_dir, "documents"), planted)


@query
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return compression_language.report(docs, compression_language.fit(docs))


@query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(*conversations.rebuilt(table(spark, sf_dir, "conversations")))


SQL["op13_prefix_trie"] = """
WITH turns AS (
  SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
-- crc32: each byte comes in whole, then eight times one bit goes out.
plans AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(
    list_transform(string_split(conv_id::VARCHAR, ''), lambda d: [ord(d)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda acc, e: CASE WHEN e >= 0 THEN xor(acc, e) ELSE xor(acc >> 1, 3988292384 * (acc & 1)) END)) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT p.conv_id, 0 AS part, t.place, t.role, t.text FROM plans p JOIN turns t ON t.conv_id = p.base AND t.place <= p.h
  UNION ALL SELECT p.conv_id, 1, t.place, t.role, t.text FROM plans p JOIN turns t ON t.conv_id = p.conv_id AND t.place > p.h),
rebuilt AS (
  SELECT conv_id, CAST(row_number() OVER w AS BIGINT) AS depth, strlen(text) AS size,
    string_agg(sha256(role || chr(1) || sha256(text)), '') OVER (w ROWS UNBOUNDED PRECEDING) AS prefix
  FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, place)),
-- The empty prefix is the root's.
paths AS (SELECT conv_id, depth, size, sha256(prefix) AS prefix FROM rebuilt UNION ALL SELECT conv_id, 0, 0, 'root' FROM plans),
ends AS (SELECT conv_id, max(depth) AS n FROM paths GROUP BY conv_id),
found AS (
  SELECT prefix, any_value(p.depth) AS depth, any_value(size) AS size, min(p.conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN n = p.depth THEN p.conv_id::VARCHAR END, ',' ORDER BY p.conv_id), '')) AS ends_sha256
  FROM paths p JOIN ends e ON e.conv_id = p.conv_id GROUP BY prefix),
up AS (
  SELECT f.prefix, o.prefix AS parent, g.conv_id AS parent_conv_id FROM found f
  JOIN paths o ON o.conv_id = f.conv_id AND o.depth = f.depth - 1 JOIN found g ON g.prefix = o.prefix),
kids AS (SELECT parent AS prefix, count(*) AS n FROM up GROUP BY parent),
below AS (
  SELECT o.prefix, sum((f.n_convs - 1) * f.size) AS saved, count(*) FILTER (WHERE f.prefix NOT IN (SELECT prefix FROM kids)) AS leaves
  FROM found f JOIN paths o ON o.conv_id = f.conv_id AND o.depth <= f.depth GROUP BY o.prefix)
SELECT f.conv_id, f.depth, u.parent_conv_id, f.n_convs, coalesce(k.n, 0) AS n_children, b.leaves AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, f.ends_sha256
FROM found f JOIN below b ON b.prefix = f.prefix LEFT JOIN up u ON u.prefix = f.prefix LEFT JOIN kids k ON k.prefix = f.prefix
"""
