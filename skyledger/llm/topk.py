"""Exact top-k by integer inner product: longest vectors first, pruned by residual bounds.

Vectors become integers, floor(scale * x), and are sorted by descending length
over all tasks. The eigenvectors of their Gram matrix (the right singular
vectors of the table) rotate them so that the first coordinates hold most of
an inner product. For a block of vectors and the queries still open, the sum
over the first coordinates plus the product of the residual lengths bounds the
score (Cauchy-Schwarz); only pairs whose bound reaches the query's k-th best
score so far go on to more coordinates, and the rest are scored exactly on the
integers. A task stops for a query once length times length cannot reach it.

Queries are taken in blocks of a bounded size, each against all vectors; first
thresholds come from a bounded number of the longest vectors.

Defined results: rows whose id or vector is null, or whose vector holds a null
or non-finite component, take no part; shorter vectors count as ended by zeros;
rows with the query's own id are no candidates; of rows that share a query id
the smallest vector asks; equal scores go to the smaller id; scores beyond 64
bits become the nearest long; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import stored

BLOCK_ROWS, QUERY_BLOCK = 1024, 4096
#: First thresholds come from so many blocks of the longest vectors.
SEED_BLOCKS = 2
#: Share of the coordinates after which pairs are looked at again.
STEPS = (0.125, 0.25, 0.5)
#: Pairs are looked up one by one once at most this share of them is left.
FEW = 0.02
RESULT = "query_id long, vec_id long, score long"


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column as doubles, short ones ended by zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), dims))
    if len(flat) == len(sizes) * dims:
        return flat.reshape(len(sizes), dims)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with whole-number values, pair by pair, as longs."""
    top = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, queries.shape[1])
    if top < 2**53:  # every partial sum is a double without rounding
        return np.einsum("ij,ij->i", queries, vectors).astype(np.int64)
    wide = [sum(int(x) * int(y) for x, y in zip(q, v, strict=True)) for q, v in zip(queries, vectors, strict=True)]
    return np.array([min(max(w, -(2**63)), 2**63 - 1) for w in wide], np.int64)


class Open:
    """Queries with their best scores so far, against blocks of ever shorter vectors."""

    def __init__(self, ids: np.ndarray, ints: np.ndarray, rotation: np.ndarray, k: int, least: np.ndarray | None = None) -> None:
        self.ids, self.ints, self.k = ids, ints, k
        self.rotated = ints @ rotation
        self.norms = np.linalg.norm(ints, axis=1)
        dims = ints.shape[1]
        self.cuts = sorted({max(1, round(s * dims)) for s in STEPS} - {dims}) if dims else []
        self.rest = [np.linalg.norm(self.rotated[:, c:], axis=1) for c in self.cuts]
        self.least = np.full(len(ids), -np.inf) if least is None else least.astype(float)
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]

    def look(self, ids: np.ndarray, ints: np.ndarray, rotated: np.ndarray) -> bool:
        """Take in a block; False once no query is open to vectors as short as its first."""
        norms = np.linalg.norm(ints, axis=1)
        slack = 1e-9 * (1 + self.norms * norms.max(initial=0))  # what rounding may take from a bound
        bar = self.least - slack
        q = np.flatnonzero(self.norms * norms.max(initial=0) >= bar)
        if not len(q):
            return False
        qi, vi = self._survivors(q, rotated, bar)
        if qi is None:  # most pairs are left: one product of matrices is cheaper than looking each up
            exact = self.ints[q] @ ints.T + slack[q, None]
            rows, vi = np.nonzero(exact >= self.least[q, None])
            qi = q[rows]
        other = self.ids[qi] != ids[vi]
        qi, vi = qi[other], vi[other]
        exact = np.concatenate([np.zeros(0, np.int64), *(
            scores(self.ints[qi[s : s + 65536]], ints[vi[s : s + 65536]]) for s in range(0, len(qi), 65536)
        )])
        order = np.lexsort((ids[vi], -exact.astype(float), qi))
        qi, vi, exact = qi[order], vi[order], exact[order]
        if not len(qi):
            return True
        begins = np.flatnonzero(np.concatenate([[True], qi[1:] != qi[:-1]]))
        for a, b in zip(begins, [*begins[1:], len(qi)], strict=True):
            row = qi[a]
            new = sorted(zip((-exact[a:b]).tolist(), ids[vi[a:b]].tolist(), strict=True))[: self.k]
            self.best[row] = sorted(self.best[row] + new)[: self.k]
            if len(self.best[row]) == self.k:
                self.least[row] = max(self.least[row], -self.best[row][-1][0])
        return True

    def _survivors(self, q: np.ndarray, rotated: np.ndarray, bar: np.ndarray):
        """Pairs whose bound reaches the bar after all cuts; (None, None) while too many do to look up."""
        part, before, qi, vi = 0.0, 0, None, None
        for n, c in enumerate(self.cuts):
            rest = np.linalg.norm(rotated[:, c:], axis=1)
            if qi is None:
                part = part + self.rotated[q, before:c] @ rotated[:, before:c].T
                reach = part + self.rest[n][q, None] * rest[None, :] >= bar[q, None]
                if reach.mean() <= FEW:
                    rows, vi = np.nonzero(reach)
                    qi, part = q[rows], part[rows, vi]
            else:
                part = part + np.einsum("ij,ij->i", self.rotated[qi, before:c], rotated[vi, before:c])
                keep = part + self.rest[n][qi] * rest[vi] >= bar[qi]
                qi, vi, part = qi[keep], vi[keep], part[keep]
            before = c
        return qi, vi

    def rows(self) -> list[tuple[int, int, int]]:
        return [(int(q), v, -s) for q, best in zip(self.ids, self.best, strict=True) for s, v in best]


def _usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(vector).isNotNull()).where(~bad)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


def _rotation(rows: DataFrame, dims: int, scale: float) -> np.ndarray:
    """Eigenvectors of the Gram matrix, by falling eigenvalue; the driver sees dims x dims numbers."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            x = np.floor(scale * _matrix(batch.column(0), dims))
            total += x.T @ x
        i, j = np.triu_indices(dims)
        yield pa.record_batch([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "x"])

    sums = rows.select("vector").mapInArrow(grams, "i long, j long, x double").groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((dims, dims))
    for i, j, x in sums.collect():
        gram[i, j] = gram[j, i] = x if np.isfinite(x) else 0.0
    values, vectors = np.linalg.eigh(gram)
    return np.ascontiguousarray(vectors[:, np.argsort(-values)])


def _blocks(rows: DataFrame, dims: int, scale: float, size: int) -> DataFrame:
    """Vectors by falling length, packed ``size`` to a row, stored."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = np.floor(scale * _matrix(batch.column(1), dims))
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(ids), size):
                x = ints[at : at + size]
                row = [[np.linalg.norm(x, axis=1).max()], [ids[at : at + size].tobytes()], [x.tobytes()]]
                yield pa.record_batch([pa.array(row[0]), pa.array(row[1], pa.binary()), pa.array(row[2], pa.binary())], names=["longest", "ids", "ints"])

    def squared(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + F.floor(F.lit(scale) * v).cast("double") ** 2)

    length = squared(F.col("vector"))
    ordered = rows.withColumn("length", length).repartitionByRange(F.desc("length"), "vec_id").sortWithinPartitions(F.desc("length"), "vec_id")
    return stored(ordered.select("vec_id", "vector").mapInArrow(pack, "longest double, ids binary, ints binary"), "blocks")


def _unpacked(ids: bytes, ints: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(ints, np.float64).reshape(-1, dims)


def search(
    vectors: DataFrame, asks: Column, *, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id",
    vector: str = "embedding", block_rows: int = BLOCK_ROWS, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` best rows of each row where ``asks``."""
    spark = vectors.sparkSession
    rows = _usable(vectors, vec_id, vector)
    queries = _usable(vectors.where(asks), vec_id, vector).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    dims = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    found = spark.createDataFrame([], RESULT)
    n = queries.count()
    if n:
        dims = max(1, dims)
        rotation = _rotation(rows, dims, scale)
        blocks = _blocks(rows, dims, scale, block_rows)
        seeds = [_unpacked(r["ids"], r["ints"], dims) for r in blocks.orderBy(F.desc("longest")).limit(SEED_BLOCKS).collect()]
        parts = -(-n // query_block)
        for part in range(parts):
            mine = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).toArrow()
            if not mine.num_rows:
                continue
            ids = mine.column(0).to_numpy().astype(np.int64)
            ints = np.floor(scale * _matrix(mine.column(1).combine_chunks(), dims))
            first = Open(ids, ints, rotation, k)
            for names, x in seeds:
                first.look(names, x, x @ rotation)
            found = found.union(_scan(blocks, ids, ints, rotation, first.least, k, dims))
    # A task gives at most k rows for a query, so what a query's ranking reads is bounded by tasks.
    found = stored(found, "found") if n else found
    best = F.row_number().over(_by_query())
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _by_query():
    from pyspark.sql import Window

    return Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")


def _scan(blocks: DataFrame, ids, ints, rotation, least, k: int, dims: int) -> DataFrame:
    shared = blocks.sparkSession.sparkContext.broadcast((ids, ints, rotation, least))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Open(*shared.value[:3], k, shared.value[3].copy())
        for batch in batches:
            for names, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v_ids, v = _unpacked(names, raw, dims)
                state.look(v_ids, v, v @ shared.value[2])
        rows = state.rows()
        columns = zip(*rows, strict=True) if rows else [[]] * 3
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    return blocks.select("ids", "ints").mapInArrow(run, RESULT)


#: The op2 query's rows in DuckDB.
SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
