"""A z-fast trie of conversations, built in batches, and what each of its nodes saves.

A prefix of a conversation is known by a 128-bit hash: the exclusive or of two
64-bit hashes of each turn together with its depth. Conversations that are equal
count as one sequence with a weight. The compacted trie is kept as edges: edge
``(low, high]`` of the sequence that owns it, filed under the hash of its handle,
the prefix whose length is the 2-fattest number in ``(low, high]``.

In a round each waiting sequence finds its exit node by fat binary search: probe
the 2-fattest length of what is left, go below the edge if its handle is filed
there, above the probe if not. The exit edge is the one found, or the child of
its end that starts with the next turn; where the sequence leaves it is found by
halving. Of all that leave at one place with one turn, one, by a hash of its
number, is inserted: edges are cut at the places left, new ones added. The
others wait for the next round; as in quicksort with random pivots there are
some log(n) of them. A sequence owns the part of its path below the place where
it was attached, so the trie's nodes are dealt out among the sequences.

Then, round by round backwards, counts run up each owner's edges, and each edge
is expanded into its nodes.

Every step is a join of rows ``(sequence, depth)`` or an aggregate, so neither a
long conversation, nor many that share their start, nor many copies come together
in memory. Two sorted passes see a group in one task, spilling where needed: the
edges of one owner, and the numbers of equal conversations, whose SHA-256 cannot
be taken in parts.

Defined results: conversations without turns are members of the root only; no
conversation, no row; see ``conversations`` for ties, nulls and other columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import stored

#: Running hashes are taken over blocks of so many turns, then over blocks.
BLOCK = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()


def prefixes_of(turns: DataFrame) -> DataFrame:
    """``conv, depth, pa, pb`` (the prefix's hash), ``total`` and ``size``: bytes of the prefix and of its last text.

    ``turns``: ``conv_id``, ``depth`` from 1 without gaps, hashes ``c1`` and ``c2`` of the turn, ``size``.
    """
    rows = turns.select(
        F.col("conv_id").alias("conv"), "depth", "size", F.floor(F.col("depth") / BLOCK).alias("block"),
        F.xxhash64("depth", "c1", "c2").alias("ta"), F.xxhash64("c2", "depth", "c1").alias("tb"),
    )
    upto = W.partitionBy("conv", "block").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    within = rows.select(
        "conv", "depth", "size", "block", F.bit_xor("ta").over(upto).alias("pa"), F.bit_xor("tb").over(upto).alias("pb"),
        F.sum("size").over(upto).alias("total"),
    )
    before = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("ta").alias("a"), F.bit_xor("tb").alias("b"), F.sum("size").alias("s"))
    blocks = blocks.select(
        "conv", "block", F.bit_xor("a").over(before).alias("ba"), F.bit_xor("b").over(before).alias("bb"), F.sum("s").over(before).alias("bs")
    ).where("block > 0")
    zero = F.lit(0).cast("long")
    return within.join(blocks, ["conv", "block"], "left").select(
        "conv", "depth", F.col("pa").bitwiseXOR(F.coalesce("ba", zero)).alias("pa"),
        F.col("pb").bitwiseXOR(F.coalesce("bb", zero)).alias("pb"), (F.col("total") + F.coalesce("bs", zero)).alias("total"), "size",
    )


def fattest(low: Column, high: Column) -> Column:
    """The number in ``(low, high]`` that the greatest power of two divides."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, bits), bits)


def _nowhere(column: str = "rep") -> Column:
    """A depth that no row has, another for each sequence, so that rows without a question do not meet."""
    return -1 - F.pmod(F.xxhash64(column), F.lit(1 << 40))


def _prefix_at(rows: DataFrame, prefixes: DataFrame, conv: str, depth: str, names: tuple[str, str]) -> DataFrame:
    """Add the hash of the prefix of ``conv`` at ``depth``."""
    looked = prefixes.select(
        F.col("conv").alias(conv), F.col("depth").alias(depth), F.col("pa").alias(names[0]), F.col("pb").alias(names[1])
    )
    return rows.join(looked, [conv, depth], "left")


def _fat_search(waiting: DataFrame, edges: DataFrame, prefixes: DataFrame, longest: int) -> DataFrame:
    """Add the last edge whose handle begins the sequence: ``e_owner``, ``e_low``, ``e_high``, ``e_fat``."""
    filed = edges.select(
        F.col("fat").alias("probe"), F.col("ha").alias("qa"), F.col("hb").alias("qb"),
        F.col("owner").alias("m_owner"), F.col("low").alias("m_low"), F.col("high").alias("m_high"),
    )
    none = F.lit(None).cast("long")
    found = ("e_owner", "e_low", "e_high", "e_fat")
    rows = waiting.select("*", F.col("at").alias("a"), F.col("n").alias("b"), *[none.alias(c) for c in found])
    for _ in range(longest.bit_length()):
        left = F.col("a") < F.col("b")
        rows = rows.withColumn("probe", F.when(left, fattest(F.col("a"), F.col("b"))).otherwise(_nowhere()))
        rows = _prefix_at(rows, prefixes, "rep", "probe", ("qa", "qb")).join(filed, ["probe", "qa", "qb"], "left")
        met = F.col("m_high").isNotNull()
        rows = rows.select(
            *waiting.columns,
            F.when(met, F.col("m_high")).otherwise(F.col("a")).alias("a"),
            F.when(met | ~left, F.col("b")).otherwise(F.col("probe") - 1).alias("b"),
            *[F.when(met, F.col(m)).otherwise(F.col(e)).alias(e) for e, m in zip(found, ("m_owner", "m_low", "m_high", "probe"), strict=True)],
        )
    return rows.drop("a", "b")


def _exit_edges(rows: DataFrame, edges: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``rep, n, owner, low, high``: the edge left, or ``low`` and ``high`` null at a node; ``x`` to ``far``: where."""
    matched = F.col("e_owner").isNotNull()
    rows = rows.withColumn("top", F.when(matched, F.least("e_high", "n")).otherwise(_nowhere()))
    rows = _prefix_at(rows, prefixes, "rep", "top", ("sa", "sb"))
    rows = _prefix_at(rows, prefixes, "e_owner", "top", ("oa", "ob"))
    agree = (F.col("sa") == F.col("oa")) & (F.col("sb") == F.col("ob"))
    rows = rows.select(
        "rep", "n", "e_owner", "e_low", "e_high", "e_fat", "top",
        F.coalesce(agree, F.lit(False)).alias("agree"),
        F.coalesce(agree & (F.col("e_high") <= F.col("n")), F.lit(False)).alias("through"), "at", "at_owner",
    )
    inside = matched & ~F.col("through")
    rows = rows.withColumn("node", F.when(F.col("through"), F.col("e_high")).otherwise(F.col("at")))
    rows = rows.withColumn("node_owner", F.when(F.col("through"), F.col("e_owner")).otherwise(F.col("at_owner")))
    asks = ~inside & (F.col("node") < F.col("n"))
    rows = rows.withColumn("next", F.when(asks, F.col("node") + 1).otherwise(_nowhere()))
    children = edges.select(
        (F.col("low") + 1).alias("next"), F.col("ga").alias("qa"), F.col("gb").alias("qb"),
        F.col("owner").alias("c_owner"), F.col("low").alias("c_low"), F.col("high").alias("c_high"),
    )
    rows = _prefix_at(rows, prefixes, "rep", "next", ("qa", "qb")).join(children, ["next", "qa", "qb"], "left")
    child = F.col("c_owner").isNotNull()
    pick = lambda e, c, other: F.when(inside, F.col(e)).when(child, F.col(c)).otherwise(other)
    return rows.select(
        "rep", "n",
        pick("e_owner", "c_owner", F.col("node_owner")).alias("owner"),
        pick("e_low", "c_low", None).alias("low"),
        pick("e_high", "c_high", None).alias("high"),
        F.when(inside & F.col("agree"), F.col("top")).otherwise(pick("e_fat", "next", F.col("node"))).alias("x"),
        F.when(inside, F.col("top")).when(child, F.least("c_high", "n")).otherwise(F.col("node")).alias("far"),
    )


def _exits(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Halve ``x`` to ``far`` until the last depth is found where sequence and edge agree."""
    rows = stored(rows, "exits")
    widest = rows.agg(F.max(F.col("far") - F.col("x"))).first()[0] or 0
    for _ in range(widest.bit_length()):
        left = F.col("x") < F.col("far")
        half = F.expr("(x + far + 1) div 2")
        rows = rows.withColumn("half", F.when(left, half).otherwise(_nowhere()))
        rows = _prefix_at(rows, prefixes, "rep", "half", ("sa", "sb"))
        rows = _prefix_at(rows, prefixes, "owner", "half", ("oa", "ob"))
        agree = F.coalesce((F.col("sa") == F.col("oa")) & (F.col("sb") == F.col("ob")), F.lit(False))
        rows = rows.select(
            "rep", "n", "owner", "low", "high", F.when(left & agree, F.col("half")).otherwise(F.col("x")).alias("x"),
            F.when(left & ~agree, F.col("half") - 1).otherwise(F.col("far")).alias("far"),
        )
    return rows.drop("far")


def _contest(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Mark with ``won`` one of the sequences that leave at one place with one turn; those that end there all win."""
    going = rows.where("x < n").select("rep", (F.col("x") + 1).alias("next"))
    going = _prefix_at(going, prefixes, "rep", "next", ("qa", "qb"))
    first = going.groupBy("next", "qa", "qb").agg(F.min(F.struct(F.xxhash64("rep", F.lit("order")), "rep")).alias("first"))
    winners = first.select(F.col("first.rep").alias("rep"), F.lit(True).alias("chosen"))
    return rows.join(winners, "rep", "left").select(
        *rows.columns, (F.col("x").eqNullSafe(F.col("n")) | F.col("chosen").isNotNull()).alias("won")
    )


def _inserted(edges: DataFrame | None, outcome: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The edges cut where sequences left them, and the winners' new ones."""
    leaves = outcome.where("won AND x < n").select(F.col("rep").alias("owner"), F.col("x").alias("low"), F.col("n").alias("high"))
    fresh, kept = leaves, None
    if edges is not None:
        cuts = outcome.where("low < x AND x < high").select("owner", "low", "high", F.col("x").alias("end")).distinct()
        kept = edges.join(cuts, ["owner", "high"], "left_anti")
        ends = cuts.union(cuts.select("owner", "low", "high", F.col("high").alias("end")).distinct())
        last = F.lag("end").over(W.partitionBy("owner", "high").orderBy("end"))
        fresh = leaves.union(ends.select("owner", F.coalesce(last, F.col("low")).alias("low"), F.col("end").alias("high")))
    fresh = fresh.withColumn("fat", fattest(F.col("low"), F.col("high"))).withColumn("next", F.col("low") + 1)
    fresh = _prefix_at(fresh, prefixes, "owner", "fat", ("ha", "hb"))
    fresh = _prefix_at(fresh, prefixes, "owner", "next", ("ga", "gb")).drop("next")
    return stored(fresh if kept is None else kept.unionByName(fresh), "edges")


def build(sequences: DataFrame, prefixes: DataFrame) -> tuple[DataFrame | None, DataFrame | None, int]:
    """Edges ``(owner, low, high, ...)``, attachments ``(rep, n, owner, x, round)``, and the number of rounds.

    ``sequences``: ``rep`` and length ``n`` of distinct sequences. A null owner is the root.
    """
    none = F.lit(None).cast("long")
    waiting = sequences.select("rep", "n", F.lit(0).cast("long").alias("at"), none.alias("at_owner"))
    edges, attached, rounds = None, [], 0
    while True:
        seen = waiting.agg(F.count("*").alias("rows"), F.max("n").alias("longest")).first()
        if not seen["rows"]:
            break
        rounds += 1
        if edges is None:
            left = waiting.select("rep", "n", none.alias("owner"), none.alias("low"), none.alias("high"), F.col("at").alias("x"))
        else:
            found = _fat_search(waiting, edges, prefixes, seen["longest"])
            left = _exits(_exit_edges(found, edges, prefixes), prefixes)
        outcome = stored(_contest(left, prefixes), "outcome")
        attached.append(outcome.where("won").select("rep", "n", "owner", "x", F.lit(rounds).alias("round")))
        edges = _inserted(edges, outcome, prefixes)
        waiting = outcome.where("NOT won").select("rep", "n", F.col("x").alias("at"), F.col("owner").alias("at_owner"))
    return edges, reduce(DataFrame.union, attached) if attached else None, rounds


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(n, fa, fb, conv)`` in order: the least conv of each sequence and the digest of all, joined by commas."""
    schema = pa.schema([("rep", pa.int64()), ("ends_sha256", pa.string())])
    at, rep, digest = None, 0, hashlib.sha256()
    for batch in batches:
        reps, digests = [], []
        *keys, convs = (c.to_pylist() for c in batch.columns)
        for key, conv in zip(zip(*keys, strict=True), convs, strict=True):
            if key == at:
                digest.update(b",%d" % conv)
                continue
            if at is not None:
                reps.append(rep)
                digests.append(digest.hexdigest())
            at, rep, digest = key, conv, hashlib.sha256(b"%d" % conv)
        yield pa.record_batch([pa.array(reps, pa.int64()), pa.array(digests, pa.string())], schema=schema)
    if at is not None:
        yield pa.record_batch([pa.array([rep]), pa.array([digest.hexdigest()])], schema=schema)


def _counted(edges: DataFrame, attached: DataFrame, weights: DataFrame, prefixes: DataFrame, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Edges with ``n_convs, conv_id, n_leaves, saved, kids`` at their upper end, and what hangs on the root."""
    owners = attached.join(weights, "rep").where("x < n").select(
        F.col("rep").alias("owner"), "w", F.col("n").alias("n_own"), F.col("x").alias("x_own"), F.col("owner").alias("up"), "round"
    )
    kids = attached.where("x < n AND owner IS NOT NULL").groupBy("owner", F.col("x").alias("high")).agg(F.count("*").alias("kids"))
    edges = edges.select("owner", "low", "high").join(owners, "owner").join(kids, ["owner", "high"], "left")
    for depth, name in (("high", "to"), ("low", "from")):
        edges = edges.join(
            prefixes.select(F.col("conv").alias("owner"), F.col("depth").alias(depth), F.col("total").alias(name)), ["owner", depth], "left"
        )
    edges = edges.fillna(0, ["kids", "from"]).withColumn("bytes", F.col("to") - F.col("from")).drop("to")
    edges = stored(edges, "compact")
    zero = F.lit(0).cast("long")
    hung = [
        attached.join(weights, "rep").where("x = n").select(
            "owner", "x", F.col("w").alias("n_convs"), F.col("rep").alias("conv_id"), zero.alias("n_leaves"), zero.alias("saved"), zero.alias("kid")
        )
    ]
    done = []
    up = W.partitionBy("owner").orderBy(F.desc("high")).rowsBetween(W.unboundedPreceding, 0)
    for number in range(rounds, 0, -1):
        given = reduce(DataFrame.union, hung).where("owner IS NOT NULL").groupBy("owner", F.col("x").alias("high")).agg(
            F.sum("n_convs").alias("g_convs"), F.min("conv_id").alias("g_conv"), F.sum("n_leaves").alias("g_leaves"), F.sum("saved").alias("g_saved")
        )
        rows = edges.where(F.col("round") == number).join(given, ["owner", "high"], "left").fillna(0, ["g_convs", "g_leaves", "g_saved"])
        leaf = ((F.col("high") == F.col("n_own")) & (F.col("kids") == 0)).cast("long")
        rows = rows.select(
            *edges.columns,
            (F.col("w") + F.sum("g_convs").over(up)).alias("n_convs"),
            F.least("owner", F.min("g_conv").over(up)).alias("conv_id"),
            F.sum(F.col("g_leaves") + leaf).over(up).alias("n_leaves"), "g_saved",
        )
        rows = rows.withColumn("saved", F.sum((F.col("n_convs") - 1) * F.col("bytes") + F.col("g_saved")).over(up)).drop("g_saved")
        rows = stored(rows, "counted")
        done.append(rows)
        hung.append(rows.where("low = x_own").select(
            F.col("up").alias("owner"), F.col("x_own").alias("x"), "n_convs", "conv_id", "n_leaves", "saved", F.lit(1).cast("long").alias("kid")
        ))
    return reduce(DataFrame.union, done), reduce(DataFrame.union, hung).where("owner IS NULL")


def nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every node of the trie of conversations: see the module's text and the columns below.

    ``turns`` as in ``prefixes_of``; ``lengths``: ``conv_id`` and ``n`` of every conversation, also of those without turns.
    """
    prefixes = stored(prefixes_of(turns), "prefixes")
    last = prefixes.groupBy("conv").agg(F.max_by(F.struct("pa", "pb"), "depth").alias("last"))
    whole = lengths.join(last, lengths["conv_id"] == last["conv"], "left").select(
        "n", F.col("last.pa").alias("fa"), F.col("last.pb").alias("fb"), "conv_id"
    ).fillna(0, ["fa", "fb"])
    whole = stored(whole, "whole")
    weights = stored(whole.groupBy("n", "fa", "fb").agg(F.min("conv_id").alias("rep"), F.count("*").alias("w")), "sequences")
    prefixes = stored(prefixes.join(weights.select(F.col("rep").alias("conv")), "conv", "left_semi"), "prefixes")
    edges, attached, rounds = build(weights.select("rep", "n"), prefixes)
    if attached is None:
        edges, attached, rounds = _nothing(weights)
    counted, root = _counted(edges, attached, weights.select("rep", "w"), prefixes, rounds)
    keys = ["n", "fa", "fb"]
    ends = whole.repartition(*keys).sortWithinPartitions(*keys, "conv_id").mapInArrow(_ends, "rep long, ends_sha256 string")
    at_own = attached.where("x < n").select(F.col("rep").alias("owner"), F.col("n").alias("high"), "rep")
    at_other = attached.where("x = n").select("owner", F.col("x").alias("high"), "rep")
    ends = stored(at_own.union(at_other).join(ends, "rep").drop("rep"), "ends")
    least, at_root = root.agg(F.min("conv_id")).first()[0], ends.where("owner IS NULL").first()
    top = root.agg(
        F.min("conv_id").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.sum("n_convs").alias("n_convs"), F.sum("kid").alias("n_children"), F.greatest(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"), F.lit(at_root["ends_sha256"] if at_root else NO_ENDS).alias("ends_sha256"),
    ).where("n_convs > 0")
    # The node above an owner's first edge is the end of an edge of the sequence it hangs on, or the root.
    above = counted.select(F.col("owner").alias("up"), F.col("high").alias("x_own"), F.col("conv_id").alias("hung_on"))
    rows = counted.join(above, ["up", "x_own"], "left")
    before = F.lag("conv_id").over(W.partitionBy("owner").orderBy("high"))
    rows = rows.withColumn("above", F.when(F.col("low") > F.col("x_own"), before).otherwise(F.coalesce("hung_on", F.lit(least))))
    return _expanded(rows.join(ends, ["owner", "high"], "left"), prefixes).unionByName(top)


def _nothing(weights: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    none = weights.where("false").select("rep", "n", F.col("rep").alias("owner"), F.col("n").alias("x"), F.lit(1).alias("round"))
    return none.select("owner", F.col("x").alias("low"), F.col("n").alias("high")), none, 1


def _expanded(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """A row for each depth of each edge, exploded block by block of depths."""
    blocks = F.sequence(F.floor((F.col("low") + 1) / BLOCK), F.floor(F.col("high") / BLOCK))
    rows = rows.withColumn("block", F.explode(blocks))
    depths = F.sequence(F.greatest(F.col("block") * BLOCK, F.col("low") + 1), F.least((F.col("block") + 1) * BLOCK - 1, F.col("high")))
    rows = rows.withColumn("depth", F.explode(depths)).join(
        prefixes.select(F.col("conv").alias("owner"), "depth", "total", "size"), ["owner", "depth"]
    )
    at_end, others = F.col("depth") == F.col("high"), F.col("n_convs") - 1
    return rows.select(
        "conv_id", "depth",
        F.when(F.col("depth") > F.col("low") + 1, F.col("conv_id")).otherwise(F.col("above")).alias("parent_conv_id"),
        "n_convs",
        F.when(at_end, F.col("kids") + (F.col("high") < F.col("n_own")).cast("long")).otherwise(1).alias("n_children"),
        "n_leaves",
        (F.col("saved") - others * (F.col("total") - F.col("size") - F.col("from"))).alias("saved_tokens"),
        F.when(at_end, F.coalesce("ends_sha256", F.lit(NO_ENDS))).otherwise(NO_ENDS).alias("ends_sha256"),
    )
