import random

import brute
import duckdb
import pytest
from pyspark.sql import functions as F

from skyledger.llm import conversations, prefix_trie, queries
from skyledger.llm.base import table

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, depth string, rep int, n string, owner int, conv string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, "z") for r in rows], TURNS).repartition(3)


def run(df):
    """Rows by depth, then conversation; the columns are the contract's."""
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in df.dtypes[:-1]} == {"bigint"}
    return sorted(map(tuple, df.collect()), key=lambda r: (r[1], r[0]))


def of_sequences(spark, sequences):
    """The trie of ``{conv: turns}``, without the rebuilding."""
    rows = [(c, d, r, t) for c, turns in sequences.items() for d, (r, t) in enumerate(turns)]
    placed = conversations.placed(frame(spark, rows)).withColumnRenamed("place", "depth")
    lengths = spark.createDataFrame([(c, len(t)) for c, t in sequences.items()], "conv_id long, n long")
    return run(prefix_trie.nodes(placed, lengths))


def rows_of(draw, n):
    """Families that share starts, copies, ties, nulls, and conversations of one turn."""
    out = []
    for c in range(n):
        for t in range(draw.randint(1, 9)):
            out.append((c, draw.choice([t, t, None, 3]), draw.choice(["user", None, "é"]), draw.choice(["a", "b", "", None, "ßß"])))
    return out


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert run(queries.op13_prefix_trie(spark, SF)) == brute.trie(brute.rebuilt_conversations(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_rebuilt_equal_brute_force(spark, seed):
    draw = random.Random(seed)
    rows = rows_of(draw, 60) + [(None, 1, "user", "nobody's"), (7, 2, "user", "a"), (7, 2, "user", "a"), (1000, 0, "u", "x"), (1000, 1, "u", "y")]
    got = run(prefix_trie.nodes(*conversations.rebuilt(frame(spark, rows))))
    assert got == brute.trie(brute.rebuilt_conversations(rows))


def test_shapes(spark):
    turn = lambda k: ("user", f"t{k}" * (k % 3 + 1))
    chain = {100 - k: [turn(j) for j in range(k)] for k in range(25)}  # each begins the next, one is empty
    copies = {k: [turn(1), turn(2)] for k in range(200, 230)}
    fan = {k: [turn(1), turn(k)] for k in range(300, 330)}
    long = {400: [turn(j % 7) for j in range(300)], 401: [turn(j % 7) for j in range(257)] + [turn(9)]}
    everything = chain | copies | fan | long
    assert of_sequences(spark, everything) == brute.trie(everything)
    assert of_sequences(spark, {-5: []}) == brute.trie({-5: []})


def test_blocks_of_depths(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    draw = random.Random(3)
    sequences = {c: [("u", draw.choice("ab")) for _ in range(draw.randint(0, 40))] for c in range(30)}
    sequences |= {c + 100: s + [("u", "c")] * 9 for c, s in sequences.items()}
    assert of_sequences(spark, sequences) == brute.trie(sequences)


def test_empty_table(spark):
    assert run(prefix_trie.nodes(*conversations.rebuilt(frame(spark, [])))) == []
    assert run(prefix_trie.nodes(*conversations.rebuilt(frame(spark, [(None, 1, "u", "x")])))) == []


def test_places_of_a_conversation_over_many_slices(spark):
    rows = [(c, t, "u", str(t)) for c in (1, 2) for t in range(2000 if c == 1 else 3)]
    got = conversations.placed(frame(spark, rows).repartition(8))
    assert got.where("conv_id = 1").agg(F.count_distinct("place"), F.min("place"), F.max("place")).first()[:] == (2000, 1, 2000)


def test_fattest_number(spark):
    pairs = [(a, b) for a in range(70) for b in range(a + 1, 70)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b"))).collect()
    assert all(f == max(range(a + 1, b + 1), key=lambda x: x & -x) for a, b, f in got)


def test_sql_on_odd_rows(spark):
    """The SQL says the same as the slow version, ties and nulls included."""
    rows = rows_of(random.Random(8), 40)
    db = duckdb.connect()
    db.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    db.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = sorted(db.sql(queries.SQL["op13_prefix_trie"]).fetchall(), key=lambda r: (r[1], r[0]))
    assert got == brute.trie(brute.rebuilt_conversations(rows))
