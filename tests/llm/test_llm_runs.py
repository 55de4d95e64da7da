import hashlib
import random
import zlib
from fractions import Fraction

import brute
import cases
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from skyledger.llm import periodic_runs, queries
from skyledger.llm.base import table
from skyledger.llm.suffix_array import SuffixArray

SF = "/root/testdata/sf0.001"
SYMBOLS = st.lists(st.lists(st.integers(0, 2), max_size=40), min_size=1, max_size=5)


def arrays(sequences):
    ends = np.cumsum([len(s) for s in sequences])
    return np.array([x for s in sequences for x in s], np.int64), ends


@settings(max_examples=200, deadline=None)
@given(SYMBOLS)
def test_suffix_array(sequences):
    symbols, ends = arrays(sequences)
    array = SuffixArray(symbols, ends)
    tagged = [(k, x) for k, s in enumerate(sequences) for x in s]
    assert sorted(array.order.tolist()) == list(range(len(tagged)))
    shared = lambda a, b: next((n for n in range(len(tagged)) if max(a, b) + n >= len(tagged) or tagged[a + n] != tagged[b + n]), len(tagged))
    for k in range(1, len(tagged)):
        assert array.common[k] == shared(array.order[k - 1], array.order[k])
    # Suffixes with one start lie side by side.
    depth, low, high, splits = array.intervals(1)
    for d, a, b in zip(depth, low, high, strict=True):
        start = tagged[array.order[a] : array.order[a] + d]
        inside = [k for k, i in enumerate(array.order) if tagged[i : i + d] == start]
        assert inside == list(range(a, b + 1))
    assert (splits >= 0).sum() == (array.common > 0).sum()


@settings(max_examples=300, deadline=None)
@given(SYMBOLS, st.sampled_from([(6, 4), (2, 2), (5, 3)]))
def test_runs_equal_brute_force(sequences, least):
    symbols, ends = arrays(sequences)
    found = {k: [] for k in range(len(sequences))}
    for s, n, p in zip(*periodic_runs.find_runs(symbols, ends, *least), strict=True):
        k = int(np.searchsorted(ends, s, "right"))
        found[k].append((int(s - ends[k] + len(sequences[k])), int(n), int(p)))
    assert found == {k: brute.runs(s, *least) for k, s in enumerate(sequences)}


def test_one_word_many_times():
    start, length, period = periodic_runs.find_runs(np.zeros(100_000, np.int64), np.array([100_000]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [100_000], [1])


def expected(doc_id, text):
    """The query's row for one document, from the brute-force runs."""
    words = brute.WORDS.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute.runs(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)))


def order(row):
    return tuple((x is None, x) for x in row)


def test_query_equals_brute_force(spark):
    rows = queries.op11_periodic_runs(spark, SF).collect()
    docs = table(spark, SF, "documents").select("doc_id", "text").collect()
    assert sorted(map(tuple, rows), key=order) == sorted((expected(*d) for d in docs), key=order)
    assert sum(r["n_runs"] > 0 for r in rows) > len(docs) / 20


def test_odd_rows(spark):
    draw = random.Random(4)
    texts = [
        *cases.texts(), "a " * 5, "a " * 6, "a b " * 4, "a b " * 3 + "a", "x\x85y " * 8, "é\xa0 " * 9, "a b c\n" * 5 + "a",
        " ".join(draw.choice("ab") for _ in range(3000)), "Again and again. " * 20_000,
    ]
    rows = [*enumerate(texts), (None, "a b " * 9), (None, None), (1, "q " * 9), (1, "q " * 9)]
    got = periodic_runs.report(cases.documents(spark, rows), queries.planted).collect()
    long = "Again and again. " * 20_000
    assert sorted((tuple(r) for r in got if r["length"] != 60_000), key=order) == sorted((expected(*r) for r in rows if r[1] != long), key=order)
    assert [(r["start"], r["period"]) for r in got if r["length"] == 60_000] == [(0, 3)]


def test_general_outputs(spark):
    rows = [(1, "go  go\tgo go go go home"), (2, "one two"), (3, None)]
    got = {r["doc_id"]: r for r in periodic_runs.detect(cases.documents(spark, rows)).collect()}
    assert got[1]["collapsed"] == "go home" and [tuple(x) for x in got[1]["runs"]] == [(0, 6, 1)]
    assert got[2]["collapsed"] == "one two" and got[2]["runs"] == [] and got[3]["collapsed"] == "" and got[3]["n_words"] == 0
    looser = periodic_runs.detect(cases.documents(spark, [(1, "a b a b a b c")]), least_words=4, least_periods=2).first()
    assert [tuple(x) for x in looser["runs"]] == [(0, 6, 2)]
    assert periodic_runs.report(cases.empty(spark)).count() == 0
