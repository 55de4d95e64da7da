import random

import brute
import cases
import numpy as np
import pytest

from skyledger.llm import bitslice, bwt, graph, line_dedup, simhash, suffix_dedup, topk
from pyspark.sql import functions as F


def numbered(rows):
    return list(enumerate(rows))


def test_components_of_chains_stars_and_loops(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200), (200, 300), (300, 301)]
    got = dict(graph.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 300: 200, 301: 200}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bit_planes_count_exactly():
    draw = np.random.default_rng(1)
    for _ in range(12):
        base = draw.integers(0, 2**63, 3, dtype=np.uint64)
        flip = lambda: np.uint64(1) << draw.integers(0, 64, 60, dtype=np.uint64)  # noqa: B023, E731
        v = np.unique(np.concatenate([b ^ flip() ^ flip() for b in base]))
        for radius in (0, 1, 2, 3, 6):
            near = bitslice.near_pairs(v[:-1], v[1:], radius).tolist()
            assert near == [i for i in range(len(v) - 1) if int(v[i] ^ v[i + 1]).bit_count() <= radius]
            mine, all_links = brute.Sets(), brute.Sets()
            for a, b in zip(*bitslice.forest(v, radius), strict=True):
                assert int(a ^ b).bit_count() <= radius and mine.find(int(a)) != mine.find(int(b))
                mine.join(int(a), int(b))
            for i in v.tolist():
                for j in v.tolist():
                    if (i ^ j).bit_count() <= radius:
                        all_links.join(i, j)
            assert [mine.find(x) for x in v.tolist()] == [all_links.find(x) for x in v.tolist()]


def test_masks_hold_every_close_pair():
    draw = random.Random(1)
    masks = [m & (2**64 - 1) for m in simhash.masks(2)]
    for _ in range(300):
        x = draw.getrandbits(64)
        y = x ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64))
        assert any(x & m == y & m for m in masks)


@pytest.mark.parametrize("small", [1, 32])
def test_simhash_equals_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(simhash, "SMALL", small)
    rows = numbered(cases.texts())
    many = rows[2][1].split()
    for k in range(40):  # a family of near copies
        rows.append((500 + k, " ".join([*many[: 5 + k % 7], "x", *many[5 + k % 7 :]])))
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(cases.documents(spark, rows)).collect()}
    assert got == brute.simhash_components(rows)
    docs = cases.documents(spark, [*rows, (None, rows[0][1]), (None, "all by itself"), (3, "with the same id")])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    want = {c for _, c in got.values()}
    assert {i for i in ids if i is not None} - want <= {3} and want <= set(ids) and ids.count(None) == 1


def test_each_component_keeps_one_text(spark):
    """Components that share an id, or have none, do not push each other out."""
    a, b, c, d = (f"{w} " * 3 + " ".join(f"{w}{k}" for k in range(20)) for w in ("ash", "birch", "cedar", "dogwood"))
    rows = [(None, a), (None, a + "\n"), (None, b), (None, c), (7, c), (9, c), (8, a.replace("ash", "elm")), (8, d)]
    kept = [tuple(r) for r in simhash.one_of_each(cases.documents(spark, rows)).select("doc_id", "text").collect()]
    assert sorted(t.strip() for k, t in kept if k is None) == [a.strip(), b.strip()]
    assert sorted(x for x in kept if x[0] is not None) == sorted([(7, c), *rows[6:]])


def test_repeated_rows_stay_once(spark):
    a, b = (" ".join(f"{w}{k}" for k in range(20)) for w in ("ash", "birch"))
    rows = [(4, a)] * 3 + [(None, b)] * 3 + [(6, None)] * 2 + [(9, a)]
    kept = simhash.one_of_each(cases.documents(spark, rows))
    assert kept.columns == cases.documents(spark, rows).columns
    assert {(r["doc_id"], r["text"]) for r in kept.collect()} == {(4, a), (None, b), (6, None)} and kept.count() == 3


def test_empty_tables(spark):
    nothing = cases.empty(spark)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0
    assert suffix_dedup.report(nothing).count() == 0 and suffix_dedup.cut(nothing).count() == 0
    assert line_dedup.report(nothing).count() == 0 and line_dedup.dedup(nothing).count() == 0


@pytest.mark.parametrize("clear", [1, 2, 20])
def test_transforms_find_all_repeats(monkeypatch, clear):
    monkeypatch.setattr(bwt, "CLEAR", clear)
    draw = random.Random(3)
    for _ in range(120):
        letters = draw.choice([b"ab\0", b"abcdefgh"])
        strings = [bytes(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(draw.randint(1, 12))]
        strings += [s[draw.randint(0, 9) :] + b"x" for s in strings[: draw.randint(0, 4)]]
        for length in (3, 6, 11, 25):
            got, want = {}, {}
            for i, s, o in zip(*bwt.repeats(strings, length, 20), strict=True):
                got.setdefault(int(i), set()).add((int(s), int(o)))
            for s, x in enumerate(strings):
                for o in range(len(x) - length + 1):
                    want.setdefault(x[o : o + length], set()).add((s, o))
            assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_contexts_cover_every_window_once():
    draw = random.Random(4)
    texts = [bytes(draw.choice(b"abc ") for _ in range(n)) for n in (0, 99, 100, 101, 700, 3000, 5)] + [b"a" * 400]
    raw, ends = b"".join(texts), np.cumsum([len(t) for t in texts]).tolist()
    first, last, _ = suffix_dedup.contexts(raw, ends)
    windows = [s for a, b in zip(first.tolist(), last.tolist(), strict=True) for s in range(a, b + 1)]
    want = [e - len(t) + k for e, t in zip(ends, texts, strict=True) for k in range(max(0, len(t) - 99))]
    assert windows == want
    assert all(b - a <= 100 - suffix_dedup.GRAM for a, b in zip(first.tolist(), last.tolist(), strict=True))


@pytest.mark.parametrize("most, buffer", [(1000, 1 << 20), (1, 1 << 20), (1000, 700)])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, most, buffer):
    monkeypatch.setattr(suffix_dedup, "BUFFER", buffer)
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 5000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 1000)
    rows = numbered(cases.texts())
    want, kept = brute.repeated_bytes(rows)
    docs = cases.documents(spark, rows)
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.report(docs, most=most).collect()}
    assert got == want
    cut = suffix_dedup.cut(docs, most=most)
    assert cut.columns == docs.columns
    shown = {r["doc_id"]: r["text"] for r in cut.collect()}
    assert shown == {k: None if t is None else kept[k].decode("utf-8", "ignore") for k, t in rows}


@pytest.mark.parametrize("gram", [32, 64, 92, 96, 100])
def test_grams_of_any_length(gram):
    draw = random.Random(gram)
    raw = bytes(draw.choice(b"ab") for _ in range(400)) * 2
    found = suffix_dedup._grams(np.frombuffer(raw, np.uint8), gram)
    by_hash, by_bytes = {}, {}
    for k in range(len(raw) - gram + 1):
        by_hash.setdefault(int(found[k]), []).append(k)
        by_bytes.setdefault(raw[k : k + gram], []).append(k)
    assert len(found) == len(raw) - gram + 1 and sorted(by_hash.values()) == sorted(by_bytes.values())


def test_a_passage_with_many_endings(spark):
    """Hundreds of texts share a passage and differ right after it: contexts that many grams long agree."""
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abcdefgh", k=5))
    passage = " ".join(word() for _ in range(40))
    rows = [(k, f"{word()} {word()} {passage[: draw.choice([240, 150, 239])]}{word()} {' '.join(word() for _ in range(20))}") for k in range(300)]
    want, _ = brute.repeated_bytes(rows)
    for most in (1, 20, 1000):
        got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.report(cases.documents(spark, rows), most=most).collect()}
        assert got == want


def test_passages_of_rows_without_id_and_equal_rows(spark):
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(5, text), (None, text), (5, text), (6, "before " + text)]
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["n_removed"]) for r in suffix_dedup.report(cases.documents(spark, rows)).collect()))
    size = len(text)
    assert got == [(False, 0, 0), (True, 5, size), (True, 5, size), (True, 6, size)]


def test_lines_equal_brute_force(spark):
    rows = numbered(cases.texts())
    docs = cases.documents(spark, rows)
    want = brute.removed_lines(rows)
    report = {r["doc_id"]: r for r in line_dedup.report(docs).collect()}
    assert {k: list(r["removed"]) for k, r in report.items()} == want
    kept = {k: None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in want[k]) for k, t in rows}
    assert {k: r["kept_text"] for k, r in report.items()} == kept
    cut = line_dedup.dedup(docs)
    assert cut.columns == docs.columns and {r["doc_id"]: r["text"] for r in cut.collect()} == kept


def test_line_groups_without_shared_smallest(spark):
    """Chains, and families of many near lines, through the second look."""
    draw = random.Random(8)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(200)]
    rows = []
    for _ in range(6):
        line = draw.sample(words, 30)
        for _ in range(25):
            line = list(line)
            line[draw.randrange(30)] = draw.choice(words)
            rows.append((len(rows), " ".join(line)))
    got = {r["doc_id"]: list(r["removed"]) for r in line_dedup.report(cases.documents(spark, rows)).collect()}
    want = brute.removed_lines(rows)
    # Pairs at the threshold meet in a bucket with probability 0.997.
    assert sum(got[k] != want[k] for k in want) <= 2


def template_lines(n, seed=3):
    """Lines of 30 words, two of them changed in each."""
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(200)]
    line = draw.sample(words, 30)
    rows = []
    for k in range(n):
        own = list(line)
        for i in draw.sample(range(30), 2):
            own[i] = draw.choice(words)
        rows.append((k, " ".join(own)))
    return rows


def test_pairs_grow_with_the_lines_of_a_template(spark, monkeypatch):
    """Four times the lines of one template are at most five times the pairs that are looked at."""
    seen, real = [], line_dedup._likely

    def counted(pairs, signed):
        seen.append(pairs.count())
        return real(pairs, signed)

    monkeypatch.setattr(line_dedup, "_likely", counted)
    totals = []
    for n in (150, 600):
        seen.clear()
        rows = template_lines(n)
        got = {r["doc_id"]: list(r["removed"]) for r in line_dedup.report(cases.documents(spark, rows)).collect()}
        totals.append(sum(seen))
        want = brute.removed_lines(rows)
        # No link is made up; some at the very threshold are not met.
        assert sum(map(len, got.values())) <= sum(map(len, want.values()))
        assert sum(got[k] != want[k] for k in want) <= n // 10
    assert totals[1] <= 5 * totals[0] and totals[1] < 600 * (8 + 24 * line_dedup.NEAR)


def test_a_big_bucket_loses_no_link(spark):
    """Links that no order puts side by side are met by rare shingles."""
    rows = template_lines(600)
    got = {r["doc_id"]: list(r["removed"]) for r in line_dedup.report(cases.documents(spark, rows)).collect()}
    want = brute.removed_lines(rows)
    assert sum(map(len, want.values())) > 100
    # Pairs at the threshold share a bucket with probability 0.997, and 15 of 24 rows with 0.99.
    assert sum(got[k] != want[k] for k in want) <= 3


def test_rare_shingles_lose_no_similar_pair(spark):
    """Every similar pair of different components, and none of the biggest with itself."""
    lines = [t for _, t in template_lines(300, seed=5)] + ["short", "shorter", "short one", "a longer line that stands alone here"]
    rows = [(k, k, t) for k, t in enumerate(lines)]
    texts = spark.createDataFrame(rows, "a long, b long, line string")
    sets = [{t[i : i + 8] for i in range(max(1, len(t) - 7))} for t in lines]
    for component in ("a", "IF(a < 200, 0, a)"):
        rest = texts.selectExpr("a", f"CAST({component} AS long) AS component")
        own = {r["a"]: r["component"] for r in rest.collect()}
        met = line_dedup._by_rare_shingles(rest, texts, 8, 0.8).collect()
        pairs = {(r["x"], r["y"]) for r in met}
        want = {
            (x, y) for x in own for y in own if x < y and own[x] != own[y]
            and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])
        }
        assert want and want <= pairs and len(pairs) == len(met) and all(own[x] != own[y] for x, y in pairs)
        assert len(pairs) < 10 * len(lines)


@pytest.mark.parametrize("hot", [1, 50, 4096])
def test_frequent_shingles_stay_with_their_lines(spark, monkeypatch, hot):
    """Of a template's lines only the shingles off the list of frequent ones travel, and no similar pair is lost."""
    lines = [t for _, t in template_lines(200, seed=9)]
    texts = spark.createDataFrame([(k, k, t) for k, t in enumerate(lines)], "a long, b long, line string")
    sets = [{t[i : i + 8] for i in range(len(t) - 7)} for t in lines]
    kept, real = {}, line_dedup.stored

    def watched(df, label):
        kept[label] = real(df, label)
        return kept[label]

    monkeypatch.setattr(line_dedup, "stored", watched)
    monkeypatch.setattr(line_dedup, "HOT", hot)
    met = line_dedup._by_rare_shingles(texts.selectExpr("a", "a AS component"), texts, 8, 0.8).collect()
    pairs = {(r["x"], r["y"]) for r in met}
    same = {(x, y) for y in range(200) for x in range(y) if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
    assert same and same <= pairs and len(pairs) == len(met)
    assert kept["shingles"].count() == 200  # a row a line, not a shingle


def test_stars_cost_no_round(spark, monkeypatch):
    """Components found before and a few links more take fewer steps than all links again."""
    steps, real = [], graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, label: (steps.append(label), real(df, label))[1])
    stars = spark.createDataFrame([(10 * (k // 10), k) for k in range(100)], "a long, b long")
    first = graph.components(stars)
    assert steps == ["edges"] and dict(first.collect()) == {k: 10 * (k // 10) for k in range(100)}
    steps.clear()
    both = graph.components(first.toDF("a", "b").union(spark.createDataFrame([(15, 27)], "a long, b long")))
    assert dict(both.collect())[29] == 10 and steps.count("small-star") <= 2


def test_shingles_of_any_characters(spark):
    """Sets and signatures hold each shingle of eight characters, however many bytes a character has."""
    texts = ["", "a", "sevenxx", "eight888", "ninenine9", "é" * 40 + "ß", "日本語の文章です" * 9, "🙂🙃" * 20 + "end", "plain words " * 150]
    rows = [(k, k, x) for k, x in enumerate(texts)] + [(4, 4, texts[4])] * 2
    lines = spark.createDataFrame(rows, "a long, b long, line string").repartition(3)
    sizes = {r["a"]: r["m"] for r in lines.select("a", F.size(line_dedup.shingle_set(F.col("line"))).alias("m")).collect()}
    assert sizes == {k: len({x[i : i + 8] for i in range(max(1, len(x) - 7))}) for k, x in enumerate(texts)}
    signed = {r["a"]: (r["n"], tuple(r["mins"])) for r in line_dedup.signatures(lines).collect()}
    assert len(signed) == len(texts) and [k for k, (n, _) in signed.items() if n > 1] == [4] and signed[4][0] == 3
    alike = line_dedup.signatures(spark.createDataFrame([(1, 1, "plain words " * 90)], "a long, b long, line string")).first()
    assert tuple(alike["mins"]) == signed[8][1]  # the same set


def test_texts_stay_and_sets_are_made_once(spark, monkeypatch):
    """No text travels for the signatures; a pair's two sets are each worked out once, and of a list only its first part is unrolled."""
    plans, real = {}, line_dedup.stored

    def watched(df, label):
        plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, label)

    monkeypatch.setattr(line_dedup, "stored", watched)
    lines = spark.createDataFrame([(k, k, t) for k, t in template_lines(60)], "a long, b long, line string")
    signed = line_dedup.signatures(lines)
    shuffled = [x for x in signed._jdf.queryExecution().sparkPlan().toString().split("\n") if "Aggregate" in x]
    assert shuffled and not any("line" in x or "wide" in x for x in shuffled)
    pairs = spark.createDataFrame([(x, y) for x in range(60) for y in range(x)], "y long, x long")
    sets = [{t[i : i + 8] for i in range(len(t) - 7)} for _, t in template_lines(60)]
    got = {(r["xa"], r["ya"]) for r in line_dedup._verified(pairs, lines, 8, 0.8).collect()}
    assert got == {(x, y) for y in range(60) for x in range(y) if len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y])}
    assert plans["links"].count("array_distinct(") == 2 and plans["links"].count("array_intersect(") == 1
    line_dedup._by_rare_shingles(lines.selectExpr("a", "a AS component"), lines, 8, 0.8)
    assert plans["prefixes"].count("posexplode(slice(") == 2


def test_lines_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute.removed_lines([tuple(r) for r in docs.select("doc_id", "text").collect()])
    got = {r["doc_id"]: set(r["removed"]) for r in line_dedup.report(docs).collect()}
    total = sum(map(len, want.values()))
    assert total > 1000 and sum(len(got[k] & set(v)) for k, v in want.items()) >= 0.99 * total
    assert sum(len(got[k] - set(v)) for k, v in want.items()) <= 0.01 * total


SPLIT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_a_hot_line_and_a_hot_bucket_are_split(spark, monkeypatch):
    """A third of all lines is one line: the joins by line, bucket and component cut it into several tasks."""
    draw = random.Random(2)
    words = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(3000)]
    rows = [(k, "\n".join(["the one line that all of them share", " ".join(draw.sample(words, 9)), " ".join(draw.sample(words, 9))])) for k in range(4000)]
    docs = cases.documents(spark, rows).repartition(24)
    plans, real = {}, line_dedup.stored

    def watched(df, label):
        out = real(df, label)
        # The plan as it ran last: the write's own is not at hand, so it is run once more.
        if label == "copied":
            df.collect()
            plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return out

    monkeypatch.setattr(line_dedup, "stored", watched)
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    try:
        gone = line_dedup.removed_lines(docs)
        found = gone.collect()
        last = gone._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in SPLIT:
            spark.conf.unset(key)
    assert sum(len(r["gone"]) for r in found) == 3999
    assert "(skew=true)" in plans["copied"] and "(skew=true)" in last


def test_a_hot_node_is_split(spark, monkeypatch):
    """The joins of both stars cut a node with thousands of neighbours into several tasks."""
    hub, real, plans = 100_000, graph.stored, {}
    edges = [(0, k) for k in range(1, 4000)] + [(hub, k) for k in range(20_000, 24_000)]
    edges += [(k, k + 1) for k in range(10_000, 16_000, 2)]

    def watched(df, label):
        if label not in plans:  # the write's own plan is not at hand, so it is run once more
            df.collect()
            plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, label)

    monkeypatch.setattr(graph, "stored", watched)
    for key, value in SPLIT.items():
        spark.conf.set(key, value)
    try:
        frame = spark.createDataFrame(edges, "a long, b long").repartition(24)
        got = dict(graph.components(frame).collect())
    finally:
        for key in SPLIT:
            spark.conf.unset(key)
    assert len(got) == 4000 + 4001 + 6000 and got[3999] == 0 and got[hub] == got[23_999] == 20_000 and got[10_001] == 10_000
    assert "(skew=true)" in plans["large-star"] and "(skew=true)" in plans["small-star"]


def test_orders_cross_slices_and_chunks(spark, monkeypatch):
    """The same links however the orders are cut."""
    rows = template_lines(150)
    found = []
    for chunk in (7, 1 << 16):
        monkeypatch.setattr(line_dedup, "CHUNK", chunk)
        found.append(sorted((r["doc_id"], tuple(r["removed"])) for r in line_dedup.report(cases.documents(spark, rows)).collect()))
    assert found[0] == found[1]


def test_top_k_equals_brute_force(spark):
    draw = np.random.default_rng(4)
    vectors = [(k, (draw.normal(size=12) * 0.3).astype(np.float32).tolist()) for k in range(400)]
    vectors += [(1000 + k, vectors[k][1]) for k in range(60)]  # ties
    vectors += [(2000, [0.0] * 12), (2050, [1.0, 2.0])]
    odd = [(3000, None), (None, [1.0] * 12), (3050, [float("nan")] * 12), (3100, [float("inf")] + [0.0] * 11), (3150, [None] + [1.0] * 11)]
    frame = spark.createDataFrame([*vectors, *odd], "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).repartition(4)
    ints = [(v, [int(np.floor(256 * x)) for x in e] + [0] * (12 - len(e))) for v, e in vectors]
    for size, block in ((16, 3), (1024, 4096)):
        got = topk.search(frame, F.col("vec_id") % 50 == 0, block_rows=size, query_block=block)
        assert sorted(map(tuple, got.collect())) == brute.top(ints, lambda v: v % 50 == 0)


def test_top_k_of_few_rows_and_large_values(spark):
    kind = "vec_id long, embedding array<float>"
    ask = F.col("vec_id") % 50 == 0
    assert topk.search(spark.createDataFrame([], kind), ask).count() == 0
    assert topk.search(spark.createDataFrame([(50, [1.0])], kind), ask).count() == 0
    assert topk.search(spark.createDataFrame([(1, [1.0])], kind), ask).count() == 0
    assert [tuple(r) for r in topk.search(spark.createDataFrame([(50, []), (1, [])], kind), ask).collect()] == [(50, 1, 1, 0)]
    large = [(0, [1e7, 3.0]), (1, [1e7, -5.0]), (2, [-1e7, 1.0]), (3, [1e30, 0.0]), (0, [2e7, 3.0])]
    got = topk.search(spark.createDataFrame(large, kind), ask).orderBy("rank").collect()
    ints = [(v, [int(np.floor(256 * float(np.float32(x)))) for x in e]) for v, e in large]
    scored = sorted((-min(max(sum(a * b for a, b in zip(ints[0][1], y, strict=True)), -2**63), 2**63 - 1), v) for v, y in ints if v)
    assert [(r["vec_id"], r["score"]) for r in got] == [(v, -s) for s, v in scored]
