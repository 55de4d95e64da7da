import brute
import cases
import numpy as np
import pytest

from skyledger.llm import quality_rules, queries, rule_ensemble, toxicity
from skyledger.llm.base import held_out, labelled_ids, table
from skyledger.llm.textstats import count
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"
EMPTY_LABELS = "doc_id long, quality int, toxic int"


def test_counts_equal_brute_force():
    for text in [*cases.texts(), "A a\na\x0bb\n\n A a", "x y z x y z x y z", "a b c b a b c", "#* $", "é é é é"]:
        assert count(text)[:5] == brute.counts(text)


def test_judge_gives_every_row_a_result(spark):
    docs = cases.documents(spark, [*enumerate(cases.texts()), (None, "w " * 60), (1, "again"), (1, "again")])
    rule = (quality_rules.Test("symbols_per_word", True, 0.5),)
    rows = quality_rules.judge(docs, [rule]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (not r["base_failed"] and r["rule"] == 0)
    kept = quality_rules.filter_documents(docs, [rule])
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in rows)


def test_rules_cover_in_order_and_stop():
    draw = np.random.default_rng(1)
    x = {"u": draw.random(3000), "v": draw.random(3000), "w": draw.random(3000)}
    y = (x["u"] > 0.9) | ((x["v"] > 0.8) & (x["w"] < 0.3))
    rules = quality_rules.learn_list(x, y)
    hit = np.zeros(3000, bool)
    for rule in rules:
        hit |= quality_rules.covers(rule, x, 3000)
    assert (hit == y).mean() > 0.98
    assert quality_rules.learn_list(x, np.zeros(3000, bool)) == []
    assert quality_rules.learn_list({"u": np.ones(50)}, np.arange(50) < 25) == []


@pytest.mark.parametrize("run", ["op1_quality_rules", "op4_toxicity", "op5_rule_ensemble"])
def test_held_out_labels_are_met(spark, run):
    labels = table(spark, SF, "labels").where(held_out(F.col("doc_id")))
    rows = queries.QUERIES[run](spark, SF).join(labels, "doc_id").toPandas()
    if run == "op1_quality_rules":
        assert rows.kept[rows.quality == 0].mean() < 0.1
        assert rows.kept[(rows.quality == 1) & ~rows.base_failed].mean() > 0.97
    elif run == "op4_toxicity":
        assert rows.predicted[rows.toxic == 0].mean() < 0.02 and (rows.predicted == rows.toxic).mean() > 0.95
    else:
        assert (rows.predicted == rows.quality).mean() > 0.9
    if "score" in rows:
        assert rows.held_out.all() and rows.score.between(0, 1).all()


def test_without_labels_or_rows(spark):
    docs, none = cases.documents(spark), spark.createDataFrame([], EMPTY_LABELS)
    assert quality_rules.fit(docs, none) == []
    assert {r["score"] for r in rule_ensemble.score(docs, rule_ensemble.fit(docs, none)).collect()} == {0.5}
    assert {r["score"] for r in toxicity.score(docs, toxicity.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(k, 1, 0) for k in range(20)], EMPTY_LABELS)
    assert rule_ensemble.fit(docs, one).rules == () and toxicity.fit(docs, one).weights == {}
    nothing = cases.empty(spark)
    assert quality_rules.judge(nothing, []).count() == 0
    assert rule_ensemble.score(nothing, rule_ensemble.Ensemble(0.0, ())).count() == 0
    assert toxicity.score(nothing, toxicity.Lexicon({}, (), (0.0, 0.0, 0.0))).count() == 0


def test_labels_repeat_and_are_bounded(spark):
    rows = [(k, k % 2, None) for k in range(400)] + [(1, 0, None), (3, None, None), (None, 1, 1)]
    labels = spark.createDataFrame(rows, EMPTY_LABELS)
    ids = {r["doc_id"]: r["label"] for r in labelled_ids(labels, "quality").collect()}
    assert 280 < len(ids) < 360 and ids.get(1, 0) == 0 and None not in ids
    assert labelled_ids(labels, "quality", 50).count() <= 50


def test_ensemble_column_equals_prediction(spark):
    draw = np.random.default_rng(2)
    x = {"u": draw.random(1500), "v": draw.random(1500)}
    y = ((x["u"] > 0.5) ^ (x["v"] > 0.7)).astype(float)
    model = rule_ensemble.train(x, y)
    predicted = model.predict(x, 1500)
    assert ((predicted > 0.5) == (y > 0)).mean() > 0.95
    frame = spark.createDataFrame(list(zip(x["u"].tolist(), x["v"].tolist(), strict=True)), "u double, v double")
    shown = frame.select(model.column({"u": F.col("u"), "v": F.col("v")}).alias("s")).toPandas().s
    assert np.allclose(sorted(shown), sorted(predicted))


def test_folding_and_exceptions():
    for written in ("St0pid", "ｓｔｏｐｉｄ", "ѕtоpіd", "s.t.o.p.i.d", "stooopid", "stópid", "$topid", "st​opid"):
        assert toxicity.fold(f"so {written} here")[1:-1] == ["stopid"], written
    assert toxicity.fold("in 1984, 300 words!!") == ["in", "words"]
    lexicon = toxicity.Lexicon({" stop": 2.0, " stopid ": 3.0}, (" not stopid ",), (0.0, 1.0, 0.0))
    finder = lexicon.finder()
    assert toxicity.hits(toxicity.fold("a stopid stopidly one"), finder) == 5.0
    assert toxicity.hits(toxicity.fold("not stopid but stopid"), finder) == 3.0
    assert toxicity.hits([], finder) == 0.0


def test_starts_explained_by_one_word_are_left_out():
    forms = {" path": (7.0, 20), " pathe": (7.0, 20), " pathetic ": (7.0, 20), " chll": (6.0, 30), " chlla": (6.0, 12), " chlle": (5.0, 11)}
    assert set(toxicity._needed(forms)) == {" pathetic ", " chll", " chlla", " chlle"}


def test_short_words_and_disguised_ends():
    for written, read in (("1d10t", "idiot"), ("(1d10t)", "idiot"), ("cr4p!", "crap"), ("5h1t", "shit"), ("$h1t", "shit"), ("s|ut", "siut")):
        assert toxicity.fold(f"so {written} here")[1:-1] == [read], written
    for written, readings in (("hat3", ["hat", "hate"]), ("ido1", ["ido", "idoi"]), ("a$$", ["a", "ass"]), ("b17", ["b", "bit"])):
        assert toxicity.fold(f"so {written} here")[1:-1] == readings, written
    assert toxicity.fold("wow! | it |! $5 1984 !") == ["wow", "it"]
    assert toxicity.fold("1" * 200_000 + " x") == ["x"]  # one pass
    assert toxicity._word_forms(["ass", "stop"]) == {" ass ", " stop", " stop "}


def test_an_insult_of_three_letters_is_learned(spark):
    rows = [(k, f"you {'zug' if k % 2 else 'nice'} person of town {k}") for k in range(200)]
    labels = spark.createDataFrame([(k, 0, k % 2) for k, _ in rows], EMPTY_LABELS)
    lexicon = toxicity.fit(cases.documents(spark, rows), labels)
    assert " zug " in lexicon.weights
    scores = dict(toxicity.score(cases.documents(spark, [(1, "a zug there"), (2, "a day there")]), lexicon).select("doc_id", "score").collect())
    assert scores[1] > scores[2]


def test_a_fit_takes_one_row_of_each_id(spark, monkeypatch):
    """Four labels, one id on very many rows: the bound is one of rows."""
    text = lambda k: f"word{k} " * 60
    rows = [(1, text(k % 50)) for k in range(3000)] + [(k, text(k)) for k in (3, 4, 5, 6, 7, 8)] + [(None, text(1))]
    docs = cases.documents(spark, rows)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in (1, 3, 4, 5, 6, 7, 8)], EMPTY_LABELS)
    ids = {r["doc_id"] for r in labelled_ids(labels, "quality").collect()}
    seen = []
    monkeypatch.setattr(quality_rules, "base_failed", lambda c: F.lit(False))
    monkeypatch.setattr(quality_rules, "learn_list", lambda x, bad: seen.append(len(bad)) or [])
    monkeypatch.setattr(rule_ensemble, "train", lambda x, y: seen.append(len(y)))
    real = toxicity._rated
    monkeypatch.setattr(toxicity, "_rated", lambda rows, lexicon: seen.append(rows.count()) or real(rows, lexicon))
    quality_rules.fit(docs, labels)
    rule_ensemble.fit(docs, labels)
    toxicity.fit(docs, labels)
    assert len(ids) > 3 and seen == [len(ids)] * 3
    seen.clear()
    rule_ensemble.fit(docs, labels, sample=3)
    assert seen == [3]


def test_scores_row_by_row(spark):
    """Both scores again, document by document, in plain Python."""
    docs = [*enumerate(cases.texts()), (None, "w " * 60)]
    frame = cases.documents(spark, docs)
    ensemble = rule_ensemble.train(
        {"symbols_per_word": np.tile([0.0, 1.0], 300), "mean_word_chars": np.arange(600.0) % 7}, np.tile([1.0, 0.0], 300)
    )
    for doc_id, text in docs:
        frame_of = cases.documents(spark, [(doc_id, text)]) if doc_id in (0, 8, 10, None) else None
        if frame_of is not None:
            alone = rule_ensemble.score(frame_of, ensemble).first()["score"]
            both = [r["score"] for r in rule_ensemble.score(frame, ensemble).collect() if r["doc_id"] == doc_id]
            assert both == [alone] and 0 <= alone <= 1
    lexicon = toxicity.Lexicon({" again": 2.0, " xx": 1.0}, (" again and ",), (-3.0, 1.0, 0.5))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(frame, lexicon).collect()}
    finder = lexicon.finder()
    for doc_id, text in docs:
        words = toxicity.fold(text or "")
        total = toxicity.hits(words, finder)
        clean = toxicity.hits([], finder)
        assert 0 <= got[doc_id] <= 1
        if total == clean:
            assert got[doc_id] == got[[k for k, t in docs if t == ""][0]]
        else:
            assert got[doc_id] > got[[k for k, t in docs if t == ""][0]]
