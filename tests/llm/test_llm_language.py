import cases
import pytest
from pyspark.sql import functions as F

from skyledger.llm import compression_language, queries
from skyledger.llm.base import held_out, table
from skyledger.llm.compression_language import Model, classify, fit, report

SF = "/root/testdata/sf0.01"
WORDS = {"aa": "lopu mira tesk ", "bb": "zung ßöä harr ", "cc": "żółw ćma 水 "}
TAUGHT = "doc_id long, text string, lang string"


def taught(spark, rows):
    return spark.createDataFrame(rows, TAUGHT)


@pytest.fixture(scope="module")
def model(spark):
    rows = [(10 * k + j, f"{words * 9}{k}", lang) for j, (lang, words) in enumerate(WORDS.items()) for k in range(40)]
    return fit(taught(spark, rows))


def test_languages_of_held_out_documents(spark):
    rows = queries.op12_language(spark, SF)
    docs = table(spark, SF, "documents")
    assert rows.count() == docs.count()
    met = rows.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(met) > 100 and (met.lang == met.lang_pred).mean() > 0.97
    sure = met[~met.rejected]
    assert len(sure) > 0.9 * len(met) and (sure.lang == sure.lang_pred).mean() >= (met.lang == met.lang_pred).mean()
    assert met.score.between(0, 1).all()


def test_nothing_of_held_out_rows_is_learned(spark):
    rows = [(k, "lopu mira tesk " * 5, "aa") for k in range(200)]
    marks = {r["doc_id"] for r in taught(spark, rows).where(held_out(F.col("doc_id"))).collect()}
    only_held = taught(spark, [(k, "zung harr " * 5, "bb") if k in marks else r for k, r in enumerate(rows)])
    assert list(fit(only_held).dictionaries) == ["aa"]
    others = [(None, "zung harr", "bb"), (1, None, "bb"), (2, "zung harr", None)]
    assert list(fit(taught(spark, rows + others)).dictionaries) == ["aa"]


def test_odd_rows(spark, model):
    rows = [
        (1, None), (2, ""), (3, " 12 ½ _ ²\n"), (4, "水"), (5, "lopu " * 100_000), (5, "lopu " * 100_000), (None, "zung ßöä harr"),
        (6, "LOPU, Mira! 7 tesk."), (7, "퟿\U0001f600"),
    ]
    got = {(r["doc_id"], r["lang_pred"], r["score"] == 0) for r in report(cases.documents(spark, rows), model).collect()}
    assert got == {
        (1, "und", True), (2, "und", True), (3, "und", True), (4, "cc", False), (5, "aa", False), (None, "bb", False),
        (6, "aa", False), (7, "und", True) if not "퟿".isalpha() else (7, "aa", False),
    }
    assert report(cases.documents(spark, rows), model).where("doc_id = 5").count() == 2
    assert classify(cases.empty(spark), model).count() == 0


def test_without_anything_learned(spark):
    none = fit(taught(spark, []))
    assert none.dictionaries == {}
    assert {tuple(r) for r in classify(cases.documents(spark, [(1, "lopu")]), none).collect()} == {(1, "und", 0.0, None, False)}
    one = fit(taught(spark, [(k, f"lopu mira {k}", "aa") for k in range(20)]))
    assert {tuple(r)[:3] for r in classify(cases.documents(spark, [(1, "xyz")]), one).collect()} == {(1, "aa", 1.0)}


def test_ties_and_narrow_margins(spark):
    same = Model({"bb": b"lopu mira tesk", "aa": b"lopu mira tesk"})
    r = classify(cases.documents(spark, [(1, "lopu mira")]), same).first()
    assert (r["lang_pred"], r["score"], r["margin"], r["rejected"]) == ("bb", 0.5, 0.0, True)
    apart = Model({"bb": b"zung harr", "aa": b"lopu mira tesk kalo " * 20})
    r = classify(cases.documents(spark, [(1, "lopu mira tesk kalo lopu mira tesk kalo")]), apart).first()
    assert r["lang_pred"] == "aa" and not r["rejected"] and r["score"] > 0.9


def test_sample_is_bounded_and_spares_copies(spark):
    copies = [(k, "one text many times over", "aa") for k in range(500)]
    rows = copies + [(1000 + k, f"another text {chr(97 + k % 26)}{chr(97 + k // 26)} " + "lopu " * 300, "aa") for k in range(300)]
    found = fit(taught(spark, rows), sample=20, excerpt=50).dictionaries["aa"]
    assert len(found) <= 20 * 51 and found.count(b"one text many") <= 1
    long = fit(taught(spark, [(k, "lopu " * 100_000 + str(k), "aa") for k in range(4)]))
    assert 0 < len(long.dictionaries["aa"]) <= 4 * compression_language.EXCERPT + 4


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(compression_language, "LANGUAGES", 3)
    with pytest.raises(ValueError, match="languages"):
        fit(taught(spark, [(k, "lopu", f"l{k % 7}") for k in range(70)]))
