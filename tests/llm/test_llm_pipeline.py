import brute
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from skyledger.llm import queries
from skyledger.llm.base import stored, table

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    outputs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test")
        outputs.append((name, docs))
    texts = [sorted((r["doc_id"], r["text"]) for r in d.select("doc_id", "text").collect()) for _, d in outputs[:-1]]
    assert [d.columns for _, d in outputs[:-1]] == [columns] * 4
    everything = dict(table(spark, SF, "documents").select("doc_id", "text").collect())
    verdicts = {r["doc_id"]: r["kept"] for r in queries.QUERIES["op1_quality_rules"](spark, SF).collect()}
    assert texts[0] == sorted((k, t) for k, t in everything.items() if verdicts[k])
    gone = brute.removed_lines(texts[0])
    assert texts[1] == [(k, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[k])) for k, t in texts[0]]
    groups = brute.simhash_components(texts[1])
    assert texts[2] == [(k, t) for k, t in texts[1] if groups[k][1] == k]
    kept = brute.repeated_bytes(texts[2])[1]
    assert texts[3] == [(k, kept[k].decode("utf-8", "ignore")) for k, _ in texts[2]]
    pieces = outputs[-1][1].toPandas()
    assert sorted(set(pieces.doc_id)) == [k for k, _ in texts[3]]
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()


def test_run_and_entry(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names and len([n for n in names if n.startswith("op")]) == len(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_queries_cover_the_table(spark, name):
    rows = queries.QUERIES[name](spark, SF)
    n = table(spark, SF, "documents").count()
    assert rows.select("doc_id").distinct().count() == n
