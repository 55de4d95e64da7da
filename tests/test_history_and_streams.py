import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from skyledger.operators import (
    Buckets, CleanSpec, as_of, clean, commits, compact, files, fold_latest, folded_changes, read_history, rows_until, snapshots,
    table_as_of, write_base, write_commit,
)
from skyledger.streaming import incremental_upsert, ingest, ingest_incremental, ingest_within

SCHEMA = "id int, v string"


def test_history(spark, tmp_path):
    path = str(tmp_path / "h")
    write_commit(spark.createDataFrame([(1, "a"), (2, "b")], SCHEMA), path, 1)
    for _ in range(2):
        write_commit(spark.createDataFrame([(2, "B"), (3, "c")], SCHEMA), path, 2)
    history = read_history(spark, path)
    assert rows(as_of(history, 1, "id")) == [(1, "a"), (2, "b")]
    assert rows(as_of(history, 2, "id")) == rows(as_of(history, keys="id")) == [(1, "a"), (2, "B"), (3, "c")]
    assert as_of(history).count() == 4 and as_of(history, 1).count() == 2
    assert rows(snapshots(history), "commit_id", "n_rows") == [(1, 2), (2, 2)]
    listed = files(spark.read.parquet(path))
    assert listed.agg(F.sum("n_rows")).first()[0] == 4
    assert listed.where("file_size > 0 and file_modification_time is not null").count() == listed.count()
    compact(spark, path, str(tmp_path / "all"), 2)
    assert snapshots(read_history(spark, str(tmp_path / "all"))).first()["n_rows"] == 4
    compact(spark, path, str(tmp_path / "small"), 2, "id")
    assert rows(as_of(read_history(spark, str(tmp_path / "small")), keys="id")) == [(1, "a"), (2, "B"), (3, "c")]


def test_history_keeps_rows_without_key(spark, tmp_path):
    path = str(tmp_path / "h")
    write_commit(spark.createDataFrame([(None, "a"), (1, "b")], SCHEMA), path, 1)
    write_commit(spark.createDataFrame([(None, "c")], SCHEMA), path, 2)
    assert rows(as_of(read_history(spark, path), keys="id")) == [(None, "a"), (None, "c"), (1, "b")]


def put(root, day, text):
    folder = root / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "f.csv").write_text("id,v\n" + text)


def test_each_file_once(spark, tmp_path):
    raw, out, progress = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "cp")
    schema = spark.createDataFrame([], SCHEMA).schema

    def go():
        ingest_incremental(
            spark, f"{raw}/*", schema, lambda b: clean(b, CleanSpec(upper=("v",))), out, progress
        )
        return read_history(spark, out).count()

    put(raw, "d1", "1,a\n2,b\n2,b\n")
    assert go() == 2
    assert go() == 2
    put(raw, "d2", "3,c\n")
    assert go() == 3
    assert rows(as_of(read_history(spark, out))) == [(1, "A"), (2, "B"), (3, "C")]


def test_backlog_in_small_batches(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    for n in range(5):
        put(raw, f"d{n}", f"{n},x\n")
    schema = spark.createDataFrame([], SCHEMA).schema
    ingest_incremental(
        spark, f"{raw}/*", schema, lambda b: b, out, str(tmp_path / "cp"), files_per_batch=2
    )
    history = read_history(spark, out)
    assert history.count() == 5 and history.select("commit_id").distinct().count() == 3


def test_upsert_stream_and_repeated_batch(spark, tmp_path):
    raw, path, progress = tmp_path / "raw", str(tmp_path / "dim"), tmp_path / "cp"
    schema = spark.createDataFrame([], "id int, v string, seq int").schema

    def put_rows(day, text):
        folder = raw / day
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text("id,v,seq\n" + text)

    def go():
        incremental_upsert(
            spark, f"{raw}/*", schema, lambda b: b, "id", path, str(progress), order_by="seq"
        )
        return rows(as_of(read_history(spark, path), keys="id"), "id", "v")

    put_rows("d1", "1,a,1\n2,b,1\n2,bb,2\n")
    assert go() == [(1, "a"), (2, "bb")]
    put_rows("d2", "1,,3\n2,BB,3\n3,c,3\n")
    want = [(1, "a"), (2, "BB"), (3, "c")]
    assert go() == want
    assert go() == want
    stored = read_history(spark, path).count()
    # Forget that the second batch was finished: it runs again and adds nothing.
    for name in ("1", ".1.crc"):
        (progress / "commits" / name).unlink(missing_ok=True)
    assert go() == want
    assert read_history(spark, path).count() == stored


def test_json_array_files_as_a_stream(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    for day, text in (("d1", '[{"id": 1, "v": "a"}, {"id": 2, "v": null}]'), ("d2", '[{"id": 3, "v": "c"}]')):
        folder = tmp_path / "raw" / day
        folder.mkdir(parents=True)
        (folder / "f.json").write_text(text)
        ingest_incremental(
            spark, f"{tmp_path}/raw/*", schema, lambda b: b, str(tmp_path / "out"),
            str(tmp_path / "cp"), fmt="json",
        )
    assert rows(as_of(read_history(spark, str(tmp_path / "out")))) == [(1, "a"), (2, None), (3, "c")]


def folders(df):
    """(commit, bucket) of the folders that rows come from."""
    return {(r["commit_id"], r["key_bucket"]) for r in df.select("commit_id", "key_bucket").distinct().collect()}


def test_commits_in_buckets_are_pruned(spark, tmp_path):
    path, dealt = str(tmp_path / "h"), Buckets(("id",), 8)
    write_commit(spark.range(1000).selectExpr("CAST(id AS INT) AS id", "'a' AS v"), path, 0, buckets=dealt)
    write_commit(spark.createDataFrame([(5, "b"), (None, "n")], SCHEMA), path, 1, buckets=dealt)
    batch = spark.createDataFrame([(5, "c"), (7, "c"), (None, "c")], SCHEMA)
    names = dealt.of(batch)
    assert 1 <= len(names) <= 2 and all(n.endswith("of8") for n in names)
    asked = rows_until(spark, path, 1, batch.schema, dealt, names)
    assert {b for _, b in folders(asked)} == set(names)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "key_bucket" in plan[plan.index("PartitionFilters"):]
    # Another count later on: the old folders are still looked into.
    write_commit(spark.createDataFrame([(5, "d")], SCHEMA), path, 2, buckets=Buckets(("id",), 3))
    found = rows_until(spark, path, 2, batch.schema, Buckets(("id",), 3), Buckets(("id",), 3).of(batch))
    assert sorted(r["v"] for r in found.where("id = 5").collect()) == ["a", "b", "d"]
    assert rows(table_as_of(spark, path, keys="id").where("id = 5 OR id IS NULL")) == [(None, "n"), (5, "d")]


def test_bases_give_the_same_table_from_fewer_folders(spark, tmp_path):
    path, dealt, draw = str(tmp_path / "h"), Buckets(("id",), 8), random.Random(1)
    bases = {3, 7, 9}
    for n in range(12):
        batch = [(draw.choice([None, *range(30)]), f"{n}") for _ in range(3 if n else 60)]
        once = {k: v for k, v in batch if k is not None}
        write_commit(spark.createDataFrame([*once.items(), *[(None, v) for k, v in batch if k is None]], SCHEMA), path, n, buckets=dealt)
        if n in bases:
            for _ in range(2):
                write_base(spark, path, n, dealt)
    history = read_history(spark, path)
    for n in range(12):
        assert rows(table_as_of(spark, path, n, "id")) == rows(as_of(history, n, "id")), n
    assert {n for n, _ in folders(rows_until(spark, path, 11))} <= {3, 7, 9, 10, 11}
    # A base writes only the folders touched since the one before.
    second = {p.name.split("=")[1] for p in (tmp_path / "h/_bases/commit_id=7").glob("key_bucket=*")}
    touched = {p.name.split("=")[1] for n in range(4, 8) for p in (tmp_path / f"h/commit_id={n}").glob("key_bucket=*")}
    assert second == touched
    # The count changes: a base deals everything out anew.
    write_commit(spark.createDataFrame([(1, "x"), (2, "y")], SCHEMA), path, 12, buckets=Buckets(("id",), 3))
    before = rows(as_of(read_history(spark, path), 12, "id"))
    write_base(spark, path, 12, Buckets(("id",), 3))
    write_commit(spark.createDataFrame([(3, "z")], SCHEMA), path, 13, buckets=Buckets(("id",), 3))
    write_base(spark, path, 13, Buckets(("id",), 3))
    assert rows(table_as_of(spark, path, 12, "id")) == before
    assert rows(table_as_of(spark, path, keys="id")) == rows(as_of(read_history(spark, path), 13, "id"))


def test_rows_without_key_are_gathered_once_and_spread(spark, tmp_path):
    path, dealt = str(tmp_path / "h"), Buckets(("id",), 8)
    for n in range(6):
        rows_now = spark.range(0, 400, 1, 4).selectExpr("CAST(IF(id < 100, id, NULL) AS INT) AS id", f"concat('{n} ', id) AS v")
        write_commit(rows_now, path, n, buckets=dealt)
        if n in (1, 3):
            write_base(spark, path, n, dealt)
    # Each base holds the rows without a key since the one before.
    for base in (1, 3):
        assert spark.read.parquet(f"{path}/_bases/commit_id={base}").where("id IS NULL").count() == 600
    want = rows(as_of(read_history(spark, path), keys="id"))
    assert rows(table_as_of(spark, path, keys="id")) == want and len(want) == 100 + 6 * 300
    assert rows(table_as_of(spark, path, 3, "id")) == rows(as_of(read_history(spark, path), 3, "id"))
    # A base from before holds all of them: those of later ones are added to it.
    spark.read.parquet(path).where("commit_id <= 3").drop("commit_id").write.mode("overwrite").partitionBy("key_bucket").parquet(f"{path}/_bases/commit_id=3")
    log = spark.read.parquet(f"{path}/_log/kind=base/commit_id=3").collect()
    old = [(*r[:3], [b.replace("none_since", "none") for b in r["buckets"]]) for r in log]
    spark.createDataFrame(old, spark.read.parquet(f"{path}/_log/kind=base/commit_id=3").schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/_log/kind=base/commit_id=3")
    write_base(spark, path, 5, dealt)
    assert rows(table_as_of(spark, path, keys="id")) == want


def test_a_batch_lists_only_commits_since_the_base(spark, tmp_path):
    path, dealt = str(tmp_path / "h"), Buckets(("id",), 4)
    for n in range(6):
        write_commit(spark.createDataFrame([(n, "a"), (None, "b")], SCHEMA), path, n, buckets=dealt)
        if n in (1, 3):
            write_base(spark, path, n, dealt)
    batch = spark.createDataFrame([(k, "x") for k in range(6)], SCHEMA)
    asked = rows_until(spark, path, 5, batch.schema, dealt, dealt.of(batch))
    listed = {f.split("commit_id=")[0][-7:] + f.split("commit_id=")[1].split("/")[0] for f in asked.inputFiles()}
    assert {f for f in listed if "_bases" not in f} == {f"{path[-6:]}/4", f"{path[-6:]}/5"}
    assert rows(asked.where("id IS NOT NULL"), "id", "v") == [(k, "a") for k in range(6)]


def test_rows_without_key_skip_the_lookup(spark):
    fold = fold_latest(spark.createDataFrame([(1, "a"), (None, "b"), (None, "b")], SCHEMA).withColumn("seq", F.lit(1)), "id", "seq")
    changed = folded_changes(fold, fold_latest(spark.createDataFrame([(1, "a"), (None, "c"), (None, "c")], SCHEMA).withColumn("seq", F.lit(1)), "id", "seq"), "id")
    assert rows(changed, "id", "v") == [(None, "c"), (None, "c")]
    plan = changed._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and plan.index("Union") < plan.index("Join")


def test_bases_of_an_append_only_table(spark, tmp_path):
    path = str(tmp_path / "h")
    for n in range(6):
        write_commit(spark.createDataFrame([(n, "a"), (n, "a")], SCHEMA), path, n)
        if n in (1, 4):
            write_base(spark, path, n)
    # A base that was stopped before its mark does not count.
    spark.createDataFrame([(9, "lost")], SCHEMA).withColumn("committed_at", F.current_timestamp()).write.parquet(f"{path}/_bases/commit_id=3")
    for n in range(6):
        assert rows(table_as_of(spark, path, n)) == rows(as_of(read_history(spark, path), n)), n
    assert [p.name for p in (tmp_path / "h/_bases/commit_id=4").glob("part*")]
    with pytest.raises(ValueError):
        write_base(spark, path, 5, Buckets(("id",), 4))


def test_commits_without_rows_are_listed(spark, tmp_path):
    for name, dealt in (("plain", None), ("dealt", Buckets(("id",), 4))):
        path = str(tmp_path / name)
        for n, data in enumerate(([], [(1, "a")], [])):
            write_commit(spark.createDataFrame(data, SCHEMA), path, n, buckets=dealt)
        listed = commits(spark, path)
        assert rows(listed, "commit_id", "n_rows") == [(0, 0), (1, 1), (2, 0)]
        assert listed.where("first_committed_at <= last_committed_at").count() == 3
        assert rows(as_of(read_history(spark, path))) == [(1, "a")]
        assert rows(table_as_of(spark, path, 0)) == []


def test_a_batch_reads_only_its_own_buckets(spark, tmp_path, monkeypatch):
    """Of a long history a batch of one row reads one folder a commit, and there the digests alone."""
    raw, out, seen = tmp_path / "raw", str(tmp_path / "out"), []
    schema = spark.createDataFrame([], SCHEMA).schema
    real = ingest.rows_until

    def watched(*args, **kwargs):
        found = real(*args, **kwargs)
        seen.append(found)
        return found

    monkeypatch.setattr(ingest, "rows_until", watched)
    go = lambda: ingest_incremental(spark, f"{raw}/*", schema, lambda b: b, out, str(tmp_path / "cp"), buckets=16)
    put(raw, "d1", "".join(f"{k},x\n" for k in range(300)))
    go()
    put(raw, "d2", "7,x\n")
    go()
    put(raw, "d3", "7,x\n900,x\n")
    go()
    plan = seen[-1].select("row_digest")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<row_digest:string>" in plan and "key_bucket" in plan[plan.index("PartitionFilters"):]
    assert len({b for _, b in folders(seen[1])}) == 1
    assert read_history(spark, out).count() == 301
    assert as_of(read_history(spark, out)).columns == ["id", "v"]


def test_old_histories_go_on_without_buckets(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema
    write_commit(spark.createDataFrame([(1, "a"), (2, None)], SCHEMA), out, -1)
    put(raw, "d1", "1,a\n2,\n3,c\n")
    ingest_incremental(spark, f"{raw}/*", schema, lambda b: b, out, str(tmp_path / "cp"))
    put(raw, "d2", "3,c\n4,d\n")
    ingest_incremental(spark, f"{raw}/*", schema, lambda b: b, out, str(tmp_path / "cp"))
    assert rows(as_of(read_history(spark, out))) == [(1, "a"), (2, None), (3, "c"), (4, "d")]


def test_upserts_with_bases_equal_upserts_without(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, v string, seq int").schema
    draw, raw = random.Random(5), tmp_path / "raw"
    for n in range(7):
        (raw / f"d{n}").mkdir(parents=True)
        lines = [f"{draw.randint(0, 9)},{draw.choice(['', 'a', 'b'])},{draw.randint(0, 50)}" for _ in range(4)]
        (raw / f"d{n}/f.csv").write_text("id,v,seq\n" + "\n".join(lines) + "\n")
    tables = []
    for every in (None, 2):
        path = str(tmp_path / f"dim{every}")
        incremental_upsert(
            spark, f"{raw}/*", schema, lambda b: b, "id", path, str(tmp_path / f"cp{every}"), order_by="seq",
            files_per_batch=1, buckets=4, base_every=every,
        )
        tables.append(rows(table_as_of(spark, path, keys="id"), "id", "v"))
        assert rows(as_of(read_history(spark, path), keys="id"), "id", "v") == tables[-1]
    assert tables[0] == tables[1]
    assert sorted(p.name for p in (tmp_path / "dim2/_bases").glob("commit_id=*")) == [f"commit_id={n}" for n in (1, 3, 5)]


def test_equal_rows_within_a_watermark(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    schema = spark.createDataFrame([], "id int, at timestamp").schema

    def go(day, *lines):
        folder = raw / day
        folder.mkdir(parents=True)
        (folder / "f.csv").write_text("id,at\n" + "".join(f"{x}\n" for x in lines))
        ingest_within(spark, f"{raw}/*", schema, lambda b: b, out, str(tmp_path / "cp"), "at", "2 days")
        return rows(as_of(read_history(spark, out)).selectExpr("id", "CAST(at AS DATE) AS d"))

    day = lambda n: f"2024-01-{n:02} 00:00:00"
    go("d1", f"1,{day(1)}", f"1,{day(1)}", "2,")
    go("d2", f"1,{day(1)}", f"1,{day(2)}", f"3,{day(2)}")
    found = go("d3", f"3,{day(2)}", f"4,{day(9)}")
    # The watermark stands at the 7th: what is older counts no more, whether seen before or not.
    found = go("d4", f"5,{day(2)}", f"4,{day(9)}", f"6,{day(8)}")
    assert [(i, str(d)) for i, d in found] == [
        (1, "2024-01-01"), (1, "2024-01-02"), (3, "2024-01-02"), (4, "2024-01-09"), (6, "2024-01-08"),
    ]


def test_folds_of_maps_and_dotted_names(spark):
    schema = "`a.id` int, m map<string,int>, `v.w` string, seq int"
    data = [(1, {"x": 1}, "a", 1), (1, {"x": 2}, None, 2), (1, {"x": 3}, "c", 2), (2, None, None, 1), (None, {"y": 1}, "n", 1)]
    fold = fold_latest(spark.createDataFrame(data, schema), "a.id", "seq")
    assert rows(fold, "`a.id`", "m", "`v.w`") == [(None, {"y": 1}, "n"), (1, {"x": 3}, "c"), (2, None, None)]
    later = fold_latest(spark.createDataFrame([(1, {"x": 9}, "old", 0), (2, {"z": 1}, None, 5)], schema), "a.id", "seq")
    changed = folded_changes(fold, later, "a.id")
    assert rows(changed, "`a.id`", "m", "`v.w`") == [(2, {"z": 1}, None)]
