import json
import os
from datetime import date

import pytest
from helpers import png, rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from skyledger.sinks import ensure_namespace, export_csv, export_json, land, load_jdbc, publish
from skyledger.sources import (
    file_columns, file_headers, file_types, read_csv, read_csv_folded, read_day, read_files, read_images, read_jdbc, read_json_array,
    read_json_lines,
    read_latest, read_or_empty, table_exists, union_files, with_file_name,
)

from skyledger.sources.files import BLANKS_STAY
from skyledger.sources.inference import type_bit

AB = StructType([StructField("a", StringType()), StructField("b", StringType())])


def test_csv(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text('a,b\n1,2024-01-05T10:00:00\n2,\n3,""\n')
    plain = read_csv(spark, str(file))
    assert plain.dtypes == [("a", "string"), ("b", "string")]
    assert rows(plain) == [("1", "2024-01-05T10:00:00"), ("2", None), ("3", None)]
    assert read_csv(spark, str(file), infer=True).dtypes == [("a", "int"), ("b", "timestamp")]
    assert rows(read_csv(spark, str(file), AB)) == rows(plain)
    swapped = StructType(list(reversed(AB.fields)))
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(file), swapped).collect()


def test_types_fold_over_files(spark, tmp_path):
    files = {
        "one.csv": 'n,at,"odd, name",gone,big,mix\n1,2024-01-05,x,,9223372036854775808,2024-01-05\n 2 ,,y,,1,\n',
        "two.csv": "at,n,extra,mix\n2024-01-06T10:00:00,1.5e2,7,\n,-.5,+8,7\n",
        "head.csv": "n,never\n",
        "none.csv": "",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    bits = {(os.path.basename(r["file"]), r["column"]): r["bits"] for r in file_types(spark, f"{tmp_path}/*.csv").collect()}
    assert bits["one.csv", "n"] == 1 and bits["two.csv", "n"] == 2 and bits["one.csv", "at"] == bits["two.csv", "at"] == 4
    assert bits["one.csv", "odd, name"] == 8 and bits["one.csv", "gone"] == 0 and bits["one.csv", "big"] == 3
    back = read_csv_folded(spark, f"{tmp_path}/*.csv")
    assert dict(back.dtypes) == {
        "n": "double", "at": "timestamp", "odd, name": "string", "gone": "string", "big": "double", "mix": "string",
        "extra": "bigint", "never": "string",
    }
    assert rows(back.select("n", "`odd, name`", "extra", "mix")) == rows(spark.createDataFrame(
        [(1.0, "x", None, "2024-01-05"), (2.0, "y", None, None), (150.0, None, 7, None), (-0.5, None, 8, "7")],
        "n double, o string, extra long, mix string",
    ))


@pytest.mark.parametrize("value, bit", [
    (None, 0), (" ", 0), ("007", 1), (" -3 ", 1), ("1.", 2), ("99999999999999999999", 2), ("NaN", 8), ("1d", 8), ("2024", 1),
    ("2024-02-30", 8), ("2024-2-3 10:00", 4), ("12:30", 8), ("true", 8),
])
def test_type_of_a_value(spark, value, bit):
    assert spark.createDataFrame([(value,)], "v string").select(type_bit(F.col("v"))).first()[0] == bit


def test_json_array(spark, tmp_path):
    file = tmp_path / "x.json"
    file.write_text(json.dumps([{"z": 1, "a": "x", "ts": "2024-01-05T10:00:00"}, {"z": 2, "a": None}]))
    df = read_json_array(spark, str(file))
    assert df.dtypes == [("a", "string"), ("ts", "string"), ("z", "bigint")]
    assert df.count() == 2


def test_day_folders(spark, tmp_path):
    for day, text in (("2024/01/05", "1,x"), ("2024/01/06", "2,y")):
        folder = tmp_path / day / "csv" / "weather_data"
        folder.mkdir(parents=True)
        (folder / "one.csv").write_text(f"a,b\n{text}\n")
    root = str(tmp_path)
    assert rows(read_day(spark, root, "weather_data", "csv", date(2024, 1, 5), AB)) == [("1", "x")]
    assert read_day(spark, root, "weather_data", "csv", None, AB).count() == 2
    missing = read_day(spark, root, "weather_data", "csv", date(2023, 1, 1), AB)
    assert missing.schema == AB and missing.count() == 0
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_day(spark, root, "weather_data", "csv", date(2023, 1, 1))


def test_landed_days(spark, tmp_path):
    df = spark.createDataFrame(
        [(" a ", "2024-01-05T23:59:59.5"), ("b", "2024-12-31T00:00:00")], "v string, ts string"
    )
    root = str(tmp_path)
    for fmt in ("csv", "jsonl"):
        land(df, root, "w", fmt, "ts")
        land(df, root, "w", fmt, "ts", replace_days=True)
        assert os.path.isdir(f"{root}/{fmt}/w/year=2024/month=01/day=05")
        one = read_day(spark, root, "w", fmt, date(2024, 1, 5), df.schema, layout="landed")
        assert rows(one) == [(" a ", "2024-01-05T23:59:59.5")]
        land(df, root, "w", fmt, "ts")
        assert read_day(spark, root, "w", fmt, None, df.schema, layout="landed").count() == 4


def test_read_or_empty_only_hides_missing_paths(spark, tmp_path):
    empty = read_or_empty(spark, lambda: read_csv(spark, f"{tmp_path}/no/*.csv"), AB)
    assert empty.schema == AB and empty.isEmpty()
    (tmp_path / "x.csv").write_text("a,b\n1,2\n")
    with pytest.raises(AnalysisException):
        read_or_empty(spark, lambda: read_csv(spark, f"{tmp_path}/x.csv").select("nope"), AB)


def test_latest_file(spark, tmp_path):
    for number, name in enumerate(["weather_data_1", "weather_data_3", "weather_data_2", "flight_data"]):
        file = tmp_path / f"{name}.csv"
        file.write_text(f"a,b\n{number},{name}\n")
        os.utime(file, (1_000 + number, 1_000 + number))
    assert rows(read_latest(spark, str(tmp_path), "weather_data", read_csv)) == [("2", "weather_data_2")]
    assert read_latest(spark, str(tmp_path), "no_such", read_csv) is None


def test_union_and_names(spark, tmp_path):
    (tmp_path / "one two.csv").write_text("a,b\n1,2\n")
    df = with_file_name(read_csv(spark, str(tmp_path)))
    assert rows(df) == [("1", "2", "one%20two.csv")]  # as in the file's URI
    assert rows(union_files([df.select("a"), df.select("b")])) == [(None, "2"), ("1", None)]
    (tmp_path / "pic one.png").write_bytes(png(1, 1, 1, [5]))
    assert read_images(spark, f"{tmp_path}/*.png").select("image.origin").first()[0].endswith("/pic%20one.png")
    assert read_files(spark, str(tmp_path), "*.png").first()["path"].endswith("pic one.png")


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(" x ", 'say "hi", ok'), ("y", None)], AB)
    assert export_csv(df, f"{tmp_path}/c") and rows(read_csv(spark, f"{tmp_path}/c")) == rows(df)
    assert not export_csv(df.where("a = 'z'"), f"{tmp_path}/none")
    assert not os.path.exists(f"{tmp_path}/none")
    export_json(df, f"{tmp_path}/j")
    assert rows(read_json_lines(spark, f"{tmp_path}/j", AB)) == rows(df)


@pytest.fixture
def namespace(spark, tmp_path):
    name = "ns_" + tmp_path.name.replace("-", "_")
    ensure_namespace(spark, name, str(tmp_path / "ns"))
    ensure_namespace(spark, name)
    yield name
    spark.sql(f"DROP NAMESPACE {name} CASCADE")


def test_publish_replace(spark, namespace):
    table = f"{namespace}.t"
    assert not table_exists(spark, table)
    publish(spark.createDataFrame([("1", "x")], AB), table)
    publish(spark.table(table).withColumn("c", F.lit(1)), table)
    assert table_exists(spark, table) and rows(spark.table(table)) == [("1", "x", 1)]
    # A failing build leaves the old rows.
    with pytest.raises(Exception, match="broken"):
        publish(spark.table(table).withColumn("c", F.raise_error(F.lit("broken")).cast("int")), table)
    assert rows(spark.table(table)) == [("1", "x", 1)]
    publish(spark.createDataFrame([("2", "y")], AB), table)
    assert rows(spark.table(table)) == [("2", "y")]
    assert [t.name for t in spark.catalog.listTables(namespace)] == ["t"]


def test_publish_append_and_partitions(spark, namespace):
    table = f"{namespace}.p"
    df = spark.createDataFrame([("1", "x"), ("2", "y"), ("3", "y")], AB)
    publish(df, table, "append", partition_by=["a"])
    publish(df.select("b", "a"), table, "append", partition_by=["a"])
    assert spark.table(table).count() == 6
    publish(df.where("a = '2'"), table, "overwrite_partitions", partition_by=["a"])
    publish(df.where("a = '2'"), table, "overwrite_partitions", partition_by=["a"])
    assert rows(spark.table(table).select("a", "b")) == [("1", "x")] * 2 + [("2", "y")] + [("3", "y")] * 2
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    whole = f"{namespace}.w"
    for _ in range(2):
        publish(df, whole, "overwrite_partitions")
    assert spark.table(whole).count() == 3
    # A forgotten partition list must not turn one partition into the whole table.
    publish(df.where("a = '1'"), table, "overwrite_partitions")
    assert spark.table(table).count() == 4
    with pytest.raises(ValueError, match="partitioned by"):
        publish(df, table, "append", partition_by=["b"])
    with pytest.raises(ValueError, match="columns"):
        publish(df.withColumn("c", F.lit(1)), table, "append", partition_by=["a"])
    with pytest.raises(ValueError, match="mode"):
        publish(df, table, "sideways")


def test_jdbc_replaces(spark, tmp_path):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:memory:{tmp_path.name};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    for n in (5, 3):
        load_jdbc(spark.range(n), url, "numbers", props, connections=2)
    assert read_jdbc(spark, url, "numbers", props).count() == 3
    slices = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 3, "numPartitions": 3}
    assert read_jdbc(spark, url, "numbers", props, slices).count() == 3


def test_tables_of_another_catalog(spark, tmp_path):
    """Spark's own JDBC catalog over an embedded database stands for any catalog plugin."""
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    settings = {
        "": "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog",
        ".url": f"jdbc:derby:memory:cat_{tmp_path.name};create=true",
        ".driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    }
    for key, value in settings.items():
        spark.conf.set(f"spark.sql.catalog.other{key}", value)
    ensure_namespace(spark, "other.SILVER")
    table = "other.SILVER.T"
    publish(spark.range(3), table)
    publish(spark.range(2), table, "append")
    assert spark.table(table).count() == 5
    publish(spark.range(4), table)
    assert spark.table(table).count() == 4


def test_csv_keeps_line_breaks_quotes_and_blanks(spark, tmp_path):
    odd = [("1", 'a "b"\nc, d\\'), ("2", ""), ("3", None), ("4", "\r\n x \\"), ("5", 'end"')]
    export_csv(spark.createDataFrame(odd, AB).coalesce(1), str(tmp_path / "odd"))
    assert rows(read_csv(spark, str(tmp_path / "odd"), **BLANKS_STAY)) == rows(spark.createDataFrame(odd, AB))


def test_files_of_a_day_are_joined_by_name(spark, tmp_path):
    folder = tmp_path / "2024/01/05/csv/x"
    folder.mkdir(parents=True)
    (folder / "one[1].csv").write_text("a,b\n1,2\n")
    (folder / "two 2.csv").write_text("c,b\n9,8\n")
    (folder / "none.csv").write_text("")
    (folder / "head.csv").write_text("b,d\n")
    got = read_day(spark, str(tmp_path), "x", "csv", date(2024, 1, 5), AB)
    assert rows(got) == [(None, "8"), ("1", "2")]
    found = file_columns(spark, f"{folder}/*.csv", "csv")
    assert sorted((list(r["columns"]), r["n_rows"]) for r in found.collect()) == [(["a", "b"], 1), (["b", "d"], 0), (["c", "b"], 1)]


def test_headers_with_quotes_and_commas(spark, tmp_path):
    folder = tmp_path / "2024/01/05/csv/x"
    folder.mkdir(parents=True)
    (folder / "one.csv").write_text('\ufeffa,"na,me",b\n1,"x,y",2\n')
    (folder / "two.csv").write_text('"b","say ""hi""","a"\n"2,5",w,3\n')
    found = file_headers(spark, f"{folder}/*.csv")
    assert sorted(list(r["columns"]) for r in found.collect()) == [["a", "na,me", "b"], ["b", 'say "hi"', "a"]]
    assert rows(read_day(spark, str(tmp_path), "x", "csv", date(2024, 1, 5), AB)) == [("1", "2"), ("3", "2,5")]
    assert "CSV" not in found._jdf.queryExecution().executedPlan().toString()
