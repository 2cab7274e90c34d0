"""Sources, sinks and the document normaliser."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from covey import errors
from covey.functions.documents import as_documents
from covey.sinks.collections import CollectionStore, at_least_partitions
from covey.sinks.files import path_exists, write_csv_parts, write_json_document, write_single_csv
from covey.sources import shared, tables

NAN, INF = float("nan"), float("inf")


def test_documents_scalars(spark):
    df = spark.createDataFrame(
        [
            (NAN, -INF, Decimal("1.25"), dt.date(2020, 1, 2), bytearray(b"ab"), True, 7),
            (1.5, 0.5, None, None, None, None, None),
        ],
        "a double, b float, c decimal(9,2), d date, e binary, f boolean, g tinyint",
    )
    out = as_documents(df)
    assert [t for _, t in out.dtypes] == [
        "double", "double", "double", "string", "string", "boolean", "tinyint",
    ]
    assert tuple(out.collect()[0]) == (None, None, 1.25, "2020-01-02", "YWI=", True, 7)
    assert tuple(out.collect()[1]) == (1.5, 0.5, None, None, None, None, None)


def test_documents_instants(spark):
    values = [dt.datetime(2020, 1, 2, 3, 4, 5), dt.datetime(2020, 1, 2, 3, 4, 5, 60)]
    df = spark.createDataFrame([(v, v) for v in values], "a timestamp, b timestamp_ntz")
    for row, value in zip(as_documents(df).collect(), values):
        assert tuple(row) == (value.isoformat(), value.isoformat())


def test_documents_nested(spark):
    df = spark.createDataFrame(
        [({"x": [(NAN, Decimal("0.50"))]}, None, [[INF, 1.0], None]), (None, (1.0,), [])],
        "m map<string,array<struct<a:double,b:decimal(9,2)>>>, s struct<v:double>, "
        "n array<array<double>>",
    )
    first, second = as_documents(df).collect()
    assert first.m["x"][0].asDict() == {"a": None, "b": 0.5}
    assert first.s is None
    assert first.n == [[None, 1.0], None]
    assert second.m is None and second.s.v == 1.0 and second.n == []


def test_documents_leave_plain_columns_alone(spark):
    df = spark.range(3).selectExpr("id", "array(id) AS a", "named_struct('x', id) AS s")
    plan = as_documents(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_store(spark, tmp_path, fmt):
    store = CollectionStore(spark, str(tmp_path), fmt)
    df = spark.range(50).selectExpr("id", "CAST(id AS STRING) AS name", "id * 2 AS twice")
    with pytest.raises(errors.EmptyCollection):
        store.read("things")
    assert store.replace("things", df) == 50
    assert store.replace("things", df.limit(20)) == 20
    assert store.import_table("things", df, "somewhere") == 50
    read = store.read("things", ["twice"], optional=["name", "absent"], schema=df.schema)
    assert sorted(read.columns) == ["name", "twice"]
    assert store.read("imports").first().asDict() == {
        "collection": "things", "source_path": "somewhere", "rows": 50
    }
    store.append("things", df.limit(1))
    assert store.read("things").count() == 51
    store.replace("things", df.limit(0))
    with pytest.raises(errors.EmptyCollection):
        store.read("things", schema=df.schema)


def test_a_failed_replacement_leaves_the_old_rows(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path))
    store.replace("things", spark.range(5))
    with pytest.raises(Exception, match="broken"):
        store.replace("things", spark.range(9).selectExpr("IF(id = 8, raise_error('broken'), id) AS id"))
    assert store.read("things").count() == 5
    for n in (6, 7, 8):
        assert store.replace("things", spark.range(n)) == n
    assert store.read("things").count() == 8


def test_connector_formats_take_no_path(spark):
    store = CollectionStore(spark, None, "noop", {"batch": "1000"})
    store.append("things", spark.range(3))


def test_projected_read_is_pruned(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path))
    store.replace("things", spark.range(5).selectExpr("id", "id AS other"))
    plan = store.read("things", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_narrow_scans_are_spread(spark):
    assert at_least_partitions(spark.range(0, 9, 1, 2), 8).rdd.getNumPartitions() == 8
    wide = spark.range(0, 90, 1, 9)
    assert at_least_partitions(wide, 8) is wide


def test_csv_keeps_empty_and_null_apart(spark, tmp_path):
    df = spark.createDataFrame([("", 1), (None, 2), ("x", 3)], "s string, i int")
    path = str(tmp_path / "csv")
    write_csv_parts(df, path, empty_as="<empty>")
    back = tables.read_csv(spark, path, df.schema, empty_as="<empty>")
    assert sorted(map(tuple, back.collect()), key=lambda r: r[1]) == [("", 1), (None, 2), ("x", 3)]


def test_csv_refuses_the_mark_itself(spark, tmp_path):
    with pytest.raises(Exception, match="equals the mark"):
        write_csv_parts(spark.createDataFrame([("<empty>",)], "s string"), str(tmp_path / "x"), "<empty>")


def test_single_csv_is_one_file_and_replaced(spark, tmp_path):
    path = tmp_path / "out.csv"
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "mine.txt").write_text("kept")
    for n in (5, 3):
        write_single_csv(spark.range(n), str(path))
    assert len(path.read_text().splitlines()) == 4
    assert (tmp_path / "out" / "mine.txt").read_text() == "kept"


def test_single_csv_joins_its_parts_in_order(spark, tmp_path):
    """Parts written in parallel, empty ones among them, behind one header; quoted as in parts."""
    df = spark.range(0, 100, 1, 9).filter("id < 20 OR id > 60").selectExpr(
        "id AS `a,\"b`", "IF(id % 2 = 0, 'x,y\nz', NULL) AS text", "'é' AS e"
    )
    path = tmp_path / "out.csv"
    write_single_csv(df, str(path))
    back = spark.read.csv(str(path), header=True, multiLine=True, escape='"')
    assert path.read_text(encoding="utf-8").splitlines()[0].endswith(",text,e")
    assert [int(r[0]) for r in back.collect()] == [r[0] for r in df.collect()]
    write_single_csv(df.limit(0), str(path))
    assert len(path.read_text(encoding="utf-8").splitlines()) == 1
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("_")] == []


def test_single_csv_gathers_no_rows(spark, tmp_path):
    rows = spark.range(0, 50, 1, 6)
    write_single_csv(rows.withColumn("part", F.spark_partition_id()), str(tmp_path / "o.csv"))
    tasks = {r.part for r in spark.read.csv(str(tmp_path / "o.csv"), header=True).select("part").collect()}
    assert len(tasks) == 6


def test_json_document(spark, tmp_path):
    path = tmp_path / "doc.json"
    df = spark.createDataFrame([("é", None, [1, 2])], "a string, b int, c array<int>")
    write_json_document(df, str(path))
    text = path.read_text(encoding="utf-8")
    assert '\n  "a" : "é"' in text and '"b" : null' in text


def test_shared_dir_comes_from_the_session(spark, tmp_path):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared.shared_dir(spark) == configured
    table = shared.materialise(spark.range(3), "t")
    assert table.count() == 3
    assert configured in table.inputFiles()[0]


def test_removed_tables_are_gone(spark):
    path = shared.fresh_path(spark, "gone")
    spark.range(3).write.parquet(path)
    shared.remove(spark, path)
    assert not path_exists(spark, path)


def test_json_lines_with_and_without_schema(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"b": 1.5, "a": null}\n{"b": 2}\n')
    assert tables.read_json_lines(spark, str(path)).columns == ["a", "b"]
    schema = spark.createDataFrame([], "b double, a int").schema
    assert tables.read_json_lines(spark, str(path), schema).schema == schema
