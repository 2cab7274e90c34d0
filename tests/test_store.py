"""Collections: the commit log, and an external store through the data source."""

import threading

import pyarrow as pa
import pytest
from pyspark.sql import datasource as D
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covey import errors
from covey.sinks import collections, commitlog
from covey.sinks.collections import CollectionStore
from covey.sinks.folder_store import FolderStore
from covey.sources import documents
from covey.sources.documents import Condition

# --- commit log ----------------------------------------------------------------------------


def test_put_if_absent(spark, tmp_path):
    path = f"{tmp_path}/log/1.json"
    assert commitlog.put_if_absent(spark, path, "one")
    assert not commitlog.put_if_absent(spark, path, "two")
    assert (tmp_path / "log" / "1.json").read_text() == "one"
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["1.json"]


def test_writers_at_once_lose_nothing(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path))
    failed = []

    def write(n):
        try:
            for i in range(4):
                store.append("things", spark.createDataFrame([(n, i)], "writer int, i int"))
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    got = sorted((r.writer, r.i) for r in store.read("things").collect())
    assert got == [(n, i) for n in range(4) for i in range(4)]
    assert store.versions("things") == list(range(1, 17))


def test_a_late_append_goes_on_from_a_replacement(spark, tmp_path, monkeypatch):
    """Another writer commits between this one's look and its entry."""
    store = CollectionStore(spark, str(tmp_path))
    store.append("things", spark.createDataFrame([(1,)], "i int"))
    put, meanwhile = commitlog.put_if_absent, []

    def late(*args):
        if not meanwhile:
            meanwhile.append(True)
            store.replace("things", spark.createDataFrame([(7,)], "i int"))
        return put(*args)

    monkeypatch.setattr(commitlog, "put_if_absent", late)
    store.append("things", spark.createDataFrame([(2,)], "i int"))
    assert sorted(r.i for r in store.read("things").collect()) == [2, 7]


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_new_fields_are_read_back(spark, tmp_path, fmt):
    store = CollectionStore(spark, str(tmp_path), fmt)
    store.append("things", spark.sql("SELECT 1 AS id, 5 AS n, named_struct('a', 1) AS s"))
    store.append("things", spark.sql("SELECT 'x' AS extra, 2 AS id, named_struct('a', 2, 'b', 'deep') AS s"))
    store.append("things", spark.sql("SELECT 3 AS id, 2.5D AS n"))
    rows = store.read("things").orderBy("id").collect()
    assert [(r.id, r.n, r.extra) for r in rows] == [(1, 5.0, None), (2, None, "x"), (3, 2.5, None)]
    assert [r.s and tuple(r.s) for r in rows] == [(1, None), (2, "deep"), None]
    assert store.read("things", ["extra"], optional=["id", "none"]).columns == ["extra", "id"]


def test_a_field_of_another_kind_is_refused(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path))
    store.append("things", spark.sql("SELECT 1 AS id"))
    with pytest.raises(errors.SchemaConflict):
        store.append("things", spark.sql("SELECT 'one' AS id"))
    assert store.read("things").count() == 1
    store.replace("things", spark.sql("SELECT 'one' AS id"))
    assert store.read("things").first().id == "one"


def test_many_appends_become_one_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(collections, "MOST_PARTS", 3)
    store = CollectionStore(spark, str(tmp_path))
    for i in range(9):
        store.append("things", spark.sql(f"SELECT {i} AS id" + (", 1 AS more" if i == 5 else "")))
        assert len(store._log("things").latest().parts) <= 3
    assert sorted(r.id for r in store.read("things").collect()) == list(range(9))
    assert store.read("things", ["more"]).filter("more = 1").count() == 1


def test_old_parts_stay_for_one_replacement(spark, tmp_path):
    store = CollectionStore(spark, str(tmp_path))
    store.replace("things", spark.range(3))
    reading = store.read("things")
    store.replace("things", spark.range(4))
    assert reading.count() == 3
    for n in range(5, 9):
        store.replace("things", spark.range(n))
    folders = [p for p in (tmp_path / "things").iterdir() if p.name.startswith("part-")]
    assert len(folders) == 2


# --- external store ------------------------------------------------------------------------


@pytest.fixture
def store(spark, tmp_path):
    documents.register(spark)
    options = {"client": "covey.sinks.folder_store:FolderStore", "uri": str(tmp_path), "batch_rows": "7", "partition_rows": "20"}
    return CollectionStore(spark, None, documents.FORMAT, options)


def staged(tmp_path):
    return sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.parquet"))


def test_replace_append_and_read(spark, store):
    df = spark.range(50).selectExpr("id", "CAST(id AS STRING) AS name", "CAST(id AS FLOAT) / 2 AS half", "array(id) AS ids", "current_date() AS day")
    with pytest.raises(Exception, match="no collection"):
        store.read("things")
    assert store.replace("things", df) == 50
    assert store.replace("things", df.limit(20)) == 20
    got = store.read("things", ["half", "name"], optional=["ids", "absent"])
    assert got.columns == ["half", "name", "ids"]
    assert {(r.name, r.half, tuple(r.ids)) for r in got.collect()} == {(str(i), i / 2, (i,)) for i in range(20)}
    store.append("things", spark.sql("SELECT 99L AS id, 'new' AS extra"))
    assert store.read("things").filter("extra = 'new'").first().id == 99
    assert store.read("things").count() == 21
    assert store.import_table("others", df, "somewhere") == 50
    assert store.read("imports").first().asDict() == {"collection": "others", "source_path": "somewhere", "rows": 50}
    store.replace("things", df.limit(0))
    with pytest.raises(errors.EmptyCollection):
        store.read("things")


def test_a_failing_task_leaves_the_old_rows(spark, store, tmp_path):
    store.replace("things", spark.range(30))
    before = staged(tmp_path)
    broken = spark.range(0, 400, 1, 4).selectExpr("IF(id = 390, raise_error('broken'), id) AS id")
    with pytest.raises(Exception, match="broken"):
        store.replace("things", broken)
    assert store.read("things").count() == 30
    assert staged(tmp_path) == before


def test_a_task_that_outlives_its_run_leaves_nothing(tmp_path):
    client, batch = FolderStore({"uri": str(tmp_path)}), pa.record_batch({"i": pa.array([1], pa.int32())})
    client.put("things", "run", "early", batch)
    client.abort("things", "run")
    client.put("things", "run", "late", batch)
    assert staged(tmp_path) == []


def test_a_repeated_attempt_adds_nothing(tmp_path):
    source = documents.DocumentSource({"client": "covey.sinks.folder_store:FolderStore", "uri": str(tmp_path), "collection": "things", "batch_rows": "2"})
    writer = source.writer(T.StructType.fromDDL("i int"), False)
    rows = [pa.record_batch({"i": pa.array(range(n), pa.int32())}) for n in (5, 3)]
    lost = writer.write(iter(rows))
    counted = [writer.write(iter(rows)), None]
    assert set(lost.keys).isdisjoint(counted[0].keys) and len(staged(tmp_path)) == 10
    for _ in range(2):
        writer.commit(counted)
    assert sum(s.rows for s in source.client.segments("things")) == 8
    assert len(staged(tmp_path)) == 5
    writer.abort([None])
    assert staged(tmp_path) == []


def test_two_stores_append_at_once(tmp_path):
    client = FolderStore({"uri": str(tmp_path)})
    schema, failed = T.StructType.fromDDL("i int").json(), []

    def write(n):
        try:
            for k in range(10):
                client.put("things", f"r{n}-{k}", "a", pa.record_batch({"i": pa.array([n], pa.int32())}))
                client.commit("things", f"r{n}-{k}", ["a"], schema, False)
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and len(client.segments("things")) == 40


def test_partitions_follow_the_rows(spark, store):
    store.replace("things", spark.range(0, 100, 1, 4))
    # Batches of 7 rows, partitions of 20.
    assert store.read("things").rdd.getNumPartitions() in range(5, 13)


def test_filters_reach_the_store(spark, store):
    df = spark.range(60).selectExpr(
        "id", "IF(id % 5 = 0, NULL, concat('n', id)) AS name", "IF(id % 2 = 0, CAST('NaN' AS DOUBLE), CAST(id AS DOUBLE)) AS x", "id % 3 = 0 AS flag"
    )
    store.replace("things", df)
    read, plain = store.read("things"), df.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    for condition in ("id > 50", "id <= 3 AND name IS NULL", "name LIKE 'n1%'", "id IN (3, 4, 500)", "name = 'n7'", "flag = true AND id >= 55", "x > 10", "id % 2 = 1", "NOT (id = 3)", "name IS NOT NULL"):
        want = sorted(map(repr, plain.filter(condition).collect()))
        assert sorted(map(repr, read.filter(condition).collect())) == want, condition
    plan = read.filter("id > 50 AND name IS NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan


def test_which_filters_are_conditions():
    schema = T.StructType.fromDDL("i long, s string, d double, n struct<a: int>")
    assert documents.condition_of(D.GreaterThan(("i",), 5), schema) == Condition("i", ">", 5)
    assert documents.condition_of(D.In(("s",), ("a", "b")), schema) == Condition("s", "in", ["a", "b"])
    assert documents.condition_of(D.IsNull(("d",)), schema) == Condition("d", "null")
    for other in (D.GreaterThan(("d",), 0.5), D.EqualTo(("n", "a"), 1), D.In(("s",), ("a", None)), D.EqualTo(("z",), 1), D.Not(D.EqualTo(("i",), 5))):
        assert documents.condition_of(other, schema) is None
