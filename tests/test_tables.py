import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from eventpipe.operators.objects import current_objects
from eventpipe.streaming.tables import BatchTable, KeyedTable
from eventpipe.streaming.warehouse import Warehouse

TEXT, INT = T.StringType(), T.IntegerType()
SCHEMA = T.StructType([
    T.StructField(n, k) for n, k in (("id", TEXT), ("v", TEXT), ("at", T.TimestampType()), ("p", INT), ("o", T.LongType()))
])
DATED = T.StructType([T.StructField(n, k) for n, k in (("object_key", TEXT), ("id", TEXT), ("day", INT))])


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], ["p", "o"], ["at"], buckets=4)


def put(table, batch, *values, run="r"):
    rows = [(id, v, dt.datetime(2024, 1, 1, 0, 0, batch), 0, batch * 100 + i) for i, (id, v) in enumerate(values)]
    table.write(table.spark.createDataFrame(rows, SCHEMA), batch, run)


def shown(table):
    return {r.id: r.v for r in table.current().collect()}


def test_a_batch_rewritten_after_a_fold_counts_as_rewritten(table):
    put(table, 0, ("a", "0"), ("b", "0"))
    put(table, 1, ("a", "1"), ("c", "first try"))
    table.compact()
    # The batch runs again, its commit was lost; a fetch answers otherwise this time.
    put(table, 1, ("a", "2"), ("d", "second try"))
    assert shown(table) == {"a": "2", "b": "0", "d": "second try"}
    put(table, 2, ("e", "2"))
    table.compact()
    assert shown(table) == {"a": "2", "b": "0", "d": "second try", "e": "2"}
    assert table._state()[1] == [("r", 2)]


def test_folders_are_bounded_after_a_thousand_batches(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], ["p", "o"], ["at"], buckets=2)
    put(table, 0, ("a", "0"))
    template = pq.read_schema(next((tmp_path / "t/log/run=r/batch_id=0").glob("*.parquet")))
    names = ["id", "v", "at", "p", "o"]
    for n in range(1, 1000):
        folder = tmp_path / f"t/log/run=r/batch_id={n}"
        folder.mkdir()
        columns = [pa.array([f"k{n % 7}"]), pa.array([str(n)]), pa.array([n], pa.timestamp("us", "UTC")), pa.array([0], pa.int32()), pa.array([n])]
        pq.write_table(pa.table(columns, names=names), folder / "part-0.parquet")
        (folder / "_SUCCESS").touch()
    assert template.names == names
    expected = {"a": "0", **{f"k{n % 7}": str(n) for n in range(993, 1000)}}
    assert shown(table) == expected
    table.compact()
    table.expire(0)
    assert shown(table) == expected
    assert os.listdir(tmp_path / "t/log/run=r") == ["batch_id=999"]


def test_a_reader_that_began_before_a_fold_finishes(table):
    put(table, 0, ("a", "0"))
    put(table, 1, ("b", "1"))
    before = table.current()
    table.compact()
    table.expire(3600)
    assert {r.id for r in before.collect()} == {"a", "b"}
    put(table, 2, ("c", "2"))
    on_snapshot = table.current()
    table.compact()
    table.expire(3600)
    assert {r.id for r in on_snapshot.collect()} == {"a", "b", "c"}
    table.expire(0)
    assert len(os.listdir(f"{table.root}/snapshot")) == len(os.listdir(f"{table.root}/cut_offs")) == 1
    assert shown(table) == {"a": "0", "b": "1", "c": "2"}
    # Another session still finds its way.
    other = KeyedTable(table.spark.newSession(), table.root, SCHEMA, ["id"], ["p", "o"], ["at"], buckets=4)
    assert shown(other) == {"a": "0", "b": "1", "c": "2"}


def test_many_later_bytes_are_sorted_as_spark_would(table, monkeypatch):
    import eventpipe.streaming.tables as tables

    put(table, 0, ("a", "0"), ("b", "0"))
    put(table, 1, ("b", "1"))
    table.compact()
    monkeypatch.setattr(tables, "HASHED_BYTES", 0)
    assert "ShuffledHashJoin" not in table.current()._jdf.queryExecution().executedPlan().toString()
    assert shown(table) == {"a": "0", "b": "1"}


def images(spark, batch, n, days=3):
    rows = [(f"images/{d}/{batch}-{i}", f"{batch}-{i}", d) for d in range(days) for i in range(n)]
    return spark.createDataFrame(rows, "object_key STRING, id STRING, day INT")


@pytest.fixture
def dated(spark, tmp_path):
    return BatchTable(spark, str(tmp_path / "d"), DATED, ["day"])


def files(table):
    return [f for _, _, names in os.walk(table.root) for f in names if f.endswith(".parquet")]


def test_a_batch_has_one_small_file_per_partition(spark, dated):
    dated.write(images(spark, 0, 50).repartition(16), 0, "r")
    assert len(files(dated)) == 3


def test_small_files_are_put_together_and_rows_stay(spark, dated):
    for batch in range(5):
        dated.write(images(spark, batch, 4), batch, "r")
    before = sorted(map(tuple, dated.read().collect()))
    late = dated.read()
    assert dated.fold() == [("r", 0, 3)]
    assert sorted(map(tuple, dated.read().collect())) == before
    assert {(r.run, r.batch_id) for r in dated.read(with_batch=True).collect()} == {("r", 3), ("r", 4)}
    dated.expire(3600)
    assert sorted(map(tuple, late.collect())) == before
    dated.expire(0)
    assert sorted(map(tuple, dated.read().collect())) == before and len(files(dated)) == 6
    assert dated.fold() == []
    # Spans grow: the next fold takes the span as one more folder of small files.
    for batch in (5, 6):
        dated.write(images(spark, batch, 4), batch, "r")
    assert dated.fold() == [("r", 0, 5)]
    dated.expire(0)
    assert dated.read().count() == 7 * 12 and dated.spans() == [("r", 0, 5)] and len(files(dated)) == 6


def test_large_files_are_left_alone(spark, dated):
    for batch, n in enumerate((4, 4, 4000, 4, 4, 4)):
        dated.write(images(spark, batch, n), batch, "r")
    made = dated.fold(small_file=4000)
    assert made == [("r", 0, 1), ("r", 3, 4)]
    assert dated.read().count() == 3 * (5 * 4 + 4000)
    # So many bytes make a span, no more.
    assert dated.fold(small_file=1 << 20, span_bytes=1) == []


def test_order_of_puts_across_partitions(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "w"), buckets=2)
    schema = warehouse.images_table.schema
    day = dt.date(2024, 1, 1)

    def stored(text, minute, partition, offset):
        at = dt.datetime(2024, 1, 1, 0, minute)
        return ("images/k", "image/png", text, len(text), day, "k", "IMAGE", at, "ui", at, None, None, at, partition, offset)

    warehouse.images_table.write(spark.createDataFrame([stored(b"old", 1, 5, 900)], schema), 0, "r")
    warehouse.images_table.write(spark.createDataFrame([stored(b"new", 2, 2, 3)], schema), 1, "r")
    assert [bytes(r.content) for r in warehouse.current_objects().collect()] == [b"new"]
    assert current_objects(warehouse.image_objects().where(F.col("src_partition") == 5)).count() == 1
