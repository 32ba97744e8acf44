import datetime

import pytest
from pyspark.sql import functions as F

from mergestone.engine import MINIBATCH, Table, WriteOptions
from mergestone.functions.predicates import Lit, Op, Ref
from mergestone.operators.partition import MAXVALUE, RangePartitioning
from mergestone.tabledef import TableDef

KIND = "id long, name string, age int"
UPSERT = WriteOptions(mode="upsert")


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def users(spark, path, **more):
    table = TableDef.of("users", {"id": "bigint NOT NULL", "name": "varchar(255)", "age": "int"}, primary_key=("id",), unique=[("age",)], **more)
    return Table(spark, f"file://{path}/users", table).create()


def test_append_upsert_snapshots(spark, tmp_path):
    table = users(spark, tmp_path)
    first = table.write(spark.createDataFrame([(1, "before", 1), (2, "before", 10)], KIND))
    second = table.write(spark.createDataFrame([(1, "after", 2), (3, "new", 10)], KIND), UPSERT)
    assert rows(table.read()) == [(1, "after", 2), (3, "new", 10)] and second > first
    assert rows(table.read(version=first)) == [(1, "before", 1), (2, "before", 10)]
    assert table.read(version=1).count() == 0 and rows(table.read(timestamp="2999-01-01T00:00:00Z")) == rows(table.read())
    assert table.read(version=first, timestamp="2999-01-01T00:00:00Z").count() == 2
    with pytest.raises(ValueError, match="upsert"):
        table.write(spark.createDataFrame([(1, "x", 99)], KIND))
    assert rows(table.read(columns=["ID"], where=Op.of("<", Lit(1), Ref("id")))) == [(3,)]
    seen = table.read(metadata={"commit_version": "v"}).first()
    assert seen["v"] == second and seen["source_event"] == "SNAPSHOT"
    with pytest.raises(ValueError, match="read-only"):
        table.write(table.read(metadata=True), UPSERT)


def test_duplicates_of_a_batch(spark, tmp_path):
    table = users(spark, tmp_path)
    batch = spark.createDataFrame([(1, "a", 1, 1), (1, "b", 2, 2), (2, "c", None, 3), (3, "d", None, 4)], KIND + ", seq int")
    with pytest.raises(ValueError, match="collide"):
        table.write(batch.drop("seq"))
    table.write(batch, WriteOptions(deduplicate=True, sequence=("seq",)))
    assert sorted((r["id"], r["name"]) for r in table.read().collect()) == [(1, "b"), (2, "c"), (3, "d")]


def test_changes_and_their_gate(spark, tmp_path):
    table = users(spark, tmp_path)
    table.write(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], KIND))
    changes = spark.createDataFrame([(1, "a", 1, "delete"), (2, "b", 2, "update_preimage"), (2, "c", 2, "update_postimage")], KIND + ", _change_type string")
    with pytest.raises(ValueError, match="minibatch"):
        table.write(changes, WriteOptions(mode="upsert", deletes=True))
    table.write(changes, WriteOptions(mode="upsert", transaction=MINIBATCH, deletes=True))
    assert rows(table.read()) == [(2, "c", 2)]
    with pytest.raises(ValueError, match="not supported"):
        table.write(changes, WriteOptions(transaction="checkpoint"))


def test_update_columns(spark, tmp_path):
    made = TableDef.of("wide", {"id": "bigint NOT NULL", "a": "int", "b": "int"}, primary_key=("id",))
    table = Table(spark, f"file://{tmp_path}/wide", made).create()
    kind = "id long, a int, b int"
    table.write(spark.createDataFrame([(1, 5, 0)], kind), WriteOptions(mode="upsert", update_columns=("id", "a")))
    table.write(spark.createDataFrame([(1, 0, 7)], kind), WriteOptions(mode="upsert", update_columns=("id", "b")))
    assert rows(table.read()) == [(1, 5, 7)]


def test_generated_ids(spark, tmp_path):
    made = TableDef.of("t", {"id": "bigint NOT NULL AUTO_INCREMENT", "v": "int"}, primary_key=("id",))
    table = Table(spark, f"file://{tmp_path}/t", made).create()
    for _ in range(2):
        table.write(spark.range(50).select(F.lit(None).cast("long").alias("id"), F.col("id").cast("int").alias("v")))
    ids = [r["id"] for r in table.read().collect()]
    assert len(set(ids)) == 100 and None not in ids


def test_partitions(spark, tmp_path):
    made = TableDef.of("days", {"id": "bigint NOT NULL", "day": "date"}, primary_key=("id",), partitioning=RangePartitioning("day", (2000, 2010, MAXVALUE), year=True))
    table = Table(spark, f"file://{tmp_path}/days", made).create()
    table.write(spark.createDataFrame([(y, datetime.date(y, 3, 1)) for y in (1990, 2003, 2020)], "id long, day date"))
    found = table.read(between=(datetime.date(2001, 1, 1), datetime.date(2009, 1, 1)))
    assert rows(found) == [(2003, datetime.date(2003, 3, 1))] and table.read().columns == ["id", "day"]
    with pytest.raises(ValueError):
        users(spark, tmp_path).read(between=(1, 2))
