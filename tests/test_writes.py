import pytest
from pyspark.sql import functions as F

from mergestone.operators import dedup, rowid, versions, write
from mergestone.tabledef import TableDef


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_last_wins_over_several_keys(spark):
    """Each of rows 2 to 5 shares one key with row 1, which comes later."""
    data = [
        (1, (1, 2, 13, 14, 15, 16, 17)), (2, (21, 22, 3, 24, 25, 26, 27)), (3, (31, 32, 33, 4, 5, 36, 37)), (4, (41, 42, 43, 44, 45, 6, 47)),
        (5, (1, 2, 3, 4, 5, 6, 7)), (6, (2, 3, 4, 5, 6, 7, 8)), (7, (2, 4, 6, 7, 8, 9, 10)),
    ]
    frame = spark.createDataFrame([(s, *r) for s, r in data], "seq int, c1 int, c2 int, c3 int, c4 int, c5 int, c6 int, c7 int")
    kept = dedup.last_wins(frame, [("c1", "c2"), ("c3",), ("c4", "c5"), ("c6",)], ["seq"])
    assert sorted(r["seq"] for r in kept.collect()) == [5, 6, 7]


def test_null_keys_never_collide(spark):
    frame = spark.createDataFrame([(1, None, "tony"), (2, None, "mike"), (3, 5, "a"), (4, 5, "b")], "id int, age int, name string")
    assert sorted(r["id"] for r in dedup.last_wins(frame, [("id",), ("age",)], ["id"]).collect()) == [1, 2, 4]
    assert sorted(r["id"] for r in dedup.first_wins(frame, [("age",)], ["id"]).collect()) == [1, 2, 3]
    with pytest.raises(ValueError, match="age"):
        dedup.reject_duplicates(frame, [("id",), ("age",)])
    assert dedup.reject_duplicates(frame, [("id",)]) is frame


def test_append_upsert_and_conflicts(spark):
    kind = "id long, name string, age int"
    target = spark.createDataFrame([(1, "before", 1), (2, "before", 10)], kind)
    source = spark.createDataFrame([(1, "after", 2), (2, "after", 20)], kind)
    keys = [("id",), ("age",)]
    assert rows(write.replace_upsert(target, source, keys)) == [(1, "after", 2), (2, "after", 20)]
    with pytest.raises(ValueError, match="upsert"):
        write.append(target, source, keys)
    assert rows(write.append(target, spark.createDataFrame([(3, "new", 3)], kind), keys))[-1] == (3, "new", 3)


def test_replace_and_update_differ_with_two_keys(spark):
    kind = "id long, age int"
    target = spark.createDataFrame([(1, 1), (2, 2)], kind)
    source = spark.createDataFrame([(1, 2)], kind)
    assert rows(write.replace_upsert(target, source, [("id",), ("age",)])) == [(1, 2)]
    assert rows(write.update_upsert(target, source, [("id",), ("age",)])) == [(1, 2), (2, 2)]


def test_partial_upserts_build_a_wide_row(spark):
    kind = "c1 long, c2 long, c3 long, c4 long"
    table = TableDef.of("t", {"c1": "bigint NOT NULL", "c2": "bigint", "c3": "bigint", "c4": "bigint"}, unique=[("c1",)])
    key = write.check_partial(table, ["c1", "c4"], write.UPSERT)
    now = spark.createDataFrame([], kind)
    for row, update in (((1, 2, 3, 32), ["c1", "c4"]), ((1, 28, 9, 4), ["c1", "c3"]), ((1, 7, 5, 46), ["c1", "c2"])):
        now = write.partial_upsert(now, spark.createDataFrame([row], kind), key, update)
    assert rows(now) == [(1, 7, 9, 32)]


def test_partial_upserts_are_checked():
    one = TableDef.of("t", {"c1": "bigint NOT NULL", "c2": "bigint"}, unique=[("c1",)])
    two = TableDef.of("t", {"c1": "bigint NOT NULL", "c2": "bigint NOT NULL"}, primary_key=("c1",), unique=[("c2",)])
    loose = TableDef.of("t", {"c1": "bigint", "c2": "bigint"}, unique=[("c1",)])
    for table, update, mode in ((one, ["c1"], write.APPEND), (two, ["c1"], write.UPSERT), (loose, ["c1"], write.UPSERT), (one, ["c2"], write.UPSERT), (one, ["x"], write.UPSERT)):
        with pytest.raises(ValueError):
            write.check_partial(table, update, mode)
    assert write.check_partial(two, ["c1"], write.UPSERT, skip=True) == ("c1",)


def test_delete_by_first_key_without_null(spark):
    kind = "c1 long, c2 long"
    target = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (None, 4)], kind)
    gone = spark.createDataFrame([(1, 9), (None, 4), (7, 7)], kind)
    assert rows(write.delete(target, gone, [("c1",), ("c2",)])) == [(2, 2), (3, 3)]
    with pytest.raises(ValueError):
        write.delete_key(TableDef.of("t", {"c1": "int"}))


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    changes = spark.createDataFrame(
        [(1, "a", 1, "update_preimage"), (1, "x", 2, "update_postimage"), (2, "b", 3, "delete"), (3, "c", 4, "insert"), (3, "d", 5, "update_postimage")],
        "id long, v string, seq int, _change_type string",
    )
    assert rows(write.apply_changes(target, changes, [("id",)], ["seq"])) == [(1, "x"), (3, "d")]
    assert rows(write.apply_changes(target, changes, [("id",)], ["seq"], deletes=False)) == [(1, "x"), (2, "b"), (3, "d")]
    with pytest.raises(ValueError, match="upsert"):
        write.apply_changes(target, changes, [("id",)], ["seq"], mode=write.APPEND)


def test_versions_are_published_whole(spark, tmp_path):
    table = versions.VersionedTable(spark, f"file://{tmp_path}/t")
    with pytest.raises(ValueError):
        table.read()
    table.commit(spark.createDataFrame([(1, 1)], "c1 int, c2 int"), 10)
    table.commit(spark.createDataFrame([(1, 2)], "c1 int, c2 int"), 20, expected=10)
    assert rows(table.read(15)) == [(1, 1)] and rows(table.read()) == [(1, 2)]
    with pytest.raises(ValueError):
        table.commit(spark.createDataFrame([(9, 9)], "c1 int, c2 int"), 20)
    with pytest.raises(ValueError):
        table.commit(spark.createDataFrame([(9, 9)], "c1 int, c2 int"), 30, expected=10)
    assert table.versions() == [10, 20]


def test_snapshot_prefers_version_to_timestamp(spark):
    log = spark.createDataFrame([(1, 5, "a", "insert"), (1, 9, "b", "update_postimage"), (2, 6, "c", "delete")], "id int, commit_version long, v string, _change_type string")
    assert rows(versions.as_of(log, ["id"], version=5, timestamp="2030-01-01T00:00:00Z").select("v")) == [("a",)]
    assert rows(versions.as_of(log, ["id"], timestamp="2030-01-01T00:00:00Z").select("v")) == [("b",)]
    stamp = spark.range(1).select(F.unix_millis(versions.timestamp_of(F.lit(441735015790804992))).alias("ms")).first()["ms"]
    assert stamp == 1685085356868


def test_row_ids(spark):
    frame = spark.range(0, 20000, 3).withColumnRenamed("id", "k")
    made = rowid.numbered(frame, "k", "n", width=100).collect()
    assert [r["n"] for r in sorted(made, key=lambda r: r["k"])] == list(range(1, len(made) + 1))
    allocator = rowid.Allocator(step=10, bits=6)
    assert allocator.take(15) == (1, 20) and allocator.take(1) == (21, 30)
    with pytest.raises(OverflowError):
        allocator.take(60)
    with pytest.raises(OverflowError):
        rowid.check_shards(15, False, 1 << 48)
    rowid.check_shards(15, True, 1 << 48)
    given = spark.createDataFrame([(1, None), (2, 77)], "k long, id long")
    assert rows(rowid.with_auto_id(given, "id", "k", base=5)) == [(1, 6), (2, 77)]
    assert rows(rowid.with_auto_id(given, "id", "k", base=5, ignore_given=True)) == [(1, 6), (2, 7)]
