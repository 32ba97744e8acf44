import datetime
import json
import os
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestone import types
from mergestone.catalog import Catalog
from mergestone.functions import predicates as P
from mergestone.functions import scalar
from mergestone.operators import changelog, partition
from mergestone.plans import changes
from mergestone.sources import change_events
from mergestone.streaming import streams
from mergestone.tabledef import TableDef


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("bit(1)", T.BooleanType()), ("bit(8)", T.LongType()), ("tinyint", T.ByteType()), ("TINYINT(3) UNSIGNED", T.ShortType()), ("year", T.ShortType()), ("mediumint unsigned", T.LongType()),
        ("int(11)", T.IntegerType()), ("bigint unsigned", T.DecimalType(20, 0)), ("decimal(6,3)", T.DecimalType(6, 3)), ("time", T.DayTimeIntervalType()),
        ("datetime(3)", T.TimestampNTZType()), ("timestamp", T.TimestampType()), ("json", T.StringType()), ("enum('1','2')", T.StringType()), ("varbinary(20)", T.BinaryType()),
    ],
)
def test_types(text, kind):
    assert types.parse(text).spark == kind


def test_types_that_do_not_fit():
    for text in ("geometry", "decimal(65,2)", "no type!"):
        with pytest.raises(ValueError):
            types.parse(text).spark
    assert types.render(T.DecimalType(6, 3)) == "DECIMAL(6,3)" and types.parse("tinyint unsigned").bounds == (0, 255)


def test_conform(spark):
    table = TableDef.of("t", {"ID": "bigint NOT NULL", "n": "tinyint unsigned", "e": "enum('a','b')", "b": "binary(4)", "d": "decimal(6,2)", "s": "timestamp"}, primary_key=("ID",))
    frame = spark.createDataFrame([(1, 255, "a", b"x", 1.255, "0000-00-00 00:00:00")], "id long, n int, e string, b binary, d double, s string")
    out = table.conform(frame).first()
    assert (out["n"], out["e"], bytes(out["b"]), str(out["d"]), out["s"]) == (255, "a", b"x\x00\x00\x00", "1.26", None)
    for bad in ({"n": F.lit(256)}, {"e": F.lit("c")}, {"id": F.lit(None).cast("long")}):
        with pytest.raises(Exception, match="column"):
            table.conform(frame.withColumns(bad)).collect()
    with pytest.raises(ValueError):
        table.check_columns(frame.select("n", "id"))
    assert table.conform(frame.withColumn("e", F.lit(2))).first()["e"] == "b"


def test_partition_routing_and_pruning(spark):
    by_hash = partition.HashPartitioning("id", 3)
    frame = spark.createDataFrame([(-4,), (5,), (None,)], "id long")
    assert rows(partition.routed(frame, by_hash)) == [(-4, 1), (5, 2), (None, 0)]
    by_range = partition.RangePartitioning("id", (0, 10, 20))
    assert rows(partition.routed(frame, by_range)) == [(-4, 0), (5, 1), (None, 0)]
    with pytest.raises(Exception, match="no partition"):
        partition.routed(spark.createDataFrame([(20,)], "id long"), by_range).collect()
    assert by_range.prune(low=3, high=9) == [1] and by_range.prune(equal=10) == [2] and by_range.prune(low=12) == [2] and by_range.prune(high=-1) == [0]
    assert by_hash.prune(equal=-4) == [1] and by_hash.prune(low=4, high=5) == [1, 2]
    binary = partition.RangePartitioning("id", (partition.hex_bound("0x42"), partition.MAXVALUE))
    assert rows(partition.routed(spark.createDataFrame([(bytearray(b"A"),), (bytearray(b"Bx"),)], "id binary"), binary).select("_part")) == [(0,), (1,)]
    for bad in (lambda: partition.make("list", ["a"]), lambda: partition.make("range", ["a", "b"], [1]), lambda: partition.make("range", ["a"], [1], function="to_days"), lambda: partition.RangePartitioning("a", (2, 1))):
        with pytest.raises(ValueError):
            bad()


def test_pruning_reads_only_the_wanted_folders(spark, tmp_path):
    by_year = partition.RangePartitioning("day", (2000, 2010, partition.MAXVALUE), year=True)
    frame = spark.createDataFrame([(datetime.date(y, 5, 1),) for y in (1999, 2005, 2015)], "day date")
    partition.routed(frame, by_year).write.partitionBy("_part").parquet(f"{tmp_path}/t")
    found = partition.pruned(spark.read.parquet(f"{tmp_path}/t"), by_year, low=datetime.date(2004, 1, 1), high=datetime.date(2006, 1, 1))
    assert found.select("day").collect()[0][0] == datetime.date(2005, 5, 1)
    assert "PartitionFilters: [isnotnull(_part" in found._jdf.queryExecution().toString() or "_part" in found._jdf.queryExecution().toString()


KINDS = {"c1": "int", "c2": "int", "c3": "json"}
EQ = P.Op.of("=", P.Ref("c1"), P.Lit(1))
CROSS = P.Op.of("=", P.Ref("c1"), P.Ref("c2"))


def test_pushdown_keeps_what_is_supported():
    both = P.Op.of("and", EQ, CROSS)
    assert P.supported(both, KINDS) == EQ
    assert P.supported(P.Op.of("or", EQ, CROSS), KINDS) is None
    assert P.supported(P.Op.of("not", both), KINDS) is None
    assert P.supported(P.Op.of("=", P.Ref("c3"), P.Lit("x")), KINDS) is None
    assert P.normalise(P.Op.of("<", P.Lit(3), P.Ref("c1"))) == P.Op.of(">", P.Ref("c1"), P.Lit(3))
    assert P.normalise(P.Op.of("in", P.Ref("c1"), P.Lit(1), P.Lit(2))) == P.Op.of("or", EQ, P.Op.of("=", P.Ref("c1"), P.Lit(2)))
    assert P.of_domain("c1") == P.FALSE and P.of_domain("c1", everything=True) == P.TRUE


def test_durations(spark):
    frame = spark.createDataFrame([("15:30:29",), ("-838:59:59.5",), ("1:2",), (None,)], "t string")
    assert [r[0] for r in frame.select(scalar.duration_nanos(F.col("t"))).collect()] == [55829 * 10**9, -(3020399 * 10**9 + 5 * 10**8), None, None]


EVENTS = [
    {"schema": "S", "table": "T", "type_code": 1, "commit_version": 10, "new": [("Id", 8, 3, change_events.integer_body(-5)), ("F", 5, 0, struct.pack("<d", 1.5)), ("N", 15, 0, None), ("U", 3, 128, change_events.integer_body(300, True))]},
    {"schema": "S", "table": "T", "type_code": 1, "commit_version": 12, "partition": 3, "old": [("Id", 8, 3, change_events.integer_body(7))]},
    {"schema": None, "table": None, "type_code": 3, "commit_version": 15},
    {"schema": "S", "table": "T", "type_code": 2, "commit_version": 20, "ddl": "create table é"},
]


def test_compact_events_round_trip():
    a, b, c, d = change_events.decode_compact(change_events.encode_compact(EVENTS))
    assert a["new"] == {"id": "-5", "f": "1.5", "n": None, "u": "300"} and a["old"] is None and a["schema"] == "S"
    assert b["old"] == {"id": "7"} and b["new"] is None and (b["partition"], b["commit_version"]) == (3, 12)
    assert c["type_code"] == changelog.RESOLVED and c["schema"] is None and d["ddl"] == "create table é"
    assert change_events.decode_compact(change_events.encode_compact([])) == []
    with pytest.raises(ValueError):
        change_events.decode_compact(b"\x02\x00")


def test_framed_events(spark):
    key, value = change_events.encode_framed([({"scm": "s", "tbl": "t", "t": 1, "ts": 4}, {"u": {"A": {"t": 8, "v": 1}}, "p": {"A": {"t": 8, "v": 0}}}), ({"t": 3, "ts": 9}, None)])
    first, second = change_events.decode_framed(key, value)
    assert (first["old"], first["new"]) == ({"a": "0"}, {"a": "1"}) and second["type_code"] == 3
    frame = spark.createDataFrame([(bytearray(key), bytearray(value)), (bytearray(b"xx"), bytearray(b""))], "key binary, value binary")
    assert change_events.decode(frame, "framed", ignore_errors=True).count() == 2
    with pytest.raises(Exception):
        change_events.decode(frame, "framed").collect()
    with pytest.raises(ValueError):
        change_events.decode(frame, "other")


def test_canal_messages(spark):
    made = [
        {"database": "Shop", "table": "T", "type": "INSERT", "es": 3, "isDdl": False, "data": [{"ID": "1", "Name": "zs"}], "old": None},
        {"database": "Shop", "table": "T", "type": "UPDATE", "es": 4, "isDdl": False, "data": [{"ID": "1", "Name": "ls"}], "old": [{"Name": "zs"}]},
        {"database": "Shop", "table": "T", "type": "CREATE", "es": 5, "isDdl": True, "data": None, "old": None},
    ]
    frame = spark.createDataFrame([(json.dumps(m),) for m in made], "value string")
    insert, update = change_events.decode_canal(frame).orderBy("commit_version").collect()
    assert insert["new"] == {"id": "1", "name": "zs"} and insert["old"] is None and insert["commit_version"] == 3 << 18
    assert update["old"] == {"id": "1", "name": "zs"} and update["new"]["name"] == "ls"
    broken = frame.unionByName(spark.createDataFrame([("{no",)], "value string"))
    assert change_events.decode_canal(broken, ignore_errors=True).count() == 2
    with pytest.raises(Exception):
        change_events.decode_canal(broken).collect()


def test_stream_applied_twice_is_the_same(spark, tmp_path):
    from mergestone.operators.versions import VersionedTable

    spark.createDataFrame([(1, "a", 1, "insert"), (2, "b", 2, "insert")], "id long, v string, seq int, _change_type string").coalesce(1).write.parquet(f"{tmp_path}/in")
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    table.commit(spark.createDataFrame([], "id long, v string"), 1)
    for _ in range(2):
        streams.apply_stream(streams.read_stream(spark, f"{tmp_path}/in"), table, [("id",)], ["seq"], f"{tmp_path}/progress")
    spark.createDataFrame([(1, "a", 3, "delete")], "id long, v string, seq int, _change_type string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    streams.apply_stream(streams.read_stream(spark, f"{tmp_path}/in"), table, [("id",)], ["seq"], f"{tmp_path}/progress")
    assert rows(table.read()) == [(2, "b")]


def test_catalog(spark):
    catalog = Catalog(spark)
    catalog.create_database("Shop_Test", ignore_if_exists=True)
    assert catalog.database_exists("shop_test") and "information_schema" not in catalog.list_databases()
    table = TableDef.of("Users", {"ID": "bigint NOT NULL", "Name": "varchar(16)", "Age": "int unsigned"}, primary_key=("ID",), unique=[("Name",)])
    catalog.create_table("shop_test", table)
    assert catalog.definition("shop_test", "USERS") == table and catalog.primary_key("shop_test", "users") == ("id",)
    spark.sql("INSERT INTO shop_test.users VALUES (1, 'zs', 7)")
    catalog.add_column("shop_test", "users", "Note", "text")
    catalog.rename_column("shop_test", "users", "name", "label")
    assert catalog.unique_keys("shop_test", "users") == [("label",)]
    catalog.drop_column("shop_test", "users", "age")
    with pytest.raises(ValueError):
        catalog.drop_column("shop_test", "users", "id")
    catalog.rename_table("shop_test", "users", "people")
    assert catalog.list_tables("shop_test") == ["people"] and catalog.count("shop_test", "people") == 1
    assert rows(spark.table("shop_test.people")) == [(1, "zs", None)]
    catalog.drop_table("shop_test", "people")
    catalog.drop_database("shop_test")


def test_estimates(spark):
    from mergestone.functions.statistics import CountMin, Histogram

    rows_ = spark.range(10_000).select((F.col("id") % 100).alias("v")).unionByName(spark.createDataFrame([(None,)] * 5, "v long"))
    held = Histogram.of(rows_, "v", 20)
    assert sum(n for *_, n in held.buckets) == 10_000 and abs(held.less(30) - 3000) < 300 and abs(held.equal(7) - 100) < 60
    assert abs(held.greater(89) - 1000) < 300 and abs(held.between(10, 20) - 1000) < 300
    skewed = spark.range(10_000).select(F.when(F.col("id") < 5000, 1).otherwise(F.col("id") % 500).cast("long").alias("v"))
    sketch = CountMin.parse(bytes(skewed.agg(F.count_min_sketch("v", F.lit(0.005), F.lit(0.95), F.lit(3)).alias("s")).first()["s"]))
    assert sketch.total == 10_000 and 5010 <= sketch.most(1) and abs(sketch.estimate(1) - 5010) < 60 and abs(sketch.estimate(77) - 10) < 60
    with pytest.raises(ValueError):
        CountMin.parse(b"\x00" * 40)


def test_replayed_events_of_a_stream(spark, tmp_path):
    kind = "stream long, object string, commit_version long, type_code int, payload string, arrival long"
    made = [(1, "a", 5, 1, "x", 0), (1, "a", 5, 1, "again", 1), (1, "b", 4, 1, "y", 2), (1, None, 6, 3, None, 3), (1, "b", 6, 1, "late", 4), (1, "a", 7, 1, "z", 5), (2, "a", 1, 1, "w", 6)]
    frame = spark.createDataFrame(made, kind)
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    out = streams.run_to_end(changelog.drop_replayed_stream(streams.read_stream(spark, f"{tmp_path}/in"), ["object"]))
    batch = changelog.drop_replayed(frame, ["object"], "arrival")
    assert sorted(r["payload"] for r in out.collect()) == sorted(r["payload"] for r in batch.collect()) == ["w", "x", "y", "z"]


def test_local_limit(spark):
    assert partition.local_limit(spark.range(0, 100, 1, 4), 3).count() == 12


def test_stream_dedup_over_a_long_table_in_several_batches(spark, tmp_path, monkeypatch):
    batches = [[(1, "view", "2024-01-01")], [(2, "view", "2024-06-01")], [(1, "view", "2024-06-02"), (3, "click", "2024-01-02"), (None, "view", None)], [(2, "view", "2024-12-01"), (None, "view", "2024-12-02")]]
    (tmp_path / "events.parquet").mkdir()
    for number, made in enumerate(batches):
        frame = spark.createDataFrame(made, "user_id long, event_type string, ts string")
        frame.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/{number}")
        (part,) = (tmp_path / str(number)).glob("*.parquet")
        os.utime(part.rename(tmp_path / f"events.parquet/{number}.parquet"), (1000 + number, 1000 + number))
    read = streams.read_stream
    monkeypatch.setattr(streams, "read_stream", lambda spark, path: read(spark, path, files_per_batch=1))
    got = rows(changes.stream_dedup_watermark(spark, str(tmp_path)))
    assert got == [(1, "view"), (2, "view"), (3, "click"), (None, "view")]
