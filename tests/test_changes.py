"""Decoders, typed change rows, streams."""

import datetime
import decimal
import struct

import pytest
from pyspark.sql import functions as F

from mergestone.operators import changelog, lookup, ordered
from mergestone.operators.versions import VersionedTable
from mergestone.sources import change_events as C
from mergestone.streaming import streams
from mergestone.tabledef import TableDef


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def resolved(n):
    return {"schema": None, "table": None, "type_code": changelog.RESOLVED, "commit_version": n}


def test_messages_of_resolved_events_alone(spark):
    for n in range(4):
        events = [resolved(100 + k) for k in range(n)]
        found = C.decode_compact(C.encode_compact(events))
        assert [(e["commit_version"], e["schema"], e["table"]) for e in found] == [(100 + k, None, None) for k in range(n)]
    # by the format's rules: version, keys, no values, no dictionary, tables of sizes, their size backwards
    keys = C._u(7) + C._u(3) + C._s(0) + C._s(-1) + C._s(-1)
    tables = C._u(2) + C._s(len(keys)) + C._s(-len(keys)) + C._u(1) + C._s(0)
    (event,) = C.decode_compact(C._u(1) + keys + tables + C._u(len(tables)))
    assert event["type_code"] == changelog.RESOLVED and event["commit_version"] == 7


def test_kinds_of_ddl():
    events = [{"schema": "s", "table": "t", "type_code": 2, "commit_version": 1, "ddl": "alter table t add c int", "ddl_number": 5}]
    assert C.decode_compact(C.encode_compact(events))[0]["ddl_kind"] == "add column" and len(C.DDL_KINDS) == 36
    key, value = C.encode_framed([({"scm": "s", "tbl": "t", "t": 2, "ts": 4}, {"q": "drop table t", "t": 4})])
    assert C.decode_framed(key, value)[0]["ddl_kind"] == "drop table"


ALL = TableDef.of(
    "all_types",
    {
        "c1": "tinyint", "c2": "bigint unsigned", "c3": "varchar(20)", "c4": "varbinary(20)", "c5": "double", "c6": "decimal(6,3)", "c7": "date", "c8": "time", "c9": "datetime", "c10": "timestamp",
        "c11": "year", "c12": "boolean", "c13": "json", "c14": "enum('1','2','3')", "c15": "set('a','b','c')", "c16": "blob",
    },
    primary_key=("c1",),
)


def test_typed_rows_of_all_types(spark):
    u, s = C.integer_body, lambda t: t.encode()
    row = [
        ("c1", 1, 0, u(-1)), ("c2", 8, 128, u(2**64 - 1, True)), ("c3", 15, 0, s("varchartype")), ("c4", 15, 1, b"\xff\x00"), ("c5", 5, 0, struct.pack("<d", 2.456789)), ("c6", 0xF6, 0, s("123.456")),
        ("c7", 10, 0, s("2020-08-10")), ("c8", 11, 0, s("15:30:29")), ("c9", 12, 0, s("2020-08-10 15:30:29")), ("c10", 7, 0, s("2020-08-10 16:30:29")), ("c11", 13, 0, u(2020)), ("c12", 1, 0, u(1)),
        ("c13", 0xF5, 0, s('{"a":1,"b":2}')), ("c14", 0xF7, 0, u(2, True)), ("c15", 0xF8, 0, u(5, True)), ("c16", 0xFC, 1, b"\x01\x02"),
    ]
    empty = [(n, k, f, None) for n, k, f, _ in row]
    message = C.encode_compact([{"schema": "S", "table": "T", "type_code": 1, "commit_version": 441735015790804992, "old": empty, "new": row}])
    events = C.decode(spark.createDataFrame([(bytearray(message),)], "value binary"), "compact")
    out = changelog.typed(events, ALL, metadata=True).first()
    new = out["new"]
    assert tuple(new)[:3] == (-1, decimal.Decimal(2**64 - 1), "varchartype") and bytes(new["c4"]) == b"\xff\x00" and (new["c5"], new["c6"]) == (2.456789, decimal.Decimal("123.456"))
    assert new["c7"] == datetime.date(2020, 8, 10) and new["c8"] == datetime.timedelta(hours=15, minutes=30, seconds=29) and new["c9"] == datetime.datetime(2020, 8, 10, 15, 30, 29)
    assert new["c10"] == datetime.datetime(2020, 8, 10, 16, 30, 29) and (new["c11"], new["c12"], new["c13"], new["c14"], new["c15"], bytes(new["c16"])) == (2020, 1, '{"a":1,"b":2}', "2", "a,c", b"\x01\x02")
    assert set(out["old"].asDict().values()) == {None}
    assert (out["schema"], out["table"], out["type"], out["type_code"], out["source_event"], out["commit_version"]) == ("S", "T", "row_changed", 1, "STREAMING", 441735015790804992)
    with pytest.raises(ValueError):
        changelog.event_metadata(events, {"nothing": "x"})


def field(number, value):
    if isinstance(value, int):
        return C._u(number << 3) + C._u(value)
    return C._u(number << 3 | 2) + C._u(len(value)) + value


def packet(entries):
    body = field(1, 7) + b"".join(field(2, e) for e in entries)
    return field(3, 7) + field(5, body)


def entry(kind, rows_, ddl=0, entry_type=2):
    column = lambda n, v, up: field(3, n.encode()) + (field(6, 1) if v is None else field(8, v.encode())) + field(5, int(up))
    made = b"".join(field(12, b"".join(field(1, column(*c)) for c in before) + b"".join(field(2, column(*c)) for c in after)) for before, after in rows_)
    change = field(2, kind) + field(10, ddl) + made
    return field(1, field(6, 9) + field(8, b"Shop") + field(9, b"Orders")) + field(2, entry_type) + field(3, change)


def test_canal_packets(spark):
    made = packet([
        entry(1, [], entry_type=1), entry(1, [([], [("ID", "1", True), ("Name", None, True)])]),
        entry(2, [([("ID", "1", False), ("Name", None, False)], [("ID", "1", False), ("Name", "ls", True)])]), entry(3, [([("ID", "1", False), ("Name", "ls", False)], [])]), entry(7, [], ddl=1),
    ])
    frame = spark.createDataFrame([(bytearray(made),), (bytearray(b"\x08"),)], "value binary")
    found = C.decode_canal_protobuf(frame, ignore_errors=True).collect()
    assert [(r["old"], r["new"]) for r in found] == [(None, {"id": "1", "name": None}), ({"id": "1", "name": None}, {"id": "1", "name": "ls"}), ({"id": "1", "name": "ls"}, None)]
    assert {(r["schema"], r["table"], r["commit_version"]) for r in found} == {("shop", "orders", 9 << 18)}
    with pytest.raises(Exception):
        C.decode_canal_protobuf(frame).collect()


def test_canal_with_versions_of_its_own(spark):
    one = '{"database":"s","table":"t","type":"INSERT","es":3,"isDdl":false,"data":[{"A":"1"}],"old":null,"_ext":{"commitTs":77}}'
    frame = spark.createDataFrame([(one,), (one.replace(',"_ext":{"commitTs":77}', ""),)], "value string")
    assert [r["commit_version"] for r in C.decode_canal(frame, own_version="_ext.commitTs", ignore_errors=True).collect()] == [77]
    with pytest.raises(Exception, match="commit version"):
        C.decode_canal(frame, own_version="_ext.commitTs").collect()


def test_values_carried_along_a_hot_key(spark):
    made = [(i, 1 if i % 10 else i % 7, i % 13 if i % 3 else None) for i in range(3000)]
    frame = spark.createDataFrame(made, "at long, k long, v long")
    last, most, want = {}, {}, []
    for at, k, v in made:
        want.append((at, last.get(k), most.get(k)))
        if v is not None:
            last[k], most[k] = v, max(v, most.get(k, v))
    got = ordered.greatest_before(ordered.latest_before(frame, ["k"], "at", F.col("v"), "a", 16), ["k"], "at", F.col("v"), "b", 16)
    assert sorted(tuple(r) for r in got.select("at", "a", "b").collect()) == want
    assert ordered.latest_before(frame.limit(0), ["k"], "at", F.col("v"), "a").count() == 0


def test_look_ups(spark):
    facts = spark.createDataFrame([(1, 5), (1, 10), (2, 9), (None, 9), (3, 20)], "k long, at long")
    log = spark.createDataFrame([(1, 6, "insert", "a"), (1, 10, "update_postimage", "b"), (2, 1, "insert", "c"), (2, 8, "delete", None), (None, 1, "insert", "n")], "k long, commit_version long, _change_type string, name string")
    assert rows(lookup.lookup_as_of(facts, log, ["k"], "at")) == rows(spark.createDataFrame([(1, 5, None), (1, 10, "b"), (2, 9, None), (None, 9, None), (3, 20, None)], "k long, at long, name string"))
    dim = spark.createDataFrame([(1, "x"), (None, "n")], "k long, name string")
    for most in (0, 100):
        assert rows(lookup.lookup_join(facts, dim, ["k"], most).select("k", "at", "name")) == rows(facts.withColumn("name", F.when(F.col("k") == 1, "x")))
    with pytest.raises(ValueError):
        lookup.lookup_join(facts, dim, ["k.x"])


def test_hybrid_stream_is_snapshot_and_then_log(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t")
    table.commit(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), 100)
    kind = "id long, v string, commit_version long, _change_type string"
    spark.createDataFrame([(1, "old", 50, "insert"), (2, "b", 100, "insert"), (3, "c", 150, "insert"), (1, "a", 160, "delete")], kind).coalesce(1).write.parquet(f"{tmp_path}/log")
    stream, version = streams.hybrid_stream(table, streams.read_stream(spark, f"{tmp_path}/log"), ["id"])
    assert stream.isStreaming and version == 100
    out = streams.run_to_end(stream)
    assert rows(out.groupBy("source_event").count()) == [("SNAPSHOT", 2), ("STREAMING", 3)]
    assert rows(changelog.materialise(out.drop("source_event"), ["id"]).select("id", "v")) == [(2, "b"), (3, "c")]
    assert streams.start_of_log(100 << 18) == 100 - 60_000 and streams.start_of_log(5, 7) == 7
    with pytest.raises(ValueError):
        streams.refuse_limit(stream)


def test_options_of_kafka():
    made = streams.kafka_options("h:1", topic=["a", "b"], start_ms=5, group="g")
    assert made["subscribe"] == "a,b" and made["startingTimestamp"] == "5" and made["kafka.group.id"] == "g"
    assert streams.kafka_options("h:1", partitions={"a": [0, 1]})["assign"] == '{"a": [0, 1]}' and streams.kafka_options("h", pattern="a.*")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        streams.kafka_options("h:1", topic="a", pattern="b")


def test_windows_of_a_stream_come_out_whole_and_once(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    spark.createDataFrame([(at + datetime.timedelta(minutes=m), m) for m in range(0, 300, 7)], "ts timestamp, n int").coalesce(1).write.parquet(f"{tmp_path}/in")
    out = streams.windows_to_end(streams.read_stream(spark, f"{tmp_path}/in"), "ts", "10 minutes", lambda e: e.groupBy(F.window("ts", "1 hour")).agg(F.count("*").alias("n")))
    assert [r["n"] for r in out.orderBy("window").collect()] == [9, 9, 8, 9, 8]


def test_streaming_dedup_lets_null_keys_pass(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    made = [(at, 1, 1), (at, 1, 2), (at, None, 3), (at, None, 4), (at, 2, 3), (at, 3, 9)]
    spark.createDataFrame(made, "ts timestamp, a int, b int").coalesce(1).write.parquet(f"{tmp_path}/in")
    out = streams.run_to_end(streams.dedup_within(streams.read_stream(spark, f"{tmp_path}/in"), [("a",)], "ts", "1 hour"))
    assert sorted(((r["a"] or 0) for r in out.collect())) == [0, 0, 1, 2, 3]
