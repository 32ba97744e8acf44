"""Queries of change capture and streaming: codecs, changelogs, windows over streams."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestone.operators import changelog, versions
from mergestone.plans.base import Book, table
from mergestone.sources import change_events
from mergestone.streaming import streams
from mergestone.tabledef import TableDef

book = Book()
QUERIES, ORACLE_SQL = book.queries, book.sql


def _events(spark, sf_dir) -> DataFrame:
    """Changes of orders: every third is an insert, a delete or an update of status and price."""
    k = F.col("o_orderkey")
    row = lambda status, price: F.struct(k.alias("o_orderkey"), status.alias("o_orderstatus"), price.alias("o_totalprice"))
    old = F.when(k % 3 != 0, row(F.col("o_orderstatus"), F.col("o_totalprice")))
    new = F.when(k % 3 != 1, row(F.when(k % 3 == 0, F.col("o_orderstatus")).otherwise(F.lit("F")), F.col("o_totalprice")))
    return table(spark, sf_dir, "orders").select((k * 4).alias("commit_version"), F.lit(1).alias("type_code"), F.lit("Shop").alias("schema"), F.when(k % 2 == 0, "Orders").otherwise("Old_Orders").alias("table"), old.alias("old"), new.alias("new"))


_CHANGES = """
    SELECT o_orderkey * 4 AS commit_version, o_orderkey, o_orderstatus, o_totalprice, 'insert' AS _change_type FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL SELECT o_orderkey * 4, o_orderkey, o_orderstatus, o_totalprice, 'delete' FROM orders WHERE o_orderkey % 3 = 1
    UNION ALL SELECT o_orderkey * 4, o_orderkey, o_orderstatus, o_totalprice, 'update_preimage' FROM orders WHERE o_orderkey % 3 = 2{only}
    UNION ALL SELECT o_orderkey * 4, o_orderkey, 'F', o_totalprice, 'update_postimage' FROM orders WHERE o_orderkey % 3 = 2{only}"""
_COLS = ["o_orderkey", "o_orderstatus", "o_totalprice"]
_OUT = ["commit_version", *_COLS, "_change_type"]


@book.add(_CHANGES.format(only=""))
def cdc_events_to_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.to_changelog(_events(spark, sf_dir), _COLS, keep_noop=True).select(*_OUT)


@book.add(_CHANGES.format(only=" AND o_orderstatus <> 'F'"))
def cdc_skip_noop_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.to_changelog(_events(spark, sf_dir), _COLS).select(*_OUT)


@book.add("SELECT o_orderkey FROM orders WHERE o_orderkey * 4 >= 20000 AND o_orderkey % 2 = 0")
def cdc_filter_ts_schema_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = changelog.filter_events(_events(spark, sf_dir), 20_000, [changelog.ROW], "SHOP;other", "orders")
    return kept.select(F.coalesce("new.o_orderkey", "old.o_orderkey").alias("o_orderkey"))


@book.add("""
    SELECT user_id, value FROM (SELECT user_id, value, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events
        WHERE event_type <> 'click') WHERE rn = 1 AND event_type <> 'error'""")
def cdc_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("event_type") == "click", "update_preimage").when(F.col("event_type") == "error", "delete").otherwise("update_postimage")
    log = table(spark, sf_dir, "events").select("user_id", "value", F.col("event_id").alias("commit_version"), kind.alias("_change_type"))
    return changelog.materialise(log, ["user_id"]).select("user_id", "value")


@book.add("""
    WITH e AS (SELECT event_id, event_id - event_id % 7 AS v, user_id, user_id % 4 AS stream, event_type = 'error' AS resolved FROM events),
    m AS (SELECT *, max(CASE WHEN resolved THEN v END) OVER (PARTITION BY stream ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM e),
    o AS (SELECT *, max(v) OVER (PARTITION BY stream, user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS own FROM m WHERE NOT resolved)
    SELECT event_id, v AS commit_version FROM o WHERE v > greatest(coalesce(r, -1), coalesce(own, -1))""")
def cdc_resolved_ts_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    kind = F.when(F.col("event_type") == "error", changelog.RESOLVED).otherwise(changelog.ROW).alias("type_code")
    events = table(spark, sf_dir, "events").select("event_id", (e - e % 7).alias("commit_version"), "user_id", (F.col("user_id") % 4).alias("stream"), kind)
    return changelog.drop_replayed(events, ["user_id"], "event_id").select("event_id", "commit_version")


def _messages(codec: str):
    """Encodes rows (k, price, status) as messages of up to 100 events; every tenth is a delete, every seventh an update."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = [], []
            rows = list(zip(*(c.to_pylist() for c in batch.columns)))
            for i in range(0, len(rows), 100):
                events = []
                for k, price, status in rows[i : i + 100]:
                    if codec == "framed":
                        row = {
                            "K": {"t": 8, "h": True, "f": 11, "v": k},
                            "Price": {"t": 5, "f": 0, "v": price},
                            "Status": {"t": 0xFC, "f": 0, "v": base64.b64encode(status.encode()).decode()},
                        }
                        body = {"d": row} if k % 10 == 0 else {"u": row, "p": {"K": row["K"]}} if k % 7 == 0 else {"u": row}
                        events.append(({"scm": "shop", "tbl": "orders", "t": 1, "ts": k * 4}, body))
                    else:
                        row = [("K", 8, 3, change_events.integer_body(k)), ("Price", 0xF6, 0, repr(price).encode()), ("Status", 15, 0, status.encode())]
                        sides = {"old": row} if k % 10 == 0 else {"old": row[:1], "new": row} if k % 7 == 0 else {"new": row}
                        events.append({"schema": "shop", "table": "orders", "type_code": 1, "commit_version": k * 4, **sides})
                key, value = change_events.encode_framed(events) if codec == "framed" else (b"", change_events.encode_compact(events))
                keys.append(key)
                values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.binary())], names=["key", "value"])

    return run


def _order_events(spark, sf_dir, codec: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    return change_events.decode(rows.mapInArrow(_messages(codec), "key binary, value binary"), codec)


def _decoded(spark, sf_dir, codec: str) -> DataFrame:
    events = _order_events(spark, sf_dir, codec)
    side = F.coalesce("new", "old")
    kind = F.when(F.col("new").isNull(), "delete").when(F.col("old").isNull(), "insert").otherwise("update")
    return events.select("commit_version", side["k"].cast("long").alias("k"), side["price"].cast("double").alias("price"), side["status"].alias("status"), kind.alias("kind"))


_DECODED = """
    SELECT o_orderkey * 4 AS commit_version, o_orderkey AS k, o_totalprice AS price, o_orderstatus AS status,
        CASE WHEN o_orderkey % 10 = 0 THEN 'delete' WHEN o_orderkey % 7 = 0 THEN 'update' ELSE 'insert' END AS kind FROM orders"""


@book.add(_DECODED)
def cdc_open_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "framed")


@book.add(_DECODED)
def cdc_binary_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded(spark, sf_dir, "compact")


ORDER = TableDef.of("orders", {"k": "bigint NOT NULL", "price": "decimal(12,2)", "status": "enum('F','O','P')"}, primary_key=("k",))


@book.add("""
    SELECT o_orderkey * 4 AS commit_version, o_orderkey AS k, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price, o_orderstatus AS status,
        CASE WHEN o_orderkey % 10 = 0 THEN 'delete' WHEN o_orderkey % 7 = 0 THEN 'update_postimage' ELSE 'insert' END AS _change_type FROM orders""")
def cdc_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded events as changelog rows of a table's types; preimages left out."""
    rows = changelog.to_changelog(changelog.typed(_order_events(spark, sf_dir, "compact"), ORDER), ORDER.column_names)
    return rows.filter("_change_type <> 'update_preimage'").select("commit_version", "k", F.col("price").cast("string").alias("price"), "status", "_change_type")


@book.add("""
    SELECT o_orderkey AS k, 'shop' AS "schema", 'orders' AS tbl, o_orderkey * 4 AS commit_version, (o_orderkey * 4) >> 18 AS commit_millis, 'row_changed' AS "type", 1 AS type_code,
        '{"scm":"shop","tbl":"orders","t":1,"ts":' || (o_orderkey * 4) || '}' AS "key", 'STREAMING' AS source_event FROM orders""")
def cdc_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {k: k for k in ("schema", "commit_version", "commit_timestamp", "type", "type_code", "key", "source_event")} | {"table": "tbl"}
    events = changelog.event_metadata(_order_events(spark, sf_dir, "compact"), names)
    return events.select(F.coalesce("new", "old")["k"].cast("long").alias("k"), "schema", "tbl", "commit_version", F.unix_millis("commit_timestamp").alias("commit_millis"), "type", "type_code", "key", "source_event")


@book.add("SELECT event_id * 4 AS commit_version, CAST(NULL AS VARCHAR) AS tbl FROM events")
def cdc_resolved_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of resolved events alone, which have no dictionary of names."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            made = [[{"schema": None, "table": None, "type_code": changelog.RESOLVED, "commit_version": i * 4} for i in sorted(ids[k : k + 50])] for k in range(0, len(ids), 50)]
            yield pa.RecordBatch.from_arrays([pa.array([change_events.encode_compact(m) for m in made], pa.binary())], names=["value"])

    messages = table(spark, sf_dir, "events").select("event_id").mapInArrow(encode, "value binary")
    return change_events.decode(messages, "compact").filter(F.col("type_code") == changelog.RESOLVED).select("commit_version", F.col("table").alias("tbl"))


@book.add("""
    SELECT (o_orderkey * 1000) << 18 AS commit_version, o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN 'X' ELSE o_orderstatus END AS old_status,
        CASE WHEN o_orderkey % 3 <> 2 THEN o_orderstatus END AS new_status FROM orders""")
def cdc_canal_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update's old image holds only the status; the rest is filled from the new one."""
    k = F.col("o_orderkey")
    row = F.create_map(F.lit("K"), k.cast("string"), F.lit("Status"), F.col("o_orderstatus"))
    kind = F.element_at(F.array(F.lit("INSERT"), F.lit("UPDATE"), F.lit("DELETE")), (k % 3 + 1).cast("int"))
    old = F.when(k % 3 == 1, F.array(F.create_map(F.lit("Status"), F.lit("X"))))
    message = F.struct(F.lit("Shop").alias("database"), F.lit("Orders").alias("table"), kind.alias("type"), (k * 1000).alias("es"), F.lit(False).alias("isDdl"), F.array(row).alias("data"), old.alias("old"))
    events = change_events.decode_canal(table(spark, sf_dir, "orders").select(F.to_json(message).alias("value")))
    key = F.coalesce(F.col("new")["k"], F.col("old")["k"])
    return events.select("commit_version", key.cast("long").alias("k"), F.col("old")["status"].alias("old_status"), F.col("new")["status"].alias("new_status"))


# --- streams over the events table


def _stream(spark, sf_dir) -> DataFrame:
    return streams.read_stream(spark, f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _bounds(rows: DataFrame, *rest: str) -> DataFrame:
    return rows.select(F.unix_millis("window.start").alias("start_ms"), F.unix_millis("window.end").alias("end_ms"), *rest)


@book.add("""
    SELECT epoch_ms(time_bucket(INTERVAL 1 hour, ts)) AS start_ms, epoch_ms(time_bucket(INTERVAL 1 hour, ts)) + 3600000 AS end_ms, event_type, count(*) AS n
    FROM events GROUP BY ALL""")
def stream_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = streams.windows_to_end(_stream(spark, sf_dir), "ts", "1 hour", lambda e: e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n")))
    return _bounds(counts, "event_type", "n")


@book.add("""
    SELECT epoch_ms(w) AS start_ms, epoch_ms(w) + 7200000 AS end_ms, count(*) AS n
    FROM (SELECT unnest([time_bucket(INTERVAL 1 hour, ts), time_bucket(INTERVAL 1 hour, ts) - INTERVAL 1 hour]) AS w FROM events) GROUP BY ALL""")
def stream_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = streams.windows_to_end(_stream(spark, sf_dir), "ts", "1 hour", lambda e: e.groupBy(F.window("ts", "2 hours", "1 hour")).agg(F.count("*").alias("n")))
    return _bounds(counts, "n")


@book.add("""
    WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 hours THEN 0 ELSE 1 END AS fresh FROM events),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS number FROM g)
    SELECT user_id, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) + 21600000000 AS end_us, count(*) AS n FROM s GROUP BY user_id, number""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = streams.windows_to_end(_stream(spark, sf_dir), "ts", "1 hour", lambda e: e.groupBy(F.session_window("ts", "6 hours").alias("window"), "user_id").agg(F.count("*").alias("n")))
    return out.select("user_id", F.unix_micros("window.start").alias("start_us"), F.unix_micros("window.end").alias("end_us"), "n")


@book.add("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user and event type once, however far apart or late its events come: the state is every pair seen, and none expires."""
    return streams.run_to_end(_stream(spark, sf_dir).select("user_id", "event_type").dropDuplicates())


@book.add("""
    SELECT user_id, event_id, event_type, source_event FROM (
        SELECT user_id, event_id, event_type, CASE WHEN event_id <= 5000 THEN 'SNAPSHOT' ELSE 'STREAMING' END AS source_event,
            row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def stream_snapshot_plus_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot, then the change stream from before it on, applied by key."""
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("insert").alias("_change_type")
    shape = lambda e: e.select("user_id", "event_id", F.col("event_id").alias("commit_version"), "event_type", kind)
    log = streams.run_to_end(shape(streams.read_stream(spark, f"{sf_dir}/events.parquet")))
    everything = shape(table(spark, sf_dir, "events"))
    whole = everything.filter("commit_version <= 5000").groupBy("user_id").agg(F.max_by(F.struct("event_id", "commit_version", "event_type", "_change_type"), "commit_version").alias("r"))
    snapshot = whole.select("user_id", "r.*")
    both = streams.snapshot_then_log(snapshot, log, 5001, overlap=100)
    return versions.as_of(both, ["user_id"]).select("user_id", "event_id", "event_type", "source_event")


@book.add("""
    SELECT user_id, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def stream_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change stream applied to a published table, one version a batch."""
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("insert").alias("_change_type")
    changes = streams.read_stream(spark, f"{sf_dir}/events.parquet").select("user_id", "value", "event_id", kind)
    place = streams.shared_folder(spark)
    held = versions.VersionedTable(spark, f"{place}/table")
    held.commit(spark.createDataFrame([], "user_id long, value double, event_id long"), 1)
    streams.apply_stream(changes, held, [("user_id",)], ["event_id"], f"{place}/progress")
    return held.read()


def payload(rows: list[dict]) -> str:
    """A Canal message of rows, for tests and examples."""
    return json.dumps({"database": "shop", "table": "orders", "type": "INSERT", "es": 1, "isDdl": False, "data": rows, "old": None})
