"""Queries of the table model: partition routing and pruning, snapshots, keyed writes, row ids, type rules."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestone.engine import MINIBATCH, Table, WriteOptions
from mergestone.functions import parser, predicates
from mergestone.operators import dedup, partition, rowid, versions, write
from mergestone.plans.base import Book, table
from mergestone.streaming import streams
from mergestone.tabledef import TableDef

book = Book()
QUERIES, ORACLE_SQL = book.queries, book.sql

BY_ID = partition.HashPartitioning("o_orderkey", 3)
BY_YEAR_HASH = partition.HashPartitioning("o_orderdate", 4, year=True)
BY_PRICE = partition.RangePartitioning("o_totalprice", (50_000.0, 150_000.0, 300_000.0, partition.MAXVALUE))
BY_YEAR = partition.RangePartitioning("o_orderdate", (1996, 1998, 2000, partition.MAXVALUE), year=True)
BY_DATE = partition.RangePartitioning("o_day", (datetime.date(1996, 6, 1), datetime.date(1999, 1, 1), partition.MAXVALUE))
BY_SEGMENT = partition.RangePartitioning("c_mktsegment", ("BUILDING", "HOUSEHOLD", partition.MAXVALUE))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


# --- partitions


@book.add("SELECT o_orderkey, CAST(abs(o_orderkey % 3) AS INTEGER) AS _part FROM orders")
def part_route_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition.routed(_orders(spark, sf_dir).select("o_orderkey"), BY_ID)


@book.add("SELECT o_orderkey, CAST(year(o_orderdate) % 4 AS INTEGER) AS _part FROM orders")
def part_route_hash_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition.routed(_orders(spark, sf_dir), BY_YEAR_HASH).select("o_orderkey", "_part")


@book.add("""
    SELECT o_orderkey, CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice < 150000 THEN 1 WHEN o_totalprice < 300000 THEN 2 ELSE 3 END AS _part FROM orders""")
def part_route_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition.routed(_orders(spark, sf_dir), BY_PRICE).select("o_orderkey", "_part")


@book.add("""
    SELECT o_orderkey, CASE WHEN year(o_orderdate) < 1996 THEN 0 WHEN year(o_orderdate) < 1998 THEN 1 WHEN year(o_orderdate) < 2000 THEN 2 ELSE 3 END AS _part
    FROM orders""")
def part_route_range_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partition.routed(_orders(spark, sf_dir), BY_YEAR).select("o_orderkey", "_part")


@book.add("""
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) < DATE '1996-06-01' THEN 0 WHEN CAST(o_orderdate AS DATE) < DATE '1999-01-01' THEN 1 ELSE 2 END AS _part
    FROM orders""")
def part_route_range_columns_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    dated = _orders(spark, sf_dir).select("o_orderkey", F.to_date("o_orderdate").alias("o_day"))
    return partition.routed(dated, BY_DATE).select("o_orderkey", "_part")


@book.add("""
    SELECT c_custkey, CASE WHEN s IS NULL OR s < 'BUILDING' THEN 0 WHEN s < 'HOUSEHOLD' THEN 1 ELSE 2 END AS _part
    FROM (SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS s FROM customer)""")
def part_route_range_columns_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null goes to the first partition."""
    rows = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("MACHINERY")))
    return partition.routed(rows, BY_SEGMENT).select("c_custkey", "_part")


def _laid_out(spark, rows: DataFrame, partitioning) -> DataFrame:
    """The rows, written by partition and read back."""
    place = f"{streams.shared_folder(spark)}/table"
    partition.routed(rows, partitioning).write.partitionBy(partition.COLUMN).parquet(place)
    return spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in rows.schema)}, {partition.COLUMN} int").parquet(place)


def _where(text: str, types: dict[str, str]):
    return predicates.normalise(parser.parse(text), types)


@book.add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 60000 AND 140000 OR o_totalprice < 10000")
def part_prune_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition's ranges name the folders that are read."""
    rows = _laid_out(spark, _orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), BY_PRICE)
    return partition.matching(rows, BY_PRICE, _where("o_totalprice BETWEEN 60000 AND 140000 OR o_totalprice < 10000", {"o_totalprice": "double"})).drop(partition.COLUMN)


@book.add("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate <= TIMESTAMP '1999-03-01'")
def part_prune_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition on the date becomes one on the partitions of its years."""
    rows = _laid_out(spark, _orders(spark, sf_dir).select("o_orderkey", "o_orderdate"), BY_YEAR)
    return partition.matching(rows, BY_YEAR, _where("o_orderdate >= TIMESTAMP '1998-02-01' AND o_orderdate <= TIMESTAMP '1999-03-01'", {"o_orderdate": "datetime"})).select("o_orderkey")


@book.add("SELECT o_orderkey FROM orders WHERE o_orderkey = 4242")
def part_prune_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _laid_out(spark, _orders(spark, sf_dir).select("o_orderkey"), BY_ID)
    return partition.matching(rows, BY_ID, _where("4242 = o_orderkey", {"o_orderkey": "bigint"})).select("o_orderkey")


@book.add("SELECT o_orderkey FROM orders WHERE o_totalprice >= 50000 AND o_totalprice < 300000")
def part_select_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of named partitions."""
    rows = _laid_out(spark, _orders(spark, sf_dir).select("o_orderkey", "o_totalprice"), BY_PRICE)
    return partition.only(rows, (1, 2)).select("o_orderkey")


# --- snapshots: events as the version log of a table of users


def _log(spark, sf_dir) -> DataFrame:
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("insert")
    return table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("commit_version"), "event_type", "value", kind.alias("_change_type"))


_AS_OF = """
    SELECT user_id, commit_version, event_type, value FROM (
        SELECT user_id, event_id AS commit_version, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events {where})
    WHERE rn = 1 AND event_type <> 'error'"""


@book.add(_AS_OF.format(where="WHERE event_id <= 5000"))
def snapshot_as_of_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.as_of(_log(spark, sf_dir), ["user_id"], version=5000).drop("_change_type")


@book.add(_AS_OF.format(where=""))
def snapshot_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.as_of(_log(spark, sf_dir), ["user_id"]).drop("_change_type")


def _timed_log(spark, sf_dir) -> DataFrame:
    version = F.shiftleft(F.unix_millis(F.col("ts").cast("timestamp")), 18) + F.col("event_id") % 262144
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("insert")
    return table(spark, sf_dir, "events").select("user_id", version.alias("commit_version"), "event_id", "event_type", kind.alias("_change_type"))


@book.add("""
    SELECT user_id, event_id, event_type FROM (
        SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn FROM events
        WHERE ((epoch_us(ts) // 1000) << 18) + event_id % 262144 <= (1705276800000 << 18))
    WHERE rn = 1 AND event_type <> 'error'""")
def snapshot_as_of_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = versions.as_of(_timed_log(spark, sf_dir), ["user_id"], timestamp="2024-01-15T00:00:00+00:00")
    return out.select("user_id", "event_id", "event_type")


@book.add("""
    SELECT user_id, event_id, ((epoch_us(ts) // 1000) << 18) + event_id % 262144 AS commit_version, epoch_us(ts) // 1000 AS commit_millis, 'SNAPSHOT' AS source_event
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def snapshot_metadata_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = versions.with_metadata(versions.as_of(_timed_log(spark, sf_dir), ["user_id"]))
    return out.select("user_id", "event_id", "commit_version", F.unix_millis("commit_timestamp").alias("commit_millis"), "source_event")


# --- deduplication: line items by order and line number, which repeat

_LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _ordered(direction: str = "") -> str:
    return ", ".join(f"{c} {direction}" for c in _LINE_ORDER)


@book.add(f"""
    SELECT {', '.join(_LINE)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ordered('DESC')}) AS rn FROM lineitem) WHERE rn = 1""")
def dedup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.last_wins(table(spark, sf_dir, "lineitem"), [("l_orderkey", "l_linenumber")], _LINE_ORDER).select(*_LINE)


@book.add("""
    SELECT event_id, user_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS a,
        row_number() OVER (PARTITION BY value ORDER BY event_id DESC) AS b FROM events) WHERE a = 1 AND b = 1""")
def dedup_last_wins_multi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row goes if any later one shares one of its keys."""
    return dedup.last_wins(table(spark, sf_dir, "events"), [("user_id", "event_type"), ("value",)], ["event_id"]).select("event_id", "user_id", "value")


@book.add("""
    WITH a AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS x FROM events),
    b AS (SELECT *, row_number() OVER (PARTITION BY value ORDER BY event_id) AS y FROM a WHERE x = 1)
    SELECT event_id, user_id, value FROM b WHERE y = 1""")
def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.first_wins(table(spark, sf_dir, "events"), [("user_id", "event_type"), ("value",)], ["event_id"]).select("event_id", "user_id", "value")


@book.add("""
    WITH e AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS k FROM events)
    SELECT event_id, k FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY event_id DESC) AS rn FROM e) WHERE rn = 1 OR k IS NULL""")
def dedup_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("user_id")).alias("k"))
    return dedup.last_wins(rows, [("k",)], ["event_id"])


@book.add("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(table(spark, sf_dir, "lineitem"), ("l_orderkey", "l_linenumber"))


# --- writes: all orders are the target and all are the source, each with some keys moved away, so that half of the rest collide


def _target(spark, sf_dir):
    k = F.col("o_orderkey")
    return _orders(spark, sf_dir).select(F.when(k % 3 != 0, k).otherwise(k + 1_000_000_000).alias("o_orderkey"), "o_custkey", "o_orderstatus", "o_totalprice")


def _source(spark, sf_dir, moved: int = 0):
    k = F.col("o_orderkey")
    changed = F.round(F.col("o_totalprice") + 1, 2).alias("o_totalprice")
    return _orders(spark, sf_dir).select((F.when(k % 2 == 0, k).otherwise(k + 2_000_000_000) + moved).alias("o_orderkey"), "o_custkey", F.lit("N").alias("o_orderstatus"), changed)


_T = "(SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey ELSE o_orderkey + 1000000000 END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders)"
_S = "(SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE o_orderkey + 2000000000 END AS o_orderkey, o_custkey, 'N' AS o_orderstatus, round(o_totalprice + 1, 2) AS o_totalprice FROM orders)"
KEY = [("o_orderkey",)]


@book.add(f"SELECT s.* FROM {_S} s WHERE o_orderkey IN (SELECT o_orderkey FROM {_T})")
def append_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write.conflicts(_target(spark, sf_dir), _source(spark, sf_dir), KEY)


@book.add(f"SELECT * FROM {_T} UNION ALL SELECT o_orderkey + 5000000000, o_custkey, o_orderstatus, o_totalprice FROM {_S}")
def append_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write.append(_target(spark, sf_dir), _source(spark, sf_dir, 5_000_000_000), KEY)


@book.add(f"SELECT * FROM {_T} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_S}) UNION ALL SELECT * FROM {_S}")
def upsert_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write.replace_upsert(_target(spark, sf_dir), _source(spark, sf_dir), KEY)


ORDERS = TableDef.of("orders", {"o_orderkey": "bigint NOT NULL", "o_custkey": "bigint", "o_orderstatus": "varchar(1)", "o_totalprice": "double"}, primary_key=("o_orderkey",))


@book.add(f"SELECT * FROM {_T} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_S}) UNION ALL SELECT * FROM {_S} WHERE o_orderkey % 10 <> 0")
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that is appended to, upserted and deleted from; each write adds a layer."""
    held = Table(spark, f"{streams.shared_folder(spark)}/orders", ORDERS).create()
    held.write(_target(spark, sf_dir))
    held.write(_source(spark, sf_dir), WriteOptions(mode="upsert"))
    gone = _source(spark, sf_dir).withColumn("_change_type", F.when(F.col("o_orderkey") % 10 == 0, "delete").otherwise("update_preimage"))
    held.write(gone, WriteOptions(mode="upsert", transaction=MINIBATCH, deletes=True))
    return held.read()


@book.add("""
    WITH t AS (SELECT o_orderkey AS a, o_orderkey * 10 AS b, o_orderstatus AS v FROM orders),
    s AS (SELECT CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey ELSE o_orderkey + 1000000000 END AS a, CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey * 10 ELSE -o_orderkey END AS b, 'N' AS v FROM orders)
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.a = t.a) AND NOT EXISTS (SELECT 1 FROM s WHERE s.b = t.b) UNION ALL SELECT * FROM s""")
def upsert_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert, or on a duplicate key update: each row overwrites the one that it meets on the first key that meets any."""
    k = F.col("o_orderkey")
    target = _orders(spark, sf_dir).select(k.alias("a"), (k * 10).alias("b"), F.col("o_orderstatus").alias("v"))
    source = _orders(spark, sf_dir).select(F.when(k % 3 == 1, k).otherwise(k + 1_000_000_000).alias("a"), F.when(k % 3 == 2, k * 10).otherwise(-k).alias("b"), F.lit("N").alias("v"))
    return write.update_upsert(target, source, [("a",), ("b",)])


@book.add(f"""
    WITH s AS (SELECT o_orderkey + 100000000 * (o_orderkey % 4) AS o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS cents, o_orderstatus FROM {_S}),
    t AS (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS cents, o_orderstatus FROM {_T})
    SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s) AND cents NOT IN (SELECT cents FROM s) UNION ALL SELECT * FROM s""")
def upsert_multi_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that collide on either of two keys are replaced."""
    shape = lambda f, key: f.select(key.alias("o_orderkey"), F.floor("o_totalprice").alias("cents"), "o_orderstatus")
    k = F.col("o_orderkey")
    target, source = shape(_target(spark, sf_dir), k), shape(_source(spark, sf_dir), k + 100_000_000 * (k % 4))
    return write.replace_upsert(target, source, [("o_orderkey",), ("cents",)])


@book.add(f"""
    SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
        CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
    FROM {_T} t FULL JOIN {_S} s ON s.o_orderkey = t.o_orderkey""")
def upsert_partial_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write.partial_upsert(_target(spark, sf_dir), _source(spark, sf_dir), ("o_orderkey",), ["o_orderkey", "o_totalprice"])


@book.add(f"SELECT * FROM {_T} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_S})")
def delete_by_pk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return write.delete(_target(spark, sf_dir), _source(spark, sf_dir), KEY)


@book.add(f"""
    WITH gone AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey END AS k, CASE WHEN o_orderkey % 200 <= 2 THEN o_custkey END AS c FROM orders)
    SELECT * FROM {_T} WHERE o_orderkey NOT IN (SELECT k FROM gone WHERE k IS NOT NULL)
        AND (o_custkey IS NULL OR o_custkey NOT IN (SELECT c FROM gone WHERE k IS NULL AND c IS NOT NULL))""")
def delete_by_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose first key is null are named by the second; with both null they name none."""
    k = F.col("o_orderkey")
    gone = _orders(spark, sf_dir).select(F.when(k % 4 == 0, k).alias("o_orderkey"), F.when(k % 200 <= 2, F.col("o_custkey")).alias("o_custkey"))
    return write.delete(_target(spark, sf_dir), gone, [("o_orderkey",), ("o_custkey",)])


@book.add(f"""
    SELECT * FROM {_T} WHERE o_orderkey NOT IN (SELECT o_orderkey FROM {_S}) UNION ALL SELECT * FROM {_S} WHERE o_orderkey % 10 <> 0""")
def write_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A changelog with upserts and deletes on the target."""
    kind = F.when(F.col("o_orderkey") % 10 == 0, "delete").otherwise("update_postimage").alias("_change_type")
    source = _source(spark, sf_dir)
    changes = source.select("*", kind, F.lit(1).alias("seq")).unionByName(source.select("*", F.lit("update_preimage").alias("_change_type"), F.lit(0).alias("seq")))
    return write.apply_changes(_target(spark, sf_dir), changes, KEY, ["seq"])


# --- row ids


@book.add("SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) + 30000 AS id FROM customer")
def rowid_auto_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rowid.with_auto_id(table(spark, sf_dir, "customer").select("c_custkey"), "id", "c_custkey", base=30_000)


@book.add("SELECT c_custkey, (CAST(c_custkey * 7 % 32 AS BIGINT) << 58) | row_number() OVER (ORDER BY c_custkey) AS id FROM customer")
def rowid_auto_random_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five shard bits under the sign bit, from a seed."""
    made = rowid.numbered(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "n")
    rowid.check_shards(5, False, 1 << 40)
    return made.select("c_custkey", rowid.sharded(F.col("n"), F.col("c_custkey") * 7 % 32, 5).alias("id"))


@book.add("SELECT c_custkey, ((row_number() OVER (ORDER BY c_custkey) & 15) << 59) | row_number() OVER (ORDER BY c_custkey) AS id FROM customer")
def rowid_implicit_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed is the running number itself."""
    made = rowid.numbered(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", "n")
    return made.select("c_custkey", rowid.sharded(F.col("n"), F.col("n"), 4).alias("id"))


# --- types

PART = TableDef.of(
    "part", {"P_PARTKEY": "bigint(20) unsigned NOT NULL", "P_NAME": "varchar(64)", "P_SIZE": "tinyint unsigned", "P_RETAILPRICE": "decimal(10,1)"}, primary_key=("P_PARTKEY",)
)


@book.add("""
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_size, CAST(round(CAST(p_retailprice AS DECIMAL(38, 18)), 1) AS VARCHAR) AS price FROM part""")
def typed_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows brought to a table's types: unsigned integers widen, decimals round half up."""
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    out = PART.conform(rows)
    return out.select(F.col("p_partkey").cast("string").alias("p_partkey"), "p_name", F.col("p_size").cast("int").alias("p_size"), F.col("p_retailprice").cast("string").alias("price"))


@book.add("SELECT p_partkey, (p_partkey + 1)::VARCHAR || repeat('0', 30) AS whole, (p_partkey + 1)::VARCHAR || repeat('0', 30) || '.00' AS cents FROM part")
def typed_wide_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals of more than 30 digits before the point; whatever the key, of up to 49, which is more than Spark's have."""
    wide = TableDef.of("wide", {"p_partkey": "bigint", "whole": "decimal(65,0)", "cents": "decimal(65,2)"})
    text = F.concat((F.col("p_partkey") + 1).cast("string"), F.repeat(F.lit("0"), F.lit(30)))
    out = wide.conform(table(spark, sf_dir, "part").select("p_partkey", text.alias("whole"), text.alias("cents")))
    return out.select("p_partkey", "whole", "cents")
