"""Layered tables, options, the catalog's versioned tables, pruning by conditions."""

import datetime
import decimal
import os
import threading

import pytest
from compare import same
from pyspark.sql import functions as F

from mergestone import options
from mergestone.catalog import Catalog
from mergestone.engine import MINIBATCH, Table, WriteOptions
from mergestone.functions import parser
from mergestone.functions import predicates as P
from mergestone.operators import changelog, partition, versions
from mergestone.operators.partition import MAXVALUE, HashPartitioning, RangePartitioning
from mergestone.plans import registry
from mergestone.tabledef import TableDef

KIND = "id long, name string, age int"
USERS = TableDef.of("users", {"id": "bigint NOT NULL", "name": "varchar(255)", "age": "int"}, primary_key=("id",), unique=[("age",)])


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def size(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet"))


def test_an_append_writes_the_appended_rows_only(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/t", TableDef.of("t", {"id": "bigint NOT NULL", "v": "varchar(99)"}, primary_key=("id",))).create()
    big = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
    table.write(big)
    before = size(tmp_path)
    table.write(spark.createDataFrame([(10**6, "x")], "id long, v string"))
    assert size(tmp_path) - before < before / 50
    table.write(spark.createDataFrame([(5, "five")], "id long, v string"), WriteOptions(mode="upsert"))
    assert size(tmp_path) - before < before / 50
    assert table.read().count() == 200_001 and table.read(where="id = 5").first()["v"] == "five"


def test_layers_and_their_gone_keys(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/t", USERS).create()
    upsert = WriteOptions(mode="upsert")
    first = table.write(spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None), (4, "d", None)], KIND))
    table.write(spark.createDataFrame([(1, "A", 2)], KIND), upsert)  # takes rows 1 and 2 away
    assert rows(table.read()) == [(1, "A", 2), (3, "c", None), (4, "d", None)]
    table.write(spark.createDataFrame([(2, "B", 2), (5, "e", None)], KIND), upsert)  # takes row 1 by its age
    assert rows(table.read()) == [(2, "B", 2), (3, "c", None), (4, "d", None), (5, "e", None)]
    gone = spark.createDataFrame([(3, "c", None, "delete"), (77, "x", None, "delete")], KIND + ", _change_type string")
    last = table.write(gone, WriteOptions(mode="upsert", transaction=MINIBATCH, deletes=True))
    want = [(2, "B", 2), (4, "d", None), (5, "e", None)]
    assert rows(table.read()) == want and table.read(version=first).count() == 4
    table.store.compact(last + 1)
    assert rows(table.read()) == want and len(table.store.manifest()["layers"]) == 1
    table.expire(1)
    assert table.store.versions() == [last + 1] and rows(table.read()) == want
    assert len([f for f in os.listdir(f"{tmp_path}/t") if f.startswith(("data-", "gone-"))]) == 1
    with pytest.raises(ValueError):
        table.read(version=first)


def test_many_writes_are_compacted(spark, tmp_path, monkeypatch):
    from mergestone import engine

    monkeypatch.setattr(engine, "MOST_SCANS", 3)
    table = Table(spark, f"file://{tmp_path}/t", USERS).create()
    for i in range(5):
        table.write(spark.createDataFrame([(1, f"v{i}", 1), (10 + i, "x", None)], KIND), WriteOptions(mode="upsert"))
    assert len(table.read().collect()) == 6 and table.store.scans() <= 3


def test_insert_or_update(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/t", USERS).create()
    table.write(spark.createDataFrame([(1, "a", 1), (2, "b", 2)], KIND))
    table.write(spark.createDataFrame([(1, "c", 5), (9, "d", 2)], KIND), WriteOptions(mode="update"))
    assert rows(table.read()) == [(1, "c", 5), (9, "d", 2)]


def test_only_one_writer_follows_a_version(spark, tmp_path):
    store = versions.VersionedTable(spark, f"file://{tmp_path}/t")
    store.commit(spark.range(1).toDF("a"), 1)
    done = []

    def write(n):
        try:
            store.add(spark.range(n).toDF("a"), 10 + n, expected=1)
            done.append(n)
        except versions.Conflict:
            pass

    threads = [threading.Thread(target=write, args=(n,)) for n in range(1, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(done) == 1 and store.versions() == [1, 10 + done[0]] and store.read().count() == 1 + done[0]
    assert len([f for f in os.listdir(f"{tmp_path}/t") if f.startswith("data-")]) == 2


def test_generated_ids_with_shards(spark, tmp_path):
    made = TableDef.of("t", {"id": "bigint NOT NULL AUTO_RANDOM(5)", "v": "int"}, primary_key=("id",))
    assert made.columns[0].auto_random == 5 and made.columns[0].type.name == "bigint"
    table = Table(spark, f"file://{tmp_path}/t", made).create()
    new = spark.range(100).select(F.lit(None).cast("long").alias("id"), F.col("id").cast("int").alias("v"))
    for _ in range(2):
        table.write(new)
    ids = [r["id"] for r in table.read().collect()]
    assert len(set(ids)) == 200 and min(ids) >= 0 and len({i & (1 << 58) - 1 for i in ids}) == 200
    with pytest.raises(Exception, match="generated"):
        table.write(new.withColumn("id", F.lit(7).cast("long")))


DAYS = RangePartitioning("day", (2000, 2010, MAXVALUE), year=True)


@pytest.mark.parametrize(
    ("text", "wanted"),
    [
        ("day < DATE '1999-05-01'", {0}), ("day >= DATE '2010-01-01'", {2}), ("day = DATE '2005-01-01' AND other = 3", {1}), ("day = DATE '2005-01-01' OR day > DATE '2015-01-01'", {1, 2}),
        ("day = DATE '2005-01-01' OR other = 3", {0, 1, 2}), ("NOT day = DATE '2005-01-01'", {0, 1, 2}), ("day IS NULL", {0}), ("day IN (DATE '1990-01-01', DATE '2020-01-01')", {0, 2}),
        ("day BETWEEN DATE '2001-01-01' AND DATE '2009-01-01' AND day < DATE '1990-01-01'", set()), ("false", set()), ("DATE '2010-01-01' <= day", {2}), ("day = 'soon'", {0, 1, 2}),
    ],
)
def test_partitions_of_a_condition(text, wanted):
    assert partition.partitions_of(P.normalise(parser.parse(text)), DAYS) == wanted


def test_a_condition_prunes_a_table(spark, tmp_path):
    made = TableDef.of("days", {"id": "bigint NOT NULL", "day": "date"}, primary_key=("id",), partitioning=DAYS)
    table = Table(spark, f"file://{tmp_path}/days", made).create()
    table.write(spark.createDataFrame([(y, datetime.date(y, 3, 1)) for y in (1990, 2003, 2020)] + [(1, None)], "id long, day date"))
    table.write(spark.createDataFrame([(2004, datetime.date(2004, 3, 1))], "id long, day date"))
    found = table.read(where="day >= DATE '2001-01-01' AND day < DATE '2009-01-01'")
    assert rows(found.select("id")) == [(2003,), (2004,)]
    assert "PartitionFilters: [isnotnull(_part" in found._jdf.queryExecution().toString()
    assert rows(table.read(partitions=[0]).select("id")) == [(1,), (1990,)]
    assert table.read(where=P.of_domain("day")).count() == 0 and table.read(where="true").count() == 5
    assert table.read(where="day IS NULL").count() == 1


def test_casts_that_change_values_stay(spark, tmp_path):
    table = Table(spark, f"file://{tmp_path}/t", TableDef.of("t", {"id": "int NOT NULL", "price": "double"}, primary_key=("id",))).create()
    table.write(spark.createDataFrame([(1, 1000.5), (2, 1000.0), (3, 5.0)], "id int, price double"))
    assert rows(table.read(where="CAST(price AS int) = 1000").select("id")) == [(1,), (2,)]
    assert rows(table.read(where="CAST(id AS bigint) = 3").select("id")) == [(3,)]
    assert P.normalise(P.Op.of("=", P.Cast(P.Ref("c"), "int"), P.Lit(1)), {"c": "bigint"}) != P.Op.of("=", P.Ref("c"), P.Lit(1))


def test_predicates_as_text_and_back():
    tree = parser.parse("a = 1 AND NOT (b LIKE 'x%' XOR c IS NOT NULL) OR d IN (1.5, -2) OR e >= x'4142' OR f < TIMESTAMP '2020-01-01 00:00:00' OR true")
    assert P.load(P.dump(tree)) == tree
    assert parser.parse("a = 1 OR b = 2 AND c = 3") == P.Op.of("or", parser.parse("a = 1"), P.Op.of("and", parser.parse("b = 2"), parser.parse("c = 3")))
    for wrong in ("a =", "a", "= 1", "a = 1 b", "a IN ()", "(a = 1", "a ~ 1", "and = 1"):
        with pytest.raises(ValueError):
            parser.parse(wrong)
    assert parser.partition_function("YEAR(`Day`)") == ("Day", "year") and parser.partition_function("id") == ("id", None)
    with pytest.raises(ValueError):
        parser.partition_function("to_days(id)")


def test_literals_as_the_store_holds_them():
    kinds = {"t": "timestamp", "n": "int"}
    at = datetime.datetime(2020, 1, 1, 8)
    moved = P.stored(P.Op.of("<", P.Ref("t"), P.Lit(at)), kinds, "Asia/Shanghai")
    assert moved.args[1].value == datetime.datetime(2020, 1, 1)
    assert P.supported(P.Op.of("=", P.Ref("n"), P.Lit(1 << 40)), kinds) is None and P.supported(P.Op.of("=", P.Ref("n"), P.Lit(7)), kinds) is not None


def test_options():
    made = options.parse({"write_mode": "UPSERT", "Snapshot_Version": "5", "delete-enable": "true", "url": "x", "tls.ca": "y", "metadata.included": "commit_version=v,source_event"}, {"update-columns": "A,b"})
    assert (made.version, made.write.mode, made.write.deletes, made.write.transaction, made.write.update_columns) == (5, "upsert", True, MINIBATCH, ("a", "b"))
    assert made.metadata == {"commit_version": "v", "source_event": "source_event"} and made.codec == "compact" and made.rest == {"url": "x", "tls.ca": "y"}
    for wrong in ({"update-columns": "a"}, {"write_mode": "merge"}, {"deduplicate": "yes"}, {"no_such": "1"}, {"streaming.codec": "avro"}, {"type.include": "rows"}):
        with pytest.raises(ValueError):
            options.parse(wrong)


def test_catalog_opens_versioned_tables(spark, tmp_path):
    catalog = Catalog(spark, properties={"write_mode": "upsert"})
    catalog.create_database("shop_v", ignore_if_exists=True)
    by = TableDef.of("orders", {"id": "bigint NOT NULL", "day": "date"}, primary_key=("id",), partitioning=RangePartitioning("day", (datetime.date(2000, 1, 1), MAXVALUE)))
    catalog.create_versioned("shop_v", USERS, f"file://{tmp_path}/users")
    catalog.create_versioned("shop_v", by, f"file://{tmp_path}/orders")
    assert catalog.definition("shop_v", "orders") == by and catalog.open("shop_v", "orders").definition.partitioning == by.partitioning
    first = catalog.write("shop_v", "users", spark.createDataFrame([(1, "a", 1)], KIND))
    catalog.write("shop_v", "users", spark.createDataFrame([(1, "b", 1), (2, "c", 2)], KIND))
    catalog.write("shop_v", "orders", spark.createDataFrame([(1, datetime.date(1999, 1, 1)), (2, datetime.date(2001, 1, 1))], "id long, day date"))
    with pytest.raises(ValueError, match="upsert"):
        catalog.write("shop_v", "users", spark.createDataFrame([(1, "z", 9)], KIND), {"write_mode": "append"})
    joined = catalog.sql(f"SELECT u.name AS now, w.name AS then, day FROM shop_v.users u LEFT JOIN shop_v.users /*+ OPTIONS('snapshot_version'='{first}') */ w ON u.id = w.id JOIN shop_v.orders o ON o.id = u.id")
    assert rows(joined) == [("b", "a", datetime.date(1999, 1, 1)), ("c", None, datetime.date(2001, 1, 1))]
    seen = catalog.read("shop_v", "users", {"metadata.included": "*", "limit": "1"})
    assert "source_event" in seen.columns and seen.count() == 1
    with pytest.raises(ValueError):
        catalog.drop_column("shop_v", "users", "name")
    spark.sql("CREATE TABLE shop_v.plain (a INT) USING parquet")
    with pytest.raises(ValueError, match="versions"):
        catalog.read("shop_v", "plain", {"snapshot_version": "5"})
    catalog.drop_database("shop_v", cascade=True)


def test_rewritten_tables_keep_their_partitioning(spark):
    catalog = Catalog(spark)
    catalog.create_database("shop_p", ignore_if_exists=True)
    table = TableDef.of("t", {"id": "bigint NOT NULL", "a": "int", "b": "binary(4)"}, primary_key=("id",), partitioning=HashPartitioning("id", 3))
    catalog.create_table("shop_p", table)
    catalog.rename_column("shop_p", "t", "id", "key")
    assert catalog.definition("shop_p", "t").partitioning == HashPartitioning("key", 3)
    catalog.drop_column("shop_p", "t", "a")
    assert catalog.definition("shop_p", "t").column_names == ["key", "b"] and catalog.list_tables("shop_p") == ["t"]
    with pytest.raises(ValueError):
        catalog.drop_column("shop_p", "t", "key")
    catalog.drop_database("shop_p", cascade=True)


def test_wide_decimals(spark):
    table = TableDef.of("t", {"a": "decimal(38,0)", "b": "decimal(38,2)", "c": "decimal(6,3)"})
    big = "123456789012345678901234567890"
    frame = spark.createDataFrame([(big, big + ".005", 1.0005)], "a string, b string, c double").withColumn("a", F.col("a").cast("decimal(38,0)"))
    out = table.conform(frame).first()
    assert (str(out["a"]), str(out["b"]), str(out["c"])) == (big, big + ".01", "1.001")
    with pytest.raises(Exception):
        table.conform(frame.withColumn("c", F.lit(1e9))).collect()


def test_wide_decimals_of_any_key(spark, tmp_path):
    keys = [0, 19_999, 999_998, 999_999, 1_199_999, 99_999_998, 99_999_999, 60 * 10**9, 2**63 - 2, -2, -(2**63), None]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").coalesce(1).write.parquet(f"{tmp_path}/made")
    part = next(f for f in os.listdir(f"{tmp_path}/made") if f.endswith(".parquet"))
    os.rename(f"{tmp_path}/made/{part}", f"{tmp_path}/part.parquet")
    same(spark, registry.QUERIES["typed_wide_decimal"], registry.ORACLE_SQL["typed_wide_decimal"], str(tmp_path))


def test_decimals_wider_than_sparks(spark):
    table = TableDef.of("t", {"a": "decimal(65,0)", "b": "decimal(65,30)", "c": "decimal(40,2)"})
    nines, most = "9" * 35, "9" * 38
    texts = ["0", "-0", "-0.4", "0.5", "-0.5", "1.5", "2.5", "-2.5", "0.005", "0.0049999", ".5", "5.", "+7", " 12 ", "007.10", nines + ".994", nines + ".995", "-" + nines + ".5",
             "1e20", "1.25E+3", "125e-2", "5e-3", "5e-31", "4.9e-31", "1e-999999999", "0e999999999", "0." + "9" * 31, "123456789012345678901234567890.125", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", *[F.col("t").alias(c) for c in "abc"])
    got = [(r["a"], r["b"], r["c"]) for r in sorted(table.conform(frame, ("i",)).collect(), key=lambda r: r["i"])]
    exact = decimal.Context(prec=200, rounding=decimal.ROUND_HALF_UP, Emin=-(10**9), Emax=10**9)

    def plain(text, scale):
        value = exact.quantize(decimal.Decimal("0" if text.startswith("0e") else text.strip()), decimal.Decimal(1).scaleb(-scale))
        return f"{abs(value) if value.is_zero() else value:f}"

    assert got == [(None,) * 3 if t is None else tuple(plain(t, s) for s in (0, 30, 2)) for t in texts]
    fits = table.conform(spark.createDataFrame([(most, nines, nines)], "a string, b string, c string")).first()
    assert tuple(fits) == (most, nines + "." + "0" * 30, nines + ".00")
    typed = spark.sql("SELECT CAST(-7 AS TINYINT) AS a, CAST('0.0000005' AS DECIMAL(38, 18)) AS b, 1.5e20D AS c UNION ALL SELECT 1, 2.5, 0.125D")
    assert rows(table.conform(typed)) == [("-7", "0.0000005" + "0" * 23, "1" + "5" + "0" * 19 + ".00"), ("1", "2.5" + "0" * 29, "0.13")]
    assert table.conform(spark.sql("SELECT true AS a, 1L AS b, false AS c")).first()["a"] == "1"
    for column, wrong in (("a", "9" * 65 + ".5"), ("b", "1" + "0" * 35), ("c", "9" * 38 + ".995"), ("c", "1e38"), ("c", "1e999999999"), ("a", "x"), ("a", ""), ("a", "."), ("a", "1.2.3"), ("a", "1,2,3,4"), ("a", "NaN")):
        with pytest.raises(Exception, match=f"(out of range|not a number) for column {column}"):
            table.conform(frame.limit(1).withColumn(column, F.lit(wrong))).collect()
    for kind in ("decimal(66,0)", "decimal(60,31)"):
        with pytest.raises(ValueError, match="65"):
            TableDef.of("t", {"a": kind}).schema


def test_tables_with_decimals_wider_than_sparks(spark, tmp_path):
    made = TableDef.of("t", {"k": "decimal(50,2) NOT NULL", "v": "int"}, primary_key=("k",))
    table = Table(spark, f"file://{tmp_path}/t", made).create()
    table.write(spark.createDataFrame([("1" + "0" * 40, 1), ("2", 2)], "k string, v int"))
    table.write(spark.createDataFrame([("1" + "0" * 40 + ".001", 3), ("02.0", 4), ("-0", 5)], "k string, v int"), WriteOptions(mode="upsert"))
    assert rows(table.read()) == [("0.00", 5), ("1" + "0" * 40 + ".00", 3), ("2.00", 4)]
    assert table.read(where="k IS NOT NULL AND v > 3").count() == 2
    for wrong in ("k > 1", "v = 1 OR k = 2", "k IN (1, 2)"):
        with pytest.raises(ValueError, match="38 digits"):
            table.read(where=wrong)
    with pytest.raises(ValueError, match="38 digits"):
        table.write(spark.createDataFrame([("3", 1)], "k string, v int"), WriteOptions(mode="upsert", deduplicate=True, sequence=("k",)))
    with pytest.raises(ValueError, match="38 digits"):
        TableDef.of("t", {"k": "decimal(50,2)"}, partitioning=RangePartitioning("k", (1, MAXVALUE)))
    events = spark.sql("SELECT struct('7.005' AS k, '1' AS v) AS new, CAST(NULL AS struct<k: string, v: string>) AS old")
    assert changelog.typed(events, made).first()["new"]["k"] == "7.01"
