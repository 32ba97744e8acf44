"""Relational queries: scans, predicates, scalars, aggregates, joins, windows, set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mergestone.functions import predicates as P
from mergestone.functions import parser, scalar, statistics
from mergestone.operators import lookup, ordered
from mergestone.plans.base import Book, table

book = Book()
QUERIES, ORACLE_SQL = book.queries, book.sql
ref, lit, op = P.Ref, P.Lit, P.Op.of

#: Types of the columns that predicates are split over.
PART_TYPES = {"p_partkey": "bigint", "p_name": "varchar", "p_brand": "varchar", "p_type": "varchar", "p_size": "int", "p_retailprice": "double"}


def ts(text: str):
    return F.lit(text).cast("timestamp_ntz")


# --- scans and predicates


@book.add("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity < 24
    ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 100""")
def scan_filter_project_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    rows = table(spark, sf_dir, "lineitem").filter((F.col("l_shipdate") >= ts("1997-01-01")) & (F.col("l_quantity") < 24))
    return rows.select(*cols).orderBy(*cols).limit(100)


@book.add("SELECT * FROM customer")
def scan_full_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


@book.add("SELECT c_custkey, c_mktsegment FROM customer")
def scan_pruned_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")


@book.add("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity >= 49)")
def index_lookup_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Handles found by one condition, then the rows that have them."""
    handles = table(spark, sf_dir, "lineitem").filter("l_quantity >= 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(handles, "o_orderkey", "left_semi").select("o_orderkey", "o_totalprice")


def _part(spark, sf_dir, tree) -> DataFrame:
    """Rows of part by a predicate tree: the store's part of it first, then all of it."""
    tree = P.normalise(tree, PART_TYPES)
    first = P.supported(tree, PART_TYPES)
    rows = table(spark, sf_dir, "part")
    return (rows if first is None else rows.filter(P.column(first))).filter(P.column(tree)).select("p_partkey", "p_name", "p_size")


def _predicate(name: str, tree, where: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _part(spark, sf_dir, tree)

    run.__name__ = name
    book.add(f"SELECT p_partkey, p_name, p_size FROM part WHERE {where}")(run)


_predicate("pred_eq", op("=", ref("p_size"), lit(15)), "p_size = 15")
_predicate("pred_ne", op("<>", ref("p_size"), lit(15)), "p_size <> 15")
_predicate(
    "pred_lt_le_gt_ge",
    op("or", op("and", op("<", ref("p_size"), lit(10)), op(">=", ref("p_retailprice"), lit(1000.0))), op("and", op(">", ref("p_size"), lit(40)), op("<=", ref("p_retailprice"), lit(1500.0)))),
    "p_size < 10 AND p_retailprice >= 1000.0 OR p_size > 40 AND p_retailprice <= 1500.0",
)
_predicate("pred_and_or_not", op("and", op("not", op("=", ref("p_size"), lit(3))), op("or", op("<", ref("p_size"), lit(5)), op(">", ref("p_size"), lit(45)))), "NOT p_size = 3 AND (p_size < 5 OR p_size > 45)")
_predicate("pred_xor", op("xor", op("<", ref("p_size"), lit(25)), op(">", ref("p_retailprice"), lit(1200.0))), "(p_size < 25) <> (p_retailprice > 1200.0)")
_predicate("pred_in", op("in", ref("p_size"), lit(1), lit(7), lit(49)), "p_size IN (1, 7, 49)")
_predicate("pred_like", op("like", ref("p_name"), lit("r%w_dget")), "p_name LIKE 'r%w_dget'")
_predicate("pred_is_null", op("or", op("is null", ref("p_name")), op("and", op("is not null", ref("p_brand")), op("=", ref("p_size"), lit(2)))), "p_name IS NULL OR p_brand IS NOT NULL AND p_size = 2")
_predicate("pred_const_flip", op("and", op(">", lit(9), ref("p_size")), op("<=", lit(4), ref("p_size"))), "9 > p_size AND 4 <= p_size")
_predicate("pred_cast_strip", op("=", P.Cast(ref("p_size"), "bigint"), lit(30)), "CAST(p_size AS BIGINT) = 30")
_predicate("pred_partial_pushdown", op("and", op("<", ref("p_size"), lit(20)), op("<", ref("p_size"), ref("p_partkey"))), "p_size < 20 AND p_size < p_partkey")
_predicate("pred_or_unsupported", op("or", op("=", ref("p_size"), lit(20)), op("=", ref("p_size"), ref("p_partkey"))), "p_size = 20 OR p_size = p_partkey")
_predicate(
    "pred_tuple_domain",
    P.of_domain("p_size", points=(1, 50), ranges=((10, True, 12, False), (None, False, 3, False)), null_allowed=True),
    "p_size IN (1, 50) OR p_size >= 10 AND p_size < 12 OR p_size < 3 OR p_size IS NULL",
)


_predicate("pred_cast_keeps", op("=", P.Cast(ref("p_retailprice"), "int"), lit(1000)), "CAST(trunc(p_retailprice) AS INTEGER) = 1000")
_predicate("pred_domain_none", P.of_domain("p_size"), "false")
_predicate("pred_domain_all", P.of_domain("p_size", everything=True), "true")
_predicate("pred_overflow", op("or", op(">", ref("p_size"), lit(1 << 40)), op("=", ref("p_size"), lit(9))), "p_size > 1099511627776 OR p_size = 9")


@book.add("SELECT p_partkey, p_name, p_size FROM part WHERE p_size BETWEEN 5 AND 9 AND NOT (p_name LIKE 'r%' OR p_brand IS NULL) OR p_size IN (50, 49)")
def pred_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A condition given as text."""
    return _part(spark, sf_dir, parser.parse("p_size BETWEEN 5 AND 9 AND NOT (p_name LIKE 'r%' OR p_brand IS NULL) OR p_size IN (50, 49)"))


@book.add("SELECT p_partkey, p_name FROM part WHERE starts_with(p_name, 'hot') AND ends_with(p_name, 'plate') OR contains(p_name, ' ro')")
def pred_prefix_suffix_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return table(spark, sf_dir, "part").filter((name.startswith("hot") & name.endswith("plate")) | name.contains(" ro")).select("p_partkey", "p_name")


# --- scalars


@book.add("""
    SELECT l_orderkey, l_linenumber, l_quantity + 1 AS plus, l_extendedprice - l_tax AS minus, round(l_extendedprice * (1 - l_discount), 6) AS times,
        round(l_extendedprice / l_quantity, 6) AS ratio, l_orderkey // 7 AS whole, l_orderkey % 7 AS rest FROM lineitem""")
def arith_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", (c("l_quantity") + 1).alias("plus"), (c("l_extendedprice") - c("l_tax")).alias("minus"),
        F.round(c("l_extendedprice") * (1 - c("l_discount")), 6).alias("times"), F.round(c("l_extendedprice") / c("l_quantity"), 6).alias("ratio"),
        F.expr("l_orderkey div 7").alias("whole"), (c("l_orderkey") % 7).alias("rest"),
    )


@book.add("SELECT o_orderkey, o_orderkey & 255 AS band, o_orderkey | 1024 AS bor, xor(o_orderkey, o_custkey) AS bxor FROM orders")
def bit_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", k.bitwiseAND(F.lit(255)).alias("band"), k.bitwiseOR(F.lit(1024)).alias("bor"), k.bitwiseXOR(F.col("o_custkey")).alias("bxor")
    )


@book.add("SELECT CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS n FROM orders GROUP BY 1")
def year_fn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count("*").alias("n"))


@book.add("""
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS shown, strftime(o_orderdate, '%d/%m/%Y') AS day,
        CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS parsed FROM orders""")
def date_format_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", scalar.format_timestamp(d).alias("shown"), F.date_format(d, "dd/MM/yyyy").alias("day"),
        F.to_date(F.date_format(d, "yyyy-MM-dd"), "yyyy-MM-dd").alias("parsed"),
    )


@book.add("""
    SELECT event_id, ((epoch_us(ts) // 1000) << 18) + event_id % 262144 AS version, epoch_us(ts) // 1000 AS millis, event_id % 262144 AS counter FROM events""")
def tso_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    version = F.shiftleft(millis, 18) + F.col("event_id") % 262144
    rows = table(spark, sf_dir, "events").select("event_id", version.alias("version"))
    return rows.select("event_id", "version", F.shiftright("version", 18).alias("millis"), F.col("version").bitwiseAND(F.lit(262143)).alias("counter"))


@book.add("""
    SELECT event_id, CASE WHEN event_id % 2 = 1 THEN -1 ELSE 1 END * ((event_id % 839) * 3600 + (event_id % 60) * 60 + event_id % 59) * 1000000000
        + CASE WHEN event_id % 2 = 1 THEN -1 ELSE 1 END * 250000000 AS nanos FROM events""")
def duration_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    text = F.concat(F.when(e % 2 == 1, "-").otherwise(""), e % 839, F.lit(":"), F.lpad((e % 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((e % 59).cast("string"), 2, "0"), F.lit(".25"))
    return table(spark, sf_dir, "events").select("event_id", scalar.duration_nanos(text).alias("nanos"))


@book.add("SELECT o_orderkey, CAST(CAST(18446744073709551616 AS HUGEINT) - o_orderkey AS VARCHAR) AS value FROM orders WHERE o_orderkey > 0")
def unsigned_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").filter("o_orderkey > 0")
    return rows.select("o_orderkey", scalar.unsigned_long(-F.col("o_orderkey")).cast("string").alias("value"))


@book.add("SELECT p_partkey, p_name AS back FROM part")
def hex_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", scalar.from_hex(F.concat(F.lit("0x"), F.hex("p_name"))).alias("back"))


@book.add("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@book.add("SELECT c_custkey, coalesce(nullif(c_mktsegment, 'BUILDING'), 'none') AS segment, CASE WHEN c_acctbal < 0 THEN 'owes' WHEN c_acctbal < 5000 THEN 'some' ELSE 'rich' END AS state FROM customer")
def null_conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.coalesce(F.nullif("c_mktsegment", F.lit("BUILDING")), F.lit("none")).alias("segment"),
        F.when(b < 0, "owes").when(b < 5000, "some").otherwise("rich").alias("state"),
    )


@book.add("SELECT p_partkey, upper(p_name) AS u, lower(p_type) AS l, length(p_name) AS n, substring(p_name, 2, 4) AS s, replace(p_brand, '#', '-') AS r, p_name || '/' || p_brand AS j FROM part")
def string_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.upper("p_name").alias("u"), F.lower("p_type").alias("l"), F.length("p_name").cast("long").alias("n"), F.substring("p_name", 2, 4).alias("s"),
        F.replace("p_brand", F.lit("#"), F.lit("-")).alias("r"), F.concat_ws("/", "p_name", "p_brand").alias("j"),
    )


# --- aggregation

_SUMS = "CAST(sum(l_linenumber) AS BIGINT) AS total, count(l_quantity) AS n, min(l_extendedprice) AS least, max(l_extendedprice) AS most"


def _sums():
    return [F.sum("l_linenumber").alias("total"), F.count("l_quantity").alias("n"), F.min("l_extendedprice").alias("least"), F.max("l_extendedprice").alias("most")]


@book.add(f"SELECT {_SUMS}, arg_min(l_partkey, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS first FROM lineitem")
def agg_sum_count_min_max_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = F.min_by("l_partkey", F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")).alias("first")
    return table(spark, sf_dir, "lineitem").agg(*_sums(), first)


@book.add(f"SELECT {_SUMS}, l_returnflag, l_linestatus FROM lineitem GROUP BY l_returnflag, l_linestatus")
def group_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregates come before the keys."""
    out = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*_sums())
    return out.select("total", "n", "least", "most", "l_returnflag", "l_linestatus")


@book.add("SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey HAVING count(*) > 600")
def having_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("n")).filter("n > 600")


@book.add("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority").distinct()


@book.add("SELECT count(*) AS rows, count(nullif(event_type, 'error')) AS fine, count(DISTINCT user_id) AS users FROM events")
def count_star_col(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").agg(
        F.count("*").alias("rows"), F.count(F.nullif("event_type", F.lit("error"))).alias("fine"), F.countDistinct("user_id").alias("users")
    )


@book.add("""
    SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) * 2 + grouping(l_linestatus) AS BIGINT) AS g, count(*) AS n
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""")
def grouping_sets_cube_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.grouping_id().alias("g"), F.count("*").alias("n"))


@book.add("SELECT o_orderstatus, o_orderpriority, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def rollup_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").rollup("o_orderstatus", "o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@book.add("""
    SELECT CAST(floor(o_totalprice / 25000) AS BIGINT) AS bucket, count(*) AS n, min(o_totalprice) AS low, max(o_totalprice) AS high FROM orders GROUP BY 1""")
def hist_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    bucket = F.floor(F.col("o_totalprice") / 25000).alias("bucket")
    return table(spark, sf_dir, "orders").groupBy(bucket).agg(F.count("*").alias("n"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


@book.add("""
    SELECT CAST(floor((rn - 1) * 16 / t) AS BIGINT) AS bucket, min(v) AS low, max(v) AS high, count(*) AS n
    FROM (SELECT l_quantity AS v, row_number() OVER (ORDER BY l_quantity) AS rn, count(*) OVER () AS t FROM lineitem) GROUP BY 1""")
def hist_equi_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return statistics.equi_depth(table(spark, sf_dir, "lineitem"), "l_quantity", 16)


@book.add()
def approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.approx_count_distinct("l_partkey", 0.01).alias("parts"))


@book.add()
def cm_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Count-Min sketch of the suppliers of line items, as bytes."""
    return table(spark, sf_dir, "lineitem").agg(F.count_min_sketch("l_suppkey", F.lit(0.001), F.lit(0.99), F.lit(7)).alias("sketch"))


@book.add("SELECT l_returnflag, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END)::BIGINT AS O, sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS F FROM lineitem GROUP BY l_returnflag")
def pivot_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["O", "F"]).agg(F.count(F.lit(1)))
    return flagged.na.fill(0, ["O", "F"])


# --- sort, limit, top n


@book.add("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50")
def topn_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(50)


@book.add("""
    SELECT split, o_orderkey FROM (SELECT o_orderkey % 8 AS split, o_orderkey, row_number() OVER (PARTITION BY o_orderkey % 8 ORDER BY o_orderkey) AS rn FROM orders)
    WHERE rn <= 5""")
def limit_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 8).alias("split"), "o_orderkey")
    place = F.row_number().over(Window.partitionBy("split").orderBy("o_orderkey"))
    return rows.withColumn("rn", place).filter("rn <= 5").drop("rn")


@book.add("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey")
def global_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey")


# --- joins


@book.add("SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey")
def lookup_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with the dimension's row for its key, nulls if there is none."""
    dim = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment")
    return table(spark, sf_dir, "events").select("event_id", "user_id").join(dim, "user_id", "left").select("event_id", "user_id", "c_name", "c_mktsegment")


def _orders_customers(spark, sf_dir):
    """Both whole tables; some keys are null or negative, so that rows of either side stay without a partner."""
    k, c = F.col("o_orderkey"), F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select(F.when(c % 3 == 0, -c).otherwise(c).alias("c_custkey"), "c_name")
    return table(spark, sf_dir, "orders").select(k, F.when(k % 5 != 0, F.col("o_custkey")).alias("o_custkey")), customers


for _kind in ("inner", "left", "right", "full"):

    def _joined(spark: SparkSession, sf_dir: str, kind: str = _kind) -> DataFrame:
        o, c = _orders_customers(spark, sf_dir)
        return o.join(c, o["o_custkey"] == c["c_custkey"], kind)

    _joined.__name__ = f"join_{_kind}"
    book.add(f"""
        SELECT o_orderkey, o_custkey, c_custkey, c_name FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS o_custkey FROM orders) o
        {_kind.upper()} JOIN (SELECT CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_name FROM customer) c ON o_custkey = c_custkey""")(_joined)


@book.add("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@book.add("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 200000)")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").filter("o_totalprice > 200000").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(big, "c_custkey", "left_anti")


@book.add("SELECT r_name, n_name FROM region, nation")
def join_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two tables of fixed size."""
    return table(spark, sf_dir, "region").select("r_name").crossJoin(table(spark, sf_dir, "nation").select("n_name"))


@book.add("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_acctbal < b.s_acctbal")
def join_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    a, b = s.withColumnRenamed("s_suppkey", "a"), s.select(F.col("s_suppkey").alias("b"), "s_nationkey", F.col("s_acctbal").alias("other"))
    return a.join(b, "s_nationkey").filter("s_acctbal < other").select("a", "b")


@book.add("""
    SELECT p.event_id, max(v.event_id) AS last_view FROM events p LEFT JOIN events v
    ON v.user_id = p.user_id AND v.event_type = 'view' AND v.event_id < p.event_id
    WHERE p.event_type = 'purchase' GROUP BY p.event_id""")
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest view before each purchase of a user, by windows over slices instead of a join."""
    view = F.when(F.col("event_type") == "view", F.col("event_id"))
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return ordered.latest_before(rows, ["user_id"], "event_id", view, "last_view").filter("event_type = 'purchase'").select("event_id", "last_view")


# --- windows and set operations


@book.add("""
    SELECT o_orderkey, row_number() OVER w AS rn, rank() OVER p AS rk, dense_rank() OVER p AS dr, ntile(4) OVER w AS nt FROM orders
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey), p AS (PARTITION BY o_custkey ORDER BY o_orderpriority)""")
def win_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    p = Window.partitionBy("o_custkey").orderBy("o_orderpriority")
    made = {"rn": F.row_number().over(w), "rk": F.rank().over(p), "dr": F.dense_rank().over(p), "nt": F.ntile(4).over(w)}
    return table(spark, sf_dir, "orders").select("o_orderkey", *[v.cast("long").alias(k) for k, v in made.items()])


@book.add("""
    SELECT event_id, lag(event_type) OVER w AS before, lead(event_id, 2, 0) OVER w AS after, first_value(event_id) OVER w AS first FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def win_lag_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.lag("event_type").over(w).alias("before"), F.lead("event_id", 2, 0).over(w).alias("after"), F.first("event_id").over(w).alias("first")
    )


@book.add("""
    SELECT event_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS last3,
        count(*) OVER (PARTITION BY user_id ORDER BY event_id RANGE BETWEEN 100 PRECEDING AND CURRENT ROW) AS near FROM events""")
def win_frame_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(F.sum("value").over(w.rowsBetween(-2, 0)), 6).alias("last3"), F.count("*").over(w.rangeBetween(-100, 0)).alias("near")
    )


def _two(spark, sf_dir):
    """Nations of customers, and those of suppliers moved on by five, so that each side has some that the other lacks."""
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")), table(spark, sf_dir, "supplier").select((F.col("s_nationkey") + 5).alias("k"))


_A, _B = "SELECT c_nationkey AS k FROM customer", "SELECT s_nationkey + 5 AS k FROM supplier"


@book.add(f"SELECT k, count(*) AS n FROM ({_A} UNION ALL {_B}) GROUP BY k")
def union_all_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of both, counted by value."""
    a, b = _two(spark, sf_dir)
    return a.unionByName(b).groupBy("k").agg(F.count("*").alias("n"))


@book.add(f"{_A} UNION {_B}")
def union_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.unionByName(b).distinct()


@book.add(f"{_A} INTERSECT {_B}")
def intersect_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.intersect(b)


@book.add(f"{_A} INTERSECT ALL {_B}")
def intersect_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.intersectAll(b)


@book.add(f"{_A} EXCEPT {_B}")
def except_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.subtract(b)


@book.add(f"{_A} EXCEPT ALL {_B}")
def except_all_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = _two(spark, sf_dir)
    return a.exceptAll(b)


# --- arrays, maps, sketches within their bounds, look-ups


@book.add("""
    SELECT c_nationkey, len(a) AS n, a[1] AS least, list_contains(a, 7) AS has_seven, list_sum(list_filter(a, lambda x: x % 2 = 0))::BIGINT AS even, array_to_string(a[1:3], '-') AS first
    FROM (SELECT c_nationkey, list_sort(list(c_custkey)) AS a FROM customer WHERE c_custkey <= 1000 GROUP BY c_nationkey)""")
def array_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = F.col("a")
    rows = table(spark, sf_dir, "customer").filter("c_custkey <= 1000").groupBy("c_nationkey").agg(F.array_sort(F.collect_list("c_custkey")).alias("a"))
    even = F.filter(a, lambda x: x % 2 == 0)
    return rows.select(
        "c_nationkey", F.size(a).cast("long").alias("n"), a[0].alias("least"), F.array_contains(a, 7).alias("has_seven"),
        F.when(F.size(even) > 0, F.aggregate(even, F.lit(0).cast("long"), lambda s, x: s + x)).alias("even"), F.array_join(F.slice(a, 1, 3), "-").alias("first"),
    )


@book.add("SELECT p_partkey, p_brand AS brand, CAST(NULL AS VARCHAR) AS missing, 2 AS size, 'brand,type' AS keys FROM part")
def map_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.create_map(F.lit("type"), F.col("p_type"), F.lit("brand"), F.col("p_brand"))
    rows = table(spark, sf_dir, "part").select("p_partkey", m.alias("m"))
    return rows.select("p_partkey", F.col("m")["brand"].alias("brand"), F.try_element_at("m", F.lit("colour")).alias("missing"), F.size("m").alias("size"), F.array_join(F.array_sort(F.map_keys("m")), ",").alias("keys"))


@book.add("SELECT true AS near, count(*) AS parts FROM (SELECT DISTINCT l_partkey FROM lineitem)")
def approx_distinct_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The estimate is within five times its relative standard deviation of the exact number."""
    rows = table(spark, sf_dir, "lineitem").agg(F.approx_count_distinct("l_partkey", 0.01).alias("a"), F.countDistinct("l_partkey").alias("parts"))
    return rows.select((F.abs(F.col("a") - F.col("parts")) <= 0.05 * F.col("parts")).alias("near"), "parts")


@book.add("SELECT l_suppkey, count(*) AS n, true AS bounded FROM lineitem GROUP BY l_suppkey")
def cm_sketch_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each count is no more than the sketch's bound, and that no more than the share of all that its width allows."""
    lines = table(spark, sf_dir, "lineitem")
    sketch = statistics.CountMin.parse(bytes(lines.agg(F.count_min_sketch("l_suppkey", F.lit(0.001), F.lit(0.999), F.lit(7)).alias("s")).first()["s"]))
    counts = lines.groupBy("l_suppkey").agg(F.count("*").alias("n"))
    held = F.udf(lambda k, n: n <= sketch.most(k) <= n + 0.002 * sketch.total, "boolean")  # one row for each supplier
    return counts.select("l_suppkey", "n", held("l_suppkey", "n").alias("bounded"))


@book.add("SELECT event_id, user_id, c_name FROM events LEFT JOIN customer ON user_id = c_custkey")
def lookup_join_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broadcast if the dimension has few rows, else joined by a shuffle."""
    dim = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    return lookup.lookup_join(table(spark, sf_dir, "events").select("event_id", "user_id"), dim, ["user_id"]).select("event_id", "user_id", "c_name")
