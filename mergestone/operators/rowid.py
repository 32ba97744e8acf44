"""Generated row ids: running, with random shards, and implicit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bucket of the numbering, if the order column's values are spread evenly; and buckets at most.
ROWS, MOST_BUCKETS = 100_000, 100_000
STEP = 30_000


def numbered(rows: DataFrame, order_col: str, name: str, width: int | None = None) -> DataFrame:
    """Rows numbered from 1 in order of an integer column without nulls, ties at will, without sorting all in one task.

    Rows are counted by bucket of the column, the counts of the buckets before
    are added up, and each bucket numbers its own rows. Without ``width`` the
    column's range is cut into buckets by the number of rows.
    """
    if width is None:
        span = rows.agg(F.min(order_col).alias("low"), F.max(order_col).alias("high"), F.count("*").alias("n")).first()
        buckets = min(MOST_BUCKETS, max(1, span["n"] // ROWS))
        width = max(1, ((span["high"] or 0) - (span["low"] or 0)) // buckets + 1)
    bucket = F.floor(F.col(order_col) / F.lit(width))
    counts = rows.groupBy(bucket.alias("_b")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each bucket
    starts = counts.withColumn("_s", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    own = F.row_number().over(Window.partitionBy("_b").orderBy(order_col))
    return rows.withColumn("_b", bucket).join(starts, "_b").withColumn(name, (F.col("_s") + own).cast("long")).drop("_b", "_s")


def check_shards(shard_bits: int, unsigned: bool, last: int) -> None:
    """Errors if the running part of the last id doesn't fit beside the shard and sign bits."""
    if not 0 <= shard_bits <= 15:
        raise ValueError("shard bits are 0 to 15")
    if last >= 1 << (64 - shard_bits - (not unsigned)):
        raise OverflowError(f"row id {last} doesn't fit beside {shard_bits} shard bits")


def sharded(running: Column, seed: Column, shard_bits: int, unsigned: bool = False) -> Column:
    """The running id with the low ``shard_bits`` of the seed as its top bits, under the sign bit if it has one."""
    if shard_bits == 0:
        return running
    shift = 64 - shard_bits - (not unsigned)
    return F.shiftleft(seed.bitwiseAND(F.lit((1 << shard_bits) - 1)), shift).bitwiseOR(running)


class Allocator:
    """Hands out ranges of running ids in steps; ``base`` is the last id given so far."""

    def __init__(self, base: int = 0, step: int = STEP, bits: int = 63) -> None:
        self.base, self.step, self.most = base, step, (1 << bits) - 1

    def take(self, n: int) -> tuple[int, int]:
        """(first, last) of at least n new ids, whole steps."""
        size = -(-max(n, 1) // self.step) * self.step
        if self.base + size > self.most:
            raise OverflowError("no row ids left")
        first, self.base = self.base + 1, self.base + size
        return first, self.base


def with_auto_id(rows: DataFrame, column: str, order_col: str, base: int = 0, ignore_given: bool = False) -> DataFrame:
    """Null ids (all, with ``ignore_given``) filled with running ids after ``base``; given ones stay."""
    given = F.lit(None).cast("long") if ignore_given or column not in rows.columns else F.col(column)
    made = numbered(rows, order_col, "_id")
    return made.withColumn(column, F.coalesce(given, F.col("_id") + base)).drop("_id")
