"""Column statistics and row-count estimates from them: equi-depth histograms and Count-Min sketches."""

from __future__ import annotations

import struct
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Ranges at least whose values are put in order apart from each other; as many as shuffle partitions if these are more.
RANGES = 32


def equi_depth(rows: DataFrame, column: str, buckets: int) -> DataFrame:
    """(bucket, low, high, n): the column's values in order, cut into buckets of nearly equal count; nulls are left out.

    Equal values are counted first; only the distinct values are put in order.
    A value's rows may fall into several buckets.
    """
    values = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("c"))
    total = rows.agg(F.count(column).alias("t"))  # one row
    # running counts: within ranges of the values first, then over the ranges, which approximate percentiles bound
    ranges = max(RANGES, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = rows.agg(F.percentile_approx(column, [i / ranges for i in range(1, ranges)]).alias("b")).first()["b"] or []
    below = [(F.col("v") > F.lit(b)).cast("int") for b in sorted(set(bounds))]
    ranged = values.withColumn("_p", sum(below, F.lit(0)))
    own = F.sum("c").over(Window.partitionBy("_p").orderBy("v"))
    sums = ranged.groupBy("_p").agg(F.sum("c").alias("s"))
    before = F.coalesce(F.sum("s").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("own", own).join(F.broadcast(sums.select("_p", before.alias("b"))), "_p")  # one row a range
    spans = placed.crossJoin(F.broadcast(total)).withColumns({"last": F.col("b") + F.col("own"), "first": F.col("b") + F.col("own") - F.col("c") + 1})
    number = lambda place: F.floor((place - 1) * buckets / F.col("t"))
    cut = spans.withColumn("bucket", F.explode(F.sequence(number(F.col("first")), number(F.col("last")))))
    start = F.ceil(F.col("bucket") * F.col("t") / buckets) + 1
    end = F.ceil((F.col("bucket") + 1) * F.col("t") / buckets)
    share = F.least("last", end) - F.greatest("first", start) + 1
    return cut.groupBy("bucket").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.sum(share).cast("long").alias("n"))


@dataclass(frozen=True)
class Histogram:
    """A collected equi-depth histogram of numbers: a bounded number of (low, high, n) in order."""

    buckets: tuple[tuple[float, float, int], ...]

    @staticmethod
    def of(rows: DataFrame, column: str, buckets: int = 64) -> "Histogram":
        return Histogram(tuple((r["low"], r["high"], r["n"]) for r in equi_depth(rows, column, buckets).orderBy("bucket").collect()))

    def less(self, value) -> float:
        """Estimated rows below the value: whole buckets, and a straight share of the one that holds it."""
        out = 0.0
        for low, high, n in self.buckets:
            if high < value:
                out += n
            elif low < value:
                out += n * (value - low) / max(high - low, 1e-12)
        return out

    def equal(self, value) -> float:
        """Estimated rows of the value: buckets of it alone, and for others their rows over the numbers they span."""
        return sum(n / max(1.0, high - low + 1) for low, high, n in self.buckets if low <= value <= high)

    def greater(self, value) -> float:
        return max(0.0, sum(n for *_, n in self.buckets) - self.less(value) - self.equal(value))

    def between(self, low, high) -> float:
        """Estimated rows with low <= value < high."""
        return max(0.0, self.less(high) - self.less(low))


@dataclass(frozen=True)
class CountMin:
    """A Count-Min sketch over longs as rows of counters; the estimate takes the noise out by the median row."""

    total: int
    width: int
    seeds: tuple[int, ...]
    counts: tuple[tuple[int, ...], ...]

    @staticmethod
    def parse(data: bytes) -> "CountMin":
        """Spark's serialised sketch, version 1."""
        version, total, depth, width = struct.unpack_from(">iqii", data)
        if version != 1:
            raise ValueError(f"unknown sketch version {version}")
        seeds = struct.unpack_from(f">{depth}q", data, 20)
        flat = struct.unpack_from(f">{depth * width}q", data, 20 + 8 * depth)
        return CountMin(total, width, seeds, tuple(flat[i * width : (i + 1) * width] for i in range(depth)))

    def _place(self, row: int, value: int) -> int:
        mixed = self.seeds[row] * value & 0xFFFFFFFFFFFFFFFF
        signed = mixed - (1 << 64) if mixed >> 63 else mixed
        signed += signed >> 32
        return (signed & 0x7FFFFFFF) % self.width

    def most(self, value: int) -> int:
        """The sketch's own bound from above."""
        return min(row[self._place(i, value)] for i, row in enumerate(self.counts))

    def estimate(self, value: int) -> int:
        """Median over the rows of the counter less its expected noise, between 0 and the bound."""
        found = [row[self._place(i, value)] for i, row in enumerate(self.counts)]
        clear = sorted(c - (self.total - c) / max(1, self.width - 1) for c in found)
        half = len(clear) // 2
        middle = clear[half] if len(clear) % 2 else (clear[half - 1] + clear[half]) / 2
        return max(0, min(round(middle), min(found)))
