"""Values carried along an order: what came before a row, for keys of any size.

A key's rows are cut into slices along an integer column. A window finds the
value within the slice, and a second one, over one row for each key and slice,
what the slices before hand on; so a key with most rows fills many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of the order's whole range.
SLICES = 256


def _carried(rows: DataFrame, by: Sequence[str], order: str, value: Column, name: str, latest: bool, slices: int) -> DataFrame:
    span = rows.agg(F.min(order).alias("low"), F.max(order).alias("high")).first()
    low, high = span["low"] or 0, span["high"] or 0
    width = max(1, (high - low) // slices + 1)
    cut = rows.withColumns({"_slice": F.floor((F.col(order) - F.lit(low)) / F.lit(width)), "_value": value})
    within = Window.partitionBy(*by, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    near = (F.last("_value", ignorenulls=True) if latest else F.max("_value")).over(within)
    had = F.col("_value").isNotNull()
    best = F.max_by("_value", F.when(had, F.col(order))) if latest else F.max("_value")
    ends = cut.groupBy(*[F.col(c).alias(f"_b_{c}") for c in by], F.col("_slice").alias("_s")).agg(best.alias("_end"))
    before = Window.partitionBy(*[f"_b_{c}" for c in by]).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    far = (F.last("_end", ignorenulls=True) if latest else F.max("_end")).over(before)
    handed = ends.withColumn("_far", far).filter("_far IS NOT NULL").drop("_end")
    on = F.col("_slice").eqNullSafe(F.col("_s"))
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    joined = cut.withColumn("_near", near).join(handed, on, "left")
    out = F.coalesce("_near", "_far") if latest else F.greatest("_near", "_far")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], out.alias(name))


def latest_before(rows: DataFrame, by: Sequence[str], order: str, value: Column, name: str, slices: int = SLICES) -> DataFrame:
    """Adds the value of the latest row of the key strictly before each row that has one; order is an integer column without ties."""
    return _carried(rows, by, order, value, name, True, slices)


def greatest_before(rows: DataFrame, by: Sequence[str], order: str, value: Column, name: str, slices: int = SLICES) -> DataFrame:
    """Adds the greatest value among the rows of the key strictly before each row; order is an integer column without ties."""
    return _carried(rows, by, order, value, name, False, slices)
