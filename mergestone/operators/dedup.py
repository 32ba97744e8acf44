"""Set semantics of writes: rows that collide on a key within a batch.

A null in any column of a key means the row doesn't collide on that key, the
opposite of Spark's ``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mergestone.tabledef import all_present

Key = Sequence[str]


def _place(key: Key, order: Sequence[Column]) -> Column:
    """1 for the first row of a key in the order; 1 for rows with a null in the key."""
    # rows without the key are dealt out one by one, so they never meet in one task
    apart = F.when(~all_present(tuple(key)), F.monotonically_increasing_id())
    window = Window.partitionBy(*key, apart).orderBy(*order)
    return F.when(all_present(tuple(key)), F.row_number().over(window)).otherwise(F.lit(1))


def last_wins(rows: DataFrame, keys: Sequence[Key], sequence: Sequence[str]) -> DataFrame:
    """Rows written in the order of ``sequence``, each evicting all rows before it that it collides with on any key.

    A row is evicted by any later row that shares a key with it, whether or not
    that row stays itself; so those stay that are the last of each of their keys.
    """
    if len(keys) == 1:
        # one partial aggregation; rows without the key are groups of their own
        key = tuple(keys[0])
        apart = F.when(~all_present(key), F.monotonically_increasing_id()).alias("_apart")
        whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        last = rows.groupBy(*[F.col(c).alias(f"_k_{c}") for c in key], apart).agg(F.max_by(whole, F.struct(*sequence)).alias("_row"))
        return last.select("_row.*")
    order = [F.col(c).desc() for c in sequence]
    marks = {f"_last_{i}": _place(k, order) for i, k in enumerate(keys)}
    out = rows.withColumns(marks)
    for name in marks:
        out = out.filter(F.col(name) == 1)
    return out.drop(*marks)


def first_wins(rows: DataFrame, keys: Sequence[Key], sequence: Sequence[str]) -> DataFrame:
    """For one key after the other, of the rows still there the first with each value stays."""
    for key in keys:
        rows = rows.withColumn("_first", _place(key, [F.col(c) for c in sequence])).filter("_first = 1").drop("_first")
    return rows


def duplicate_keys(rows: DataFrame, key: Key) -> DataFrame:
    """(key, n) of key values that more than one row has."""
    return rows.filter(all_present(tuple(key))).groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")


def reject_duplicates(rows: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """The rows, if no two collide; else an error that names the key."""
    for key in keys:
        if not duplicate_keys(rows, key).isEmpty():
            raise ValueError(f"rows of one batch collide on ({', '.join(key)}); deduplicate them first")
    return rows
