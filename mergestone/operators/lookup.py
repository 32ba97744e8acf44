"""Look-up joins: each row of facts with the dimension's row for its key, as the dimension was at a moment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a dimension that are broadcast at most.
MOST_CACHED = 100_000


def lookup_join(facts: DataFrame, dimension: DataFrame, key: Sequence[str], most_cached: int = MOST_CACHED) -> DataFrame:
    """Left join on the key; null keys find nothing. A dimension of at most ``most_cached`` rows is broadcast, a larger one shuffled.

    facts may be a stream; the dimension is then read anew for each of its batches.
    """
    if nested := [c for c in key if "." in c]:
        raise ValueError(f"look-up keys can't be nested: {nested}")
    if most_cached and dimension.limit(most_cached + 1).count() <= most_cached:
        dimension = F.broadcast(dimension)
    return facts.join(dimension, list(key), "left")


def lookup_as_of(facts: DataFrame, versions: DataFrame, key: Sequence[str], time_col: str, version_col: str = "commit_version", change_col: str = "_change_type") -> DataFrame:
    """Each row of facts with the dimension's row as of its own time: versions is the dimension's version log.

    time_col and version_col count the same units. A key whose latest change by
    then was a delete finds nothing. Both sides are put in one order by key and
    time, so there is one shuffle and no product of versions.
    """
    from pyspark.sql import Window

    rest = [c for c in versions.columns if c not in (*key, version_col, change_col)]
    held = F.struct(*[F.col(c) for c in rest], F.col(change_col).alias("_kind"))
    asked = facts.select(*[F.col(c) for c in key], F.col(time_col).alias("_at"), F.lit(1).alias("_side"), F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"))
    known = versions.filter(F.col(change_col) != "update_preimage").select(*key, F.col(version_col).alias("_at"), F.lit(0).alias("_side"), held.alias("_held"))
    both = asked.unionByName(known, allowMissingColumns=True)
    # a version at the fact's own time counts
    window = Window.partitionBy(*key).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_now", F.last("_held", ignorenulls=True).over(window)).filter("_side = 1")
    present = F.col("_now._kind") != "delete"
    has_key = [F.col(c).isNotNull() for c in key]
    for one in has_key:
        present = present & one
    return found.select("_fact.*", *[F.when(present, F.col(f"_now.{c}")).alias(c) for c in rest])


def refreshed(facts: DataFrame, dimension: Callable[[], DataFrame], key: Sequence[str], put: Callable[[DataFrame, int], None], most_cached: int = MOST_CACHED):
    """A stream's batches joined with the dimension as it is when each begins, handed to ``put``; returns the writer."""
    return facts.writeStream.foreachBatch(lambda batch, number: put(lookup_join(batch, dimension(), key, most_cached), number))
