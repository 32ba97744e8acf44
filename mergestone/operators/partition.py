"""Partitioned tables: routing rows, and pruning partitions from a predicate before the plan is built."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergestone.functions.predicates import COMPARISONS, Lit, Op, Ref, column

MAXVALUE = "MAXVALUE"
COLUMN = "_part"


@dataclass(frozen=True)
class HashPartitioning:
    """By the absolute remainder of an integer column, or of the year of a date column; null goes to the first."""

    column: str
    count: int
    year: bool = False

    def route(self) -> Column:
        value = F.year(self.column) if self.year else F.col(self.column)
        return F.abs(F.coalesce(value, F.lit(0)) % self.count).cast("int")

    def prune(self, low=None, high=None, equal=None) -> list[int]:
        """Partitions that rows with low <= column <= high, or column = equal, can be in."""
        if equal is not None:
            return [abs(int(equal)) % self.count]
        if low is not None and high is not None and high - low + 1 < self.count:
            return sorted({abs(v) % self.count for v in range(int(low), int(high) + 1)})
        return list(range(self.count))


@dataclass(frozen=True)
class RangePartitioning:
    """By the first of the rising upper bounds that is greater than the column, or than its year.

    A value at or over the last bound has no partition, unless that is
    MAXVALUE; null goes to the first. With ``year``, bounds are years and values
    given to ``prune`` too.
    """

    column: str
    bounds: tuple
    year: bool = False

    def __post_init__(self) -> None:
        plain = [b for b in self.bounds if b != MAXVALUE]
        if MAXVALUE in self.bounds[:-1] or plain != sorted(set(plain)):
            raise ValueError("bounds must rise, and only the last can be MAXVALUE")

    @property
    def count(self) -> int:
        return len(self.bounds)

    def route(self) -> Column:
        value = F.year(self.column) if self.year else F.col(self.column)
        out = F.when(value.isNull(), 0)
        for i, bound in enumerate(self.bounds):
            out = out.when(F.lit(True) if bound == MAXVALUE else value < F.lit(bound), i)
        if self.bounds[-1] != MAXVALUE:
            out = out.otherwise(F.raise_error(F.concat(F.lit(f"no partition for {self.column} = "), value.cast("string"))).cast("int"))
        return out.cast("int")

    def prune(self, low=None, high=None, equal=None) -> list[int]:
        """Partitions that rows with low <= column <= high, or column = equal, can be in; null rows match neither."""
        low, high = (equal, equal) if equal is not None else (low, high)
        out = []
        for i, bound in enumerate(self.bounds):
            floor = self.bounds[i - 1] if i else None
            if (bound == MAXVALUE or low is None or low < bound) and (floor is None or high is None or high >= floor):
                out.append(i)
        return out


def partitions_of(tree, partitioning) -> set[int]:
    """Partitions that can hold rows of which a normalised predicate is true.

    Comparisons of the partition column with literals give ranges; for
    partitions by year a date's year stands for it, and its partition stays in
    on either side. AND intersects, OR unites; all else may be true anywhere.
    Null rows, which are in the first partition, fulfil no comparison.
    """
    every = set(range(partitioning.count))
    if not isinstance(tree, Op):
        return every
    if tree.name in ("and", "or"):
        left, right = (partitions_of(a, partitioning) for a in tree.args)
        return left & right if tree.name == "and" else left | right
    if tree.name in ("false", "true"):
        return every if tree.name == "true" else set()
    first = tree.args[0] if tree.args else None
    if not (isinstance(first, Ref) and first.name.lower() == partitioning.column.lower()):
        return every
    if tree.name == "is null":
        return {0}
    if tree.name not in COMPARISONS or tree.name == "<>" or not isinstance(tree.args[1], Lit):
        return every
    value = tree.args[1].value
    if value is None:
        return set()
    try:
        if partitioning.year:
            value = getattr(value, "year", None) or int(str(value)[:4])
        if tree.name == "=":
            return set(partitioning.prune(equal=value))
        return set(partitioning.prune(high=value) if tree.name in ("<", "<=") else partitioning.prune(low=value))
    except (TypeError, ValueError):  # a literal of another type than the bounds
        return every


def make(kind: str, columns: Sequence[str], bounds=None, count: int | None = None, function: str | None = None):
    """A partitioning from its declaration; kinds that can't be written are errors."""
    if len(columns) != 1:
        raise ValueError("only one partition column is supported")
    if function not in (None, "year"):
        raise ValueError(f"partitions by {function}() are not supported")
    if kind == "hash":
        return HashPartitioning(columns[0], int(count), function == "year")
    if kind == "range":
        return RangePartitioning(columns[0], tuple(bounds), function == "year")
    raise ValueError(f"{kind} partitions are not supported")


def dump(partitioning) -> dict | None:
    """A partitioning as plain values that JSON can hold."""
    if partitioning is None:
        return None
    if isinstance(partitioning, HashPartitioning):
        return {"kind": "hash", "column": partitioning.column, "count": partitioning.count, "year": partitioning.year}
    plain = lambda b: {"date": b.isoformat()} if hasattr(b, "isoformat") else {"bytes": b.hex()} if isinstance(b, bytes) else b
    return {"kind": "range", "column": partitioning.column, "bounds": [plain(b) for b in partitioning.bounds], "year": partitioning.year}


def load(held: dict | None):
    if held is None:
        return None
    if held["kind"] == "hash":
        return HashPartitioning(held["column"], held["count"], held["year"])

    def bound(b):
        if not isinstance(b, dict):
            return b
        if "bytes" in b:
            return bytes.fromhex(b["bytes"])
        return datetime.datetime.fromisoformat(b["date"]) if "T" in b["date"] else datetime.date.fromisoformat(b["date"])

    return RangePartitioning(held["column"], tuple(map(bound, held["bounds"])), held["year"])


def routed(rows: DataFrame, partitioning) -> DataFrame:
    """The rows with their partition's number in ``_part``, as a column to write by."""
    return rows.withColumn(COLUMN, partitioning.route())


def pruned(rows: DataFrame, partitioning, low=None, high=None, equal=None) -> DataFrame:
    """Rows of a table written by ``_part`` that the condition allows: a partition filter, so other folders aren't listed,
    and the condition itself. For partitions by year give dates; the partitions are those of their years."""
    wanted = [low, high, equal]
    if partitioning.year:
        wanted = [None if v is None else int(str(v)[:4]) for v in wanted]
    rows = only(rows, partitioning.prune(*wanted))
    value_of = F.col(partitioning.column)
    for value, keep in ((low, value_of.__ge__), (high, value_of.__le__), (equal, value_of.__eq__)):
        if value is not None:
            rows = rows.filter(keep(F.lit(value)))
    return rows


def only(rows: DataFrame, numbers) -> DataFrame:
    """Rows of the partitions of these numbers; a filter on the folders' column, which other folders never pass."""
    return rows.filter(F.col(COLUMN).isin(sorted(numbers)) if numbers else F.lit(False))


def matching(rows: DataFrame, partitioning, tree) -> DataFrame:
    """Rows, written by ``_part``, of which a normalised predicate is true; only the folders that can hold some are read."""
    wanted = partitions_of(tree, partitioning)
    return (rows if len(wanted) == partitioning.count else only(rows, wanted)).filter(column(tree))


def hex_bound(text: str) -> bytes:
    """A hexadecimal literal, 0x41 or X'41', as the bytes that bound a binary column."""
    text = text.strip()
    return bytes.fromhex(text[2:-1] if text[:2].upper() == "X'" else text[2:])


def local_limit(rows: DataFrame, n: int) -> DataFrame:
    """At most n rows of each partition, as a limit that a store applies for each split; the engine limits again."""
    schema = rows.schema

    def take(batches):
        left = n
        for batch in batches:
            if left <= 0:
                return
            yield batch.slice(0, left)
            left -= batch.num_rows

    return rows.mapInArrow(take, schema)
