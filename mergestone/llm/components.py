"""Connected components of a link table, without gathering links in one place."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.llm.scratch import Scratch, modest_batches
from mergestone.llm.worker import tidy


class UnionFind:
    """Union-find over any integers; each root is the smallest member."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


#: Nodes that one forest gathers before it is given out.
MOST_NODES = 100_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as (node, its root), at most one link a node; forests of bounded size follow each other."""

    def out(sets: UnionFind) -> pa.RecordBatch:
        nodes = [x for x in sets.parent if sets.find(x) != x]
        roots = [sets.find(x) for x in nodes]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["a", "b"])

    sets = UnionFind()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sets.union(a, b)
        if len(sets.parent) >= MOST_NODES:
            yield out(sets)
            sets = UnionFind()
    yield out(sets)


def contract(links: DataFrame) -> DataFrame:
    """Links (a, b) with the same components, b < a, after union-find within tasks."""
    modest_batches(links.sparkSession)
    return links.select("a", "b").mapInArrow(tidy(_forest), "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node that has a link; the component is its smallest node.

    Union-find shrinks the links of each task to a forest. Rounds of hooking
    follow: each node links its neighbours to the smallest of them, until every
    component is a star around its smallest node; a round that is not the last
    lowers some node's smallest neighbour or drops a link, so the rounds end. A
    round is two grouped minima, which are taken in parts first, and a join of two
    written tables. A node with very many links is a skewed key of that join
    alone, and adaptive execution splits it.
    """
    now = scratch.save(f"{name}-0", contract(links).distinct())
    k = 0
    while True:
        k += 1
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = scratch.save(f"{name}-least-{k}", both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        # every neighbour of a node, and the node itself, hooks on to the node's smallest neighbour
        hooked = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        hooked = hooked.unionByName(least.select("a", F.col("m").alias("b"))).filter("a > b")
        after = scratch.save(f"{name}-{k}", hooked.distinct())
        scratch.drop(f"{name}-{k - 1}", f"{name}-least-{k}")
        now = after
        # done when no node has two parents and no parent has a parent
        ends = after.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(after.select(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").isEmpty():
            break
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
