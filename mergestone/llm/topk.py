"""Exact top-k search by integer inner product: a dual-tree search over cover trees.

Vectors are dealt to cells, each around a pivot, and cells are cut into blocks
of bounded size. Each block of queries first searches the one block of data
that its bound favours, which gives every query a kth score; of all other pairs
of blocks only those are searched, and vectors sent to them, whose bound
reaches the worst of these. A pair of blocks is one group: a stated set of
queries against all rows. In a group both sides get a cover tree. A node of
level l covers its points within 2^l. Its children are centres chosen farthest
first until they cover within 2^(l-1): they are at least that far apart
(separation), every point is within it of its centre (covering), and the node's
own centre is the first of them (nesting). Where that would take more than
``FAN`` centres, as in many dimensions, the level falls by as much as ``FAN``
cover. The search descends both trees together, best bound first, and leaves a
pair of nodes, as of blocks, when

    <q, p> + rq |p| + rp |q| + rq rp  <  the worst kth score of the node's queries,

with q, p the centres and rq, rp the covering radii. Ties go to the smaller
id, so pairs at the bound are still searched. Each query's best of every block
meet in one more ranking.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mergestone.llm.scratch import Scratch
from mergestone.llm.worker import tidy

FAN, LEAF = 16, 96
QUERY_BLOCK, DATA_BLOCK = 4096, 16384
#: Cells of vectors of one length at most, and vectors at most of which their pivots are chosen; neither changes results.
MOST_CELLS, SAMPLE = 64, 4096
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def _pivots(vectors: list[list[float]], most: int, scale: int) -> dict[int, np.ndarray]:
    """Of each length's vectors up to ``most`` of them, chosen farthest first."""
    by_length: dict[int, list[list[float]]] = {}
    for v in vectors:
        by_length.setdefault(len(v), []).append(v)
    out = {}
    with np.errstate(all="ignore"):
        for length, own in by_length.items():
            points = np.floor(np.array(own, np.float64).reshape(len(own), length) * scale)
            rows = np.arange(len(points))
            chosen, nearest = [0], _distances(points, rows, 0)
            while len(chosen) < most and nearest.max() > 0:
                chosen.append(int(nearest.argmax()))
                nearest = np.minimum(nearest, _distances(points, rows, chosen[-1]))
            out[length] = points[chosen]
    return out


def _place(pivots, scale: int):
    """Adds to vectors their length, their nearest pivot's number and the distance; lengths without pivots have one cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int32)
            flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])
            cells, away = np.zeros(len(sizes), np.int32), np.full(len(sizes), np.inf)
            with np.errstate(all="ignore"):
                for length in np.unique(sizes).tolist():
                    centres = pivots.value.get(length)
                    if centres is None:
                        continue
                    own = np.flatnonzero(sizes == length)
                    points = np.floor(flat[(starts[own][:, None] + np.arange(length)).ravel()].reshape(len(own), length) * scale)
                    far = np.stack([np.sqrt(((points - c) ** 2).sum(axis=1)) for c in centres], axis=1)
                    far[np.isnan(far)] = np.inf
                    cells[own], away[own] = far.argmin(axis=1), far.min(axis=1)
            columns = [*batch.columns, pa.array(sizes), pa.array(cells), pa.array(away)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "vec_id", "v", "dim", "cell", "away"])

    return run


def _bounds(pivots: dict[int, np.ndarray], stats: list) -> list[tuple[int, int, int, float, int]]:
    """(dim, cell of queries, cell of data, what no pair's score exceeds, the cell's place among the highest of these)."""
    out = []
    by_length: dict[int, list] = {}
    for r in stats:
        by_length.setdefault(r["dim"], []).append(r)
    with np.errstate(all="ignore"):
        for length, cells in by_length.items():
            centres = pivots[length]
            norms = np.sqrt((centres * centres).sum(axis=1))
            for q in cells:
                if not q["nq"]:
                    continue
                found = []
                for p in cells:
                    near = float(centres[q["cell"]] @ centres[p["cell"]])
                    top = near + q["q_radius"] * norms[p["cell"]] + p["radius"] * norms[q["cell"]] + q["q_radius"] * p["radius"]
                    top += 1e-9 * (abs(top) + norms[q["cell"]] * norms[p["cell"]] + 1)  # rounding may not prune
                    found.append((float("inf") if np.isnan(top) else float(top), p["cell"]))
                found.sort(key=lambda x: (-x[0], x[1]))
                out += [(length, q["cell"], cell, top, i + 1) for i, (top, cell) in enumerate(found)]
    return out


class Node:
    """A node of the cover tree: its centre, the rows it covers within ``radius``, and the level; leaves have no children."""

    __slots__ = ("centre", "norm", "radius", "level", "rows", "children")

    def __init__(self, points: np.ndarray, rows: np.ndarray, centre: int, away: np.ndarray | None = None) -> None:
        if away is None:
            away = _distances(points, rows, centre)
        self.centre, self.rows, self.children = points[centre], rows, []
        self.radius = float(away.max())
        self.norm = float(np.sqrt(self.centre @ self.centre))
        self.level = -math.inf
        if len(rows) <= LEAF or self.radius == 0:
            return
        self.level = math.ceil(math.log2(self.radius))
        owner, nearest, centres = np.zeros(len(rows), np.int64), away, [centre]
        while len(centres) < FAN and (nearest.max() > 2.0 ** (self.level - 1) or len(centres) == 1):
            far = int(nearest.argmax())
            reach = _distances(points, rows, int(rows[far]))
            closer = reach < nearest
            owner[closer] = len(centres)
            nearest = np.where(closer, reach, nearest)
            centres.append(int(rows[far]))
        for k, c in enumerate(centres):
            own = owner == k
            self.children.append(Node(points, rows[own], c, nearest[own]))


def _distances(points: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
    gap = points[rows] - points[centre]
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def _tree(points: np.ndarray) -> Node:
    return Node(points, np.arange(len(points)), 0)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Each line's k best: by score, then by smaller id."""
    if scores.dtype == object:
        order = np.array([sorted(range(scores.shape[1]), key=lambda i: (-s[i], n[i]))[:k] for s, n in zip(scores, ids)], np.int64).reshape(len(scores), -1)
    else:
        order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def dual_tree_topk(
    queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, data_ids: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, dict[str, int]]:
    """(scores, ids) as (queries, k), filled up with -inf; and how many pairs of points were scored.

    Values are whole numbers: as float64 where sums of products are exact, else
    as Python's integers (object arrays). Trees and bounds are in floats, with
    room for rounding; scores and their order are exact.
    """
    none = np.iinfo(np.int64).max
    exact = queries.dtype == object
    scores, ids = np.full((len(queries), k), -np.inf, queries.dtype), np.full((len(queries), k), none)
    done = {"scored": 0, "pairs": len(queries) * len(data)}
    if not len(queries) or not len(data):
        return scores, ids, done

    def bound(q: Node, p: Node) -> float:
        top = float(q.centre @ p.centre) + q.radius * p.norm + p.radius * q.norm + q.radius * p.radius
        return top + 1e-9 * (abs(top) + q.norm * p.norm + 1)  # rounding may not prune

    # one common scale keeps the floats of very large integers in range; it changes no comparison
    shrink = max([1, *(abs(x) for side in (queries, data) for x in side.flat)]) if exact else 1
    scaled = [np.array([[x / shrink for x in line] for line in side], np.float64).reshape(side.shape) if exact else side for side in (queries, data)]
    first, second = _tree(scaled[0]), _tree(scaled[1])
    stack = [(bound(first, second), first, second)]
    while stack:
        top, q, p = stack.pop()
        worst = scores[q.rows, -1].min()
        if exact and worst != -np.inf:  # in two steps, as the square of the scale may be no float
            worst = float(Fraction(worst, shrink * shrink))
        if top < worst:
            continue
        if q.children and (not p.children or q.radius >= p.radius):
            stack.extend(sorted(((bound(c, p), c, p) for c in q.children), key=lambda x: x[0]))
        elif p.children:
            stack.extend(sorted(((bound(q, c), q, c) for c in p.children), key=lambda x: x[0]))
        else:
            got = queries[q.rows] @ data[p.rows].T
            done["scored"] += got.size
            names = np.broadcast_to(data_ids[p.rows], got.shape)
            got = np.where(names == query_ids[q.rows][:, None], -np.inf, got)
            lines = np.flatnonzero((got >= scores[q.rows, -1][:, None]).any(axis=1))
            if len(lines):
                at = q.rows[lines]
                names = np.where(got[lines] == -np.inf, none, names[lines])
                scores[at], ids[at] = _best(np.hstack([scores[at], got[lines]]), np.hstack([ids[at], names]), k)
    return scores, ids, done


def _group(k: int, scale: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["query"].to_numpy(bool)
        sides = []
        for part in (rows[asked], rows[~asked]):
            part = part.sort_values(["vec_id", "row"], kind="stable")
            dim = len(rows["v"].iloc[0])
            values = np.array(part["v"].tolist(), np.float64).reshape(len(part), dim)
            sides.append((values, part["vec_id"].to_numpy(np.int64), part["row"].to_numpy(np.int64)))
        (qv, qi, qr), (dv, di, _) = sides
        most = [float(np.abs(x).max()) * scale if x.size else 0.0 for x in (qv, dv)]
        if most[0] * most[1] * qv.shape[1] < _EXACT and max(most) < 2**40:
            qv, dv = np.floor(qv * scale), np.floor(dv * scale)
        else:
            qv, dv = (np.array([[_integer(x, scale) for x in line] for line in side], object).reshape(side.shape) for side in (qv, dv))
        scores, ids, _ = dual_tree_topk(qv, qi, dv, di, k)
        line, place = np.nonzero(scores != -np.inf)
        whole = [int(x) for x in scores[line, place]]
        held = np.array([max(-_LONG - 1, min(_LONG, x)) for x in whole], np.int64)
        return pd.DataFrame({"row": qr[line], "query_id": qi[line], "vec_id": ids[line, place], "score": held, "place": pd.Series([_sortable(x) for x in whole], dtype=object)})

    return run


_COMPLEMENT = str.maketrans("0123456789", "9876543210")


def _sortable(x: int) -> str:
    """A text in whose order integers of any size stand: sign, length, digits."""
    digits = str(abs(x))
    return f"1{len(digits):06d}{digits}" if x >= 0 else f"0{999_999 - len(digits):06d}{digits.translate(_COMPLEMENT)}"


def _integer(x: float, scale: int) -> int:
    """floor(scale * x) of a finite x, also where the product is no float."""
    return int(x) * scale if abs(x) > 2.0**900 else math.floor(x * scale)


def top_k(
    vectors: DataFrame,
    k: int = 10,
    every: int = 100,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_block: int = QUERY_BLOCK,
    data_block: int = DATA_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the k best of all other rows.

    Components become floor(scale * x); the score is their exact inner product,
    shown as the nearest long where it is out of a long's range; ranks are by
    the exact one. Ties go to the smaller id. Rows with a null id, a
    null vector, or a null or non-finite component take no part. Only vectors
    of equal length are compared. A row with the query's id is the query's own;
    a repeated query row is answered again, and repeated candidates each count.
    Other columns are ignored; an empty table gives none.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    raw = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))  # not a number counts as greater
    held = scratch.save("vectors", raw.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite))
    sampled = held.select("row", "v").orderBy(F.xxhash64("row"), "row").limit(SAMPLE).collect()
    n = held.count()
    pivots = _pivots([r["v"] for r in sampled], min(MOST_CELLS, max(1, -(-n // data_block))), scale)
    shared = spark.sparkContext.broadcast(pivots)  # SAMPLE vectors at most
    kind = "row long, vec_id long, v array<double>, dim int, cell int, away double"
    placed = scratch.save("placed", held.mapInArrow(tidy(_place(shared, scale)), kind))
    is_query = F.col("vec_id") % every == 0
    stats = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"), F.count(F.when(is_query, 1)).alias("nq"), F.max(F.when(is_query, F.col("away"))).alias("q_radius"))
    stats = scratch.save("stats", stats)
    # (dim, qcell, dcell, top, nth): bounds of all pairs of a length's cells, MOST_CELLS squared at most for each sampled length
    tops = spark.createDataFrame(_bounds(pivots, stats.filter(F.col("dim").isin(list(pivots))).collect()), "dim int, qcell int, dcell int, top double, nth int")
    rest = stats.filter(~F.col("dim").isin(list(pivots))).select("dim", F.lit(0).alias("qcell"), F.lit(0).alias("dcell"), F.lit(float("inf")).alias("top"), F.lit(1).alias("nth"))
    tops = scratch.save("tops", tops.unionByName(rest))
    cut = lambda count, size: F.greatest(F.lit(1), F.ceil(F.col(count) / F.lit(size))).cast("int")
    sub = lambda parts: F.pmod(F.xxhash64("row"), F.col(parts)).cast("int")
    parts = stats.select("dim", "cell", cut("n", data_block).alias("parts"), cut("nq", query_block).alias("q_parts"))
    blocked = scratch.save("blocked", placed.drop("away").join(parts, ["dim", "cell"]).withColumns({"dsub": sub("parts"), "qsub": sub("q_parts")}).drop("parts", "q_parts"))
    queries = blocked.filter(is_query).select("row", "vec_id", "v", "dim", F.col("cell").alias("qcell"), "qsub")
    data = blocked.select("row", "vec_id", "v", "dim", F.col("cell").alias("dcell"), "dsub")
    subs = parts.select("dim", F.col("cell").alias("dcell"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("dsub"))
    groups = queries.select("dim", "qcell", "qsub").distinct()
    result = "row long, query_id long, vec_id long, score long, place string"

    def searched(pairs: DataFrame, name: str) -> DataFrame:
        """The k best of each query in each of the pairs (dim, qcell, qsub, dcell, dsub)."""
        pairs = scratch.save(f"{name}-pairs", pairs)
        key = ["dim", "qcell", "qsub", "dcell", "dsub"]
        asked = queries.join(pairs, ["dim", "qcell", "qsub"]).select("row", "vec_id", "v", F.lit(True).alias("query"), *key)
        given = data.join(pairs, ["dim", "dcell", "dsub"]).select("row", "vec_id", "v", F.lit(False).alias("query"), *key)
        return scratch.save(name, asked.unionByName(given).groupBy(*key).applyInPandas(_group(k, scale), result))

    favoured = tops.filter("nth = 1").select("dim", "qcell", "dcell", F.lit(0).alias("dsub"))
    first = searched(groups.join(favoured, ["dim", "qcell"]), "first")
    # a query with fewer than k, or whose kth score is below the range of a long, has no kth score yet
    kth = first.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("s")).select("row", F.when((F.col("n") == k) & (F.col("s") > -_LONG - 1), F.col("s").cast("double")).alias("s"))
    worst = queries.select("row", "dim", "qcell", "qsub").join(kth, "row", "left").groupBy("dim", "qcell", "qsub").agg(F.min("s").alias("worst"), F.count("*").alias("asked"), F.count("s").alias("known"))
    every_pair = worst.join(tops, ["dim", "qcell"]).filter("known < asked OR NOT (top < worst)").join(subs, ["dim", "dcell"])
    more = every_pair.select("dim", "qcell", "qsub", "dcell", "dsub", "nth").filter("NOT (nth = 1 AND dsub = 0)").drop("nth")
    best = first.unionByName(searched(more, "more"))
    order = Window.partitionBy("row").orderBy(F.desc("place"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
