"""Near-duplicate documents: SuperMinHash signatures, banding, exact verification, union-find grouping.

A document's set holds its distinct word shingles, as 64-bit hashes. Rows with
equal sets become one node first, so a thousand exact copies cost one
signature in the search. SuperMinHash gives each element a random permutation
of the signature's places, walked place by place with growing ranks, and stops
when no later rank can win; the places are then filled without replacement,
which lowers the variance against independent minima. 40 bands of 5 rows miss
a pair at similarity 0.8 with probability 1.3e-7.

In a band's bucket each node is compared with the smallest one (a star, not all
pairs). Components follow, and a second search compares only those pairs of a
bucket that are still in different components, so no link that could join two
groups is left out; in large buckets an exact prefix filter finds them without
a square of pairs. Both searches drop pairs whose sizes exclude the
threshold, then those whose signatures agree in clearly too few places (six
standard deviations below it), and confirm the rest on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestone.llm.components import components, contract
from mergestone.llm.scratch import Scratch
from mergestone.llm.worker import tidy
from mergestone.llm.words import GOLDEN, WordHashes, mix, shingle_set

BANDS, ROWS = 40, 5
#: Places of a signature that must agree, as a share: over six standard deviations below 0.8.
LEAST_AGREEMENT = 0.62
#: Members up to which a bucket's remaining pairs are compared directly; larger ones go through the prefix-filtered join.
SMALL = 50
#: Elements handled together; bounds the permutations held by a worker to about 30 MB.
CHUNK = 150_000
#: Ids that are broadcast at most, about 30 MB; more are joined by a shuffle.
MOST_BROADCAST = 500_000
#: Bits of the filter of wanted documents: 8 MB whatever the input; a full filter only lets more rows pass.
FILTER_BITS = 1 << 26
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LOW = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def superminhash(elements: np.ndarray, owner: np.ndarray, n: int, places: int, seed: int = 1) -> np.ndarray:
    """Signatures of n sets, as (n, places) of rank << 32 | random; a set without elements keeps the top value.

    ``owner`` says which set each element belongs to. Step j deals every
    element's j-th place; sets whose places are all filled stop there, as later
    steps have higher ranks.
    """
    sig = np.full(n * places, _EMPTY)
    base = owner.astype(np.int64) * places
    elements = mix(elements + np.uint64(seed * GOLDEN & 0xFFFFFFFFFFFFFFFF))
    draw = mix(elements + np.uint64(GOLDEN))
    pick = ((draw >> _32) * np.uint64(places) >> _32).astype(np.int64)
    np.minimum.at(sig, base + pick, draw & _LOW)
    open_sets = sig.reshape(n, places).max(axis=1) == _EMPTY
    keep = open_sets[owner]
    if not keep.any():
        return sig.reshape(n, places)
    elements, base, owner, pick = elements[keep], base[keep], owner[keep], pick[keep]
    order = np.tile(np.arange(places, dtype=np.uint8 if places <= 256 else np.uint16), (len(elements), 1))
    rows = np.arange(len(elements))
    order[rows, pick] = 0  # the first place and the picked one change places
    for j in range(1, places):
        draw = mix(elements + np.uint64((j + 1) * GOLDEN & 0xFFFFFFFFFFFFFFFF))
        pick = j + ((draw >> _32) * np.uint64(places - j) >> _32).astype(np.int64)
        place = order[rows, pick].astype(np.int64)
        order[rows, pick] = order[rows, j]
        np.minimum.at(sig, base + place, np.uint64(j << 32) | (draw & _LOW))
        live = np.unique(owner)
        full = sig.reshape(n, places)[live].max(axis=1) != _EMPTY
        if full.all():
            break
        if full.any():
            closed = np.zeros(n, bool)
            closed[live[full]] = True
            keep = ~closed[owner]
            elements, base, owner, order = elements[keep], base[keep], owner[keep], order[keep]
            rows = np.arange(len(elements))
    return sig.reshape(n, places)


def _bands(sig: np.ndarray, bands: int) -> np.ndarray:
    """(n, bands) keys; a band's number is part of its key."""
    parts = sig.reshape(len(sig), bands, -1)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for r in range(parts.shape[2]):
        key = mix(key * np.uint64(3) + parts[:, :, r])
    return key.view(np.int64)


def _features(shingle: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def flush(ids: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            sizes = np.array([len(s) for s in sets], np.int64)
            flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            owner = np.repeat(np.arange(len(sets)), sizes)
            sig = superminhash(flat, owner, len(sets), bands * rows)
            one, two = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
            if len(flat):
                filled = np.flatnonzero(sizes)
                starts = (np.cumsum(sizes) - sizes)[filled]
                one[filled] = np.add.reduceat(mix(flat + np.uint64(GOLDEN)), starts)
                two[filled] = np.add.reduceat(mix(flat ^ np.uint64(GOLDEN)), starts)
            keys = _bands(sig, bands)
            short = np.ascontiguousarray((mix(sig) & np.uint64(0xFF)).astype(np.uint8))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(sizes),
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    pa.array(list(keys), pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in short], pa.binary()),
                ],
                names=["id", "n", "f1", "f2", "bands", "sig"],
            )

        for batch in batches:
            ids, sets, held = [], [], 0
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                ids.append(i)
                sets.append(shingle_set(text, shingle, hashes))
                held += len(sets[-1])
                if held >= CHUNK:
                    yield flush(ids, sets)
                    ids, sets, held = [], [], 0
            if ids:
                yield flush(ids, sets)

    return run


def _agree(least: float):
    """Keeps pairs (a, b) whose signatures agree in enough places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for c in ("sa", "sb")
            )
            same = (left == right).mean(axis=1) >= least
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(same))

    return run


def _confirm(shingle: int, percent: int):
    """Keeps pairs (a, b) whose full sets have 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            kept, last, left = [], None, None
            ta, tb = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("ta", "tb"))
            for x, y in zip(ta, tb):
                if left is None or x != last:
                    last, left = x, shingle_set(x, shingle, hashes)
                right = shingle_set(y, shingle, hashes)
                both = len(np.intersect1d(left, right, assume_unique=True))
                kept.append(both > 0 and 100 * both >= percent * (len(left) + len(right) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b")], names=["a", "b"]
            ).filter(pa.array(kept, pa.bool_()))

    return run


def _slot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def _wanted(spark: SparkSession, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rows (id, text) of docs that some pair names, and few others: a fixed-size bit filter spares shuffling all texts."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).select((_slot("id") + 1).alias("s"))  # bitmaps count from 1
    bits = ids.groupBy(F.bitmap_bucket_number("s").alias("k")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")
    )
    mask = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in bits.toLocalIterator():
        start = (row["k"] - 1) * 4096
        mask[start : start + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    held = spark.sparkContext.broadcast(mask)

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("slot").to_numpy()
            hit = held.value[slot >> 3] >> (slot & 7) & 1
            yield batch.select(["id", "text"]).filter(pa.array(hit.astype(bool)))

    return docs.withColumn("slot", _slot("id")).mapInArrow(tidy(some), "id long, text string")


def _links(spark, docs, features, pairs, shingle: int, percent: int, scratch: Scratch, name: str, agreement: float = LEAST_AGREEMENT) -> DataFrame:
    """Of candidate pairs (a, b), those that are links, verified on full sets."""
    sized = features.select("id", "n", "sig")
    a = sized.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sig").alias("sa"))
    b = sized.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sig").alias("sb"))
    near = (
        pairs.join(a, "a")
        .join(b, "b")
        .filter(F.lit(100) * F.least("na", "nb") >= F.lit(percent) * F.greatest("na", "nb"))
        .select("a", "b", "sa", "sb")
        .mapInArrow(tidy(_agree(agreement * percent / 80)), "a long, b long")
    )
    near = scratch.save(f"{name}-near", near.distinct())
    texts = scratch.save(f"{name}-texts", _wanted(spark, docs, near))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    sure = near.join(left, "a").join(right, "b").mapInArrow(tidy(_confirm(shingle, percent)), "a long, b long")
    links = scratch.save(f"{name}-links", sure)
    scratch.drop(f"{name}-near", f"{name}-texts")
    return links


def _slots(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(46)).astype(np.int64)  # 2^18 counters


def _tally(shingle: int):
    """How many documents have each shingle, by counter of a fixed-size table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = WordHashes(), np.zeros(1 << 18, np.int64)
        for batch in batches:
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                np.add.at(counts, _slots(shingle_set(text, shingle, hashes)), 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["slot", "n"])

    return run


def _prefixes(shingle: int, percent: int, counts):
    """The rarest shingles of each set, as many as any partner must share one of, with their places in that order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            ids, tokens, places, sizes = [], [], [], []
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                own = shingle_set(text, shingle, hashes)
                length = len(own) - -(-percent * len(own) // 100) + 1
                ranked = own[np.lexsort((own, counts.value[_slots(own)]))][:length]
                ids.append(np.full(len(ranked), i, np.int64))
                tokens.append(ranked.view(np.int64))
                places.append(np.arange(len(ranked)))
                sizes.append(np.full(len(ranked), len(own), np.int64))
            flat = [np.concatenate(x) if x else np.empty(0, np.int64) for x in (ids, tokens, places, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in flat], names=["id", "token", "p", "n"])

    return run


def _crowded(spark, docs: DataFrame, crowd: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of crowd (id, n, c) with different c that may be links: a prefix-filtered join.

    A large bucket holds a group of near copies and texts that are only rather
    like them; comparing those with every copy would be a square. Two sets can
    be links only if they share one of their rarest shingles, early enough in
    both orders for the rest to reach the threshold. What a group has in common
    is frequent in it, so texts with many shingles of their own meet no copy.
    """
    texts = scratch.save("crowd-texts", _wanted(spark, docs, crowd.select(F.col("id").alias("a"), F.col("id").alias("b"))).join(crowd.select("id").distinct(), "id", "left_semi"))
    table = np.zeros(1 << 18, np.int64)
    for row in texts.mapInArrow(tidy(_tally(shingle)), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toLocalIterator():
        table[row["slot"]] = row["n"]
    counts = spark.sparkContext.broadcast(table)  # 2 MB whatever the input
    tokens = texts.mapInArrow(tidy(_prefixes(shingle, percent, counts)), "id long, token long, p long, n long").join(crowd.select("id", "c").distinct(), "id")
    left = scratch.save("crowd-tokens", tokens).withColumnRenamed("id", "a")
    right = left.select(F.col("a").alias("b"), "token", F.col("p").alias("q"), F.col("n").alias("o"), F.col("c").alias("d"))
    fits = F.expr(f"c < d AND 100 * least(n, o) >= {percent} * greatest(n, o) AND {100 + percent} * least(n - p, o - q) >= {percent} * (n + o)")
    return left.join(right, (left["token"] == right["token"]) & fits).select("a", "b")


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    percent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    exact: bool = False,
) -> DataFrame:
    """(id_col, n_shingles, component_id, kept), one row for each input row.

    Two documents are linked if 100 * intersection >= percent * union of their
    sets of ``shingle``-word shingles (words between ASCII white space, A-Z
    folded; a shorter text is one shingle). component_id is the smallest id that
    links reach. Null and blank texts have no shingles and no links. Rows that
    share an id are one document, linked if any of their texts is. A row without
    an id can't be named: it takes no part, has a null component and is kept.
    Very long texts are read whole; a worker holds one text's set beside the
    chunk it fills. Other columns are ignored, whatever their names; an empty
    table gives none.

    With ``exact`` candidates come from the prefix-filtered join alone, over all
    distinct sets, so no link is left to chance; it costs more on corpora with
    many frequent shingles. Otherwise a bucket's pairs that are still apart are
    compared one by one up to ``SMALL`` members and by the prefix-filtered join
    above; both find every pair of the bucket.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "neardup")
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = "id long, n long, f1 long, f2 long, bands array<long>, sig binary"
    features = scratch.save("features", docs.mapInArrow(tidy(_features(shingle, bands, rows)), schema))

    # equal sets are one node, named by its smallest id
    named = features.filter("n > 0 AND id IS NOT NULL")
    # written before the join, so that the join deals both sides anew and a very large group of copies can be split
    nodes = scratch.save("nodes", named.groupBy("f1", "f2", "n").agg(F.min("id").alias("node")))
    member = scratch.save("member", named.select("id", "f1", "f2", "n").join(nodes, ["f1", "f2", "n"]).select("id", "node"))
    scratch.drop("nodes")
    by_id = member.filter("id <> node").select(F.col("node").alias("a"), F.col("id").alias("b"))  # ids with several texts, too
    first = member.filter("id = node").select("id").distinct()
    if exact:
        alone = named.select("id", "n").join(first, "id", "left_semi").select("id", "n", F.col("id").alias("c")).distinct()
        pairs = _crowded(spark, docs, scratch.save("crowd", alone), shingle, percent, scratch).distinct()
        links = _links(spark, docs, features, pairs, shingle, percent, scratch, "all", agreement=0.0)
    else:
        links = _banded(spark, docs, features, first, shingle, percent, scratch)
    final = scratch.save("final", components(links.unionByName(by_id), scratch, "cc2"))
    found = features.select("id", "n").join(final.withColumnRenamed("node", "id"), "id", "left")
    found = scratch.save("found", found.select("id", "n", F.coalesce("component", "id").alias("component")))
    scratch.keep_only("found")
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _banded(spark: SparkSession, docs: DataFrame, features: DataFrame, first: DataFrame, shingle: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) with the components that all links among pairs that share a band give; first: (id) of the nodes."""
    # (key, id) alone is dealt out, as a document has as many rows as bands; sizes join the pairs that remain
    exploded = features.filter("n > 0").select("id", "bands").join(first, "id", "left_semi").select("id", F.explode("bands").alias("key"))
    exploded = scratch.save("exploded", exploded)
    centres = exploded.groupBy("key").agg(F.min("id").alias("centre"), F.count("*").alias("size")).filter("size > 1")
    shared = scratch.save("shared", exploded.join(scratch.save("centres", centres), "key"))
    scratch.drop("exploded", "centres")
    stars = shared.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    links = _links(spark, docs, features, stars, shingle, percent, scratch, "star")
    group = scratch.save("groups", components(links, scratch, "cc1"))

    # pairs of a bucket that are still apart
    placed = shared.join(group.select(F.col("node").alias("id"), "component"), "id", "left")
    placed = scratch.save("placed", placed.select("key", "id", "size", F.coalesce("component", "id").alias("c")))
    mixed = placed.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y")).filter("x <> y").select("key")
    sizes = features.filter("n > 0").select("id", "n")
    apart = placed.join(scratch.save("mixed", mixed), "key").join(sizes, "id").select("key", "id", "n", "size", "c")
    apart = scratch.save("apart", apart)
    scratch.drop("placed", "mixed")
    close = F.expr(f"c < d AND 100 * least(n, o) >= {percent} * greatest(n, o)")
    few = apart.filter(F.col("size") <= SMALL).select("key", F.col("id").alias("a"), "n", "c")
    others = few.select("key", F.col("a").alias("b"), F.col("n").alias("o"), F.col("c").alias("d"))
    pairs = few.join(others, (few["key"] == others["key"]) & close).select("a", "b")
    crowd = apart.filter(F.col("size") > SMALL).select("id", "n", "c").distinct()
    pairs = pairs.unionByName(_crowded(spark, docs, scratch.save("crowd", crowd), shingle, percent, scratch)).distinct()
    known = shared.select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b"))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(known, ["a", "b"], "left_anti")
    more = _links(spark, docs, features, pairs, shingle, percent, scratch, "rest")
    return group.filter("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more.select("a", "b"))


def one_of_each(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of documents, with all their columns, whose id is the smallest of its group of near-duplicates.

    Rows that repeat an id are one document: the row with the first text in
    order stays, of equal texts the first by a hash of the row. Rows without an
    id all stay, and so do null and blank texts.
    """
    found = near_duplicates(documents, id_col, text_col, shingle, percent)
    gone = found.filter(~F.col("kept")).select(F.col(id_col)).distinct()
    if gone.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST:  # then whole texts need not be shuffled
        gone = F.broadcast(gone)
    left = documents.join(gone, id_col, "left_anti").select(*documents.columns)
    repeated = found.groupBy(id_col).agg(F.count("*").alias("n")).filter(F.col(id_col).isNotNull() & (F.col("n") > 1)).select(id_col)
    if repeated.isEmpty():
        return left
    # one partial aggregation, however often an id is repeated
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    once = left.join(repeated, id_col, "left_semi").groupBy(id_col).agg(F.min_by(row, F.struct(text_col, F.xxhash64(*[F.col(f"`{c}`") for c in documents.columns]))).alias("_row")).select("_row.*")
    return left.join(repeated, id_col, "left_anti").select(*documents.columns).unionByName(once)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sized AS (SELECT doc_id, s, n FROM shingles JOIN sizes USING (doc_id)),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total, count(*) AS c FROM sized a JOIN sized b
    ON a.s = b.s AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT x, y FROM shared WHERE 100 * c >= 80 * (total - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT x AS doc_id, y AS other FROM edges UNION SELECT reach.doc_id, edges.y FROM reach JOIN edges ON edges.x = reach.other),
least_of AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, least(doc_id, coalesce(m, doc_id)) = doc_id AS kept
FROM d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""
