"""Benchmark decontamination: a prefix-filtered set join of item windows with documents.

A window's tokens are its ``token``-word shingles. A document holds the window
only if it holds all of them, so one token is a sufficient prefix: the rarest
in the corpus, by counts over all documents. Where a document has a window's
prefix token, the token's place in the window gives the only possible start;
the start and the length must lie in the document (positional and length
bounds), and the words there must equal the window's (verification).

The benchmark is searched in blocks of about ``block_windows`` windows, so the
index that each pass collects and broadcasts is bounded, and a very long item
is cut into parts that share no window and fall into several blocks; each pass
adds its findings to the rows and nothing is shuffled but counts.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.llm.scratch import Scratch, modest_batches
from mergestone.llm.words import WordHashes, alnum_words, shingles
from mergestone.llm.worker import tidy

WINDOW, TOKEN, BLOCK_WINDOWS = 10, 3, 200_000
#: Windows of a part of an item, at most.
PART = 2000
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Runs of ``size`` words; the whole if shorter; none of no words."""
    width = min(size, len(words))
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []


def _tokens(window: tuple[bytes, ...], token: int, hashes: WordHashes) -> np.ndarray:
    return shingles(hashes.of(list(window)), token)


def _counter(wanted, token: int):
    """Counts, for each wanted token, its places in the documents of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (widths, keys) = WordHashes(), wanted.value
        counts = np.zeros(len(keys), np.int64)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                words = hashes.of(alnum_words(text or b""))
                for width in widths:
                    if len(words) >= width:
                        got = shingles(words, width)
                        at = np.searchsorted(keys, got)
                        at[at == len(keys)] = 0
                        np.add.at(counts, at[keys[at] == got], 1)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(keys[seen].view(np.int64)), pa.array(counts[seen])], names=["token", "n"])

    return run


def _search(index):
    """Adds to each row the spans and items of the index's windows in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, (widths, keys, places, windows) = WordHashes(), index.value
        for batch in batches:
            spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for row, text in enumerate(texts):
                words = alnum_words(text or b"")
                hashed = hashes.of(words)
                for width in widths:
                    if len(words) < width or not len(keys):
                        continue
                    got = shingles(hashed, width)
                    at = np.searchsorted(keys, got)
                    at[at == len(keys)] = 0
                    for place in np.flatnonzero(keys[at] == got).tolist():
                        for offset, number in places[at[place]]:
                            window, names = windows[number]
                            first = place - offset
                            if first >= 0 and first + len(window) <= len(words) and tuple(words[first : first + len(window)]) == window:
                                spans[row].append({"first": first, "last": first + len(window) - 1})
                                items[row].extend(names)
                if spans[row]:
                    spans[row], items[row] = _merged(spans[row]), sorted(set(items[row]))
            keep = batch.schema.names.index("spans")
            columns = [batch.column(i) for i in range(keep)] + [pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for span in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if out and span["first"] <= out[-1]["last"] + 1:
            out[-1]["last"] = max(out[-1]["last"], span["last"])
        else:
            out.append(dict(span))
    return out


def _parts(window: int):
    """Items as parts of words between spaces, and the windows of each; together the parts have every window once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, parts, counts = [], [], []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                words = alnum_words(text or b"")
                total = max(1, len(words) - window + 1) if words else 0
                for start in range(0, total, PART):
                    items.append(item)
                    parts.append(b" ".join(words[start : start + PART + window - 1]).decode())
                    counts.append(min(PART, total - start))
            yield pa.RecordBatch.from_arrays([pa.array(items, batch.column("item").type), pa.array(parts, pa.string()), pa.array(counts, pa.int64())], names=["item", "text", "n"])

    return run


def _index(spark, documents: DataFrame, items: list, window: int, token: int):
    """The broadcast index of a block of items: prefix tokens, and where they stand in which windows."""
    names: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    for item, text in items:
        for w in windows_of(alnum_words(text.encode()), window):
            names[w].add(str(item))
    hashes, order = WordHashes(), sorted(names)
    tokens = [_tokens(w, token, hashes) for w in order]
    widths = sorted({min(token, len(w)) for w in order})
    keys = np.unique(np.concatenate(tokens)) if tokens else np.empty(0, np.uint64)
    counts: dict[int, int] = {}
    if len(keys):
        wanted = spark.sparkContext.broadcast((widths, keys))
        counted = documents.select("text").mapInArrow(tidy(_counter(wanted, token)), "token long, n long")
        counts = {r["token"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).toLocalIterator()}
    prefix: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for number, own in enumerate(tokens):
        offset = min(range(len(own)), key=lambda i: (counts.get(int(own[i]), 0), int(own[i]), i))
        if counts.get(int(own[offset]), 0):  # a token that no document has excludes its window
            prefix[int(own[offset])].append((offset, number))
    held = np.array(sorted(prefix), np.uint64)
    return spark.sparkContext.broadcast((widths, held, [prefix[int(k)] for k in held], [(w, sorted(names[w])) for w in order]))


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    token: int = TOKEN,
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """(id_col, text, spans, items): for each document row the merged word spans (from 0, both ends in) of benchmark
    windows in it, and the ids, as strings in order, of items with a window in it.

    Null and wordless texts have no words and no spans; null and wordless items
    no windows. An item without an id can't be named and takes no part; rows
    that repeat an item id add windows to it. Rows that repeat a document, or
    lack an id, are each answered. Very long texts and items are read whole.
    Other columns are ignored, empty tables give no rows or no spans.
    """
    spark = documents.sparkSession
    modest_batches(spark)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    items = items.filter("item IS NOT NULL AND text IS NOT NULL").distinct()
    parts = items.mapInArrow(tidy(_parts(window)), f"item {items.schema['item'].dataType.simpleString()}, text string, n long")
    total = parts.agg(F.sum("n").alias("n")).first()["n"] or 0
    blocks = max(1, -(-int(total) // block_windows))
    out = docs.withColumns({"spans": F.expr("CAST(array() AS array<struct<first:long,last:long>>)"), "items": F.expr("CAST(array() AS array<string>)")})
    scratch = Scratch(spark, "leaks") if blocks > 1 else None
    for k in range(blocks):
        part = parts if blocks == 1 else parts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        index = _index(spark, docs, [(r["item"], r["text"]) for r in part.toLocalIterator()], window, token)
        out = out.mapInArrow(tidy(_search(index)), out.schema)
        if scratch:
            out = scratch.save(f"block-{k}", out)
            if k:
                scratch.drop(f"block-{k - 1}")
    return out.select(F.col("id").alias(id_col), F.col("text"), "spans", "items")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
        hit = [sum(s["last"] - s["first"] + 1 for s in x) for x in spans]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array([len(alnum_words(t or b"")) for t in texts], pa.int64()),
                pa.array(hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]),
                pa.array([n > 0 for n in hit]),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def digest(found: DataFrame) -> DataFrame:
    """contamination()'s rows as (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    kind = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return found.mapInArrow(tidy(_digest), kind)


ORACLE_SQL = r"""
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
b AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE item_id IS NOT NULL),
windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS k, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS win
    FROM b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
widths AS (SELECT DISTINCT k FROM windows),
runs AS (
    SELECT r, i, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
    FROM d, widths, unnest(range(1, len(w) - k + 2)) AS t(i)),
hits AS (SELECT r, i, runs.k, item FROM runs JOIN windows ON runs.k = windows.k AND runs.win = windows.win),
places AS (SELECT r, count(DISTINCT i + j) AS n_hit FROM hits, unnest(range(0, k)) AS t(j) GROUP BY r),
named AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN named USING (r)
"""


def without_leaks(documents: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of documents, with all their columns, that hold no window of the benchmark."""
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), F.col(text_col).alias("text"))
    found = contamination(packed, benchmark, id_col="row")
    return found.filter(F.size("spans") == 0).select("row.*")
