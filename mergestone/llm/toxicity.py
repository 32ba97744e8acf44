"""Toxicity by a classifier chain.

Categories are predicted one after the other. Each category has a linear model
over hashed words and word beginnings; a later one also sees the probabilities
of the categories before it. For training these are predictions out of fold,
made by models that had not seen the row, as they will be for new rows; the
models that are kept are fitted on all sampled rows.

The sample is bounded: at most ``per_class`` rows with and ``per_class``
without the last category, taken in order of a hash of the id. All documents
are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergestone.llm.linear import apply_logistic, fit_logistic, unpacked
from mergestone.llm.scratch import modest_batches
from mergestone.llm.words import alnum_words
from mergestone.llm.worker import tidy

BITS = 20
#: Bytes of a word's beginnings that are features, besides the whole word.
STARTS = (4, 5, 6)
PER_CLASS, CHOSEN, FOLDS = 3000, 256, 5
#: A feature must be this many times as frequent with the category as without it.
LIFT = 5.0
#: Words that give the weak categories of a labels table that knows only toxic; fixed values, not a model.
INSULT = ("clown", "idiot", "loser", "moron", "scum", "stupid")
CONTEMPT = ("disgusting", "pathetic", "trash", "worthless")
#: The same in more words, and in French, German and Spanish.
MORE_INSULT = (
    "ass", "bastard", "coward", "creep", "dumb", "fool", "freak", "imbecile", "jerk", "liar", "pig", "rat",
    "abruti", "connard", "crétin", "débile", "imbécile", "salaud", "blödmann", "depp", "dummkopf", "idiotin", "schwein", "trottel",
    "cretino", "estúpido", "idiota", "imbécil", "payaso", "tonto",
)
MORE_CONTEMPT = (
    "filth", "filthy", "garbage", "hopeless", "hateful", "miserable", "repulsive", "ridiculous", "rubbish", "shameful", "sickening", "useless", "vile", "vermin",
    "dégoûtant", "lamentable", "minable", "ordure", "pathétique", "abschaum", "ekelhaft", "erbärmlich", "müll", "wertlos",
    "asqueroso", "basura", "inútil", "patético",
)
CATEGORIES = ("insult", "contempt", "toxic")


class _Features(dict):
    """Hashed features of each word; forgets all at a bound."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= 300_000:
            self.clear()
        self[word] = out = _hashed(word)
        return out

    def of(self, text: bytes | None) -> np.ndarray:
        """Distinct features of a whole text."""
        words = set(alnum_words(text or b""))
        return np.unique(np.fromiter(chain.from_iterable(map(self.__getitem__, words)), np.int64))


@dataclass
class Link:
    """One category's model: its features, then the earlier categories, then the intercept."""

    name: str
    chosen: np.ndarray
    weights: np.ndarray


@dataclass
class Chain:
    links: list[Link]
    threshold: float

    def predict(self, texts: list[bytes | None], words: "_Chosen | None" = None) -> np.ndarray:
        """Probabilities as (texts, categories)."""
        words = _Chosen(self) if words is None else words
        x = np.zeros((len(texts), len(words.used)))
        for i, text in enumerate(texts):
            own = set().union(*map(words.__getitem__, set(alnum_words(text or b""))))
            if own:
                x[i, list(own)] = 1
        out = np.zeros((len(texts), len(self.links)))
        for k, link in enumerate(self.links):
            at = np.searchsorted(words.used, link.chosen)
            out[:, k] = apply_logistic(np.hstack([x[:, at], out[:, :k]]), link.weights)
        return out


class _Chosen(dict):
    """Of each word's features, the places of those that some model of a chain uses; most words have none."""

    def __init__(self, model: Chain) -> None:
        super().__init__()
        self.used = np.unique(np.concatenate([x.chosen for x in model.links]))
        self.place = {int(f): i for i, f in enumerate(self.used)}

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= 80_000:
            self.clear()
        self[word] = out = tuple(self.place[f] for f in _hashed(word) if f in self.place)
        return out


def _hashed(word: bytes) -> tuple[int, ...]:
    parts = [word] + [b"^" + word[:n] for n in STARTS if len(word) > n]
    return tuple(xxhash.xxh3_64_intdigest(p) >> 64 - BITS for p in parts)


def _dense(sparse: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """1 where a row has a chosen feature; chosen is in order."""
    x = np.zeros((len(sparse), len(chosen)))
    if len(chosen):
        for i, own in enumerate(sparse):
            at = np.searchsorted(chosen, own)
            at[at == len(chosen)] = 0
            x[i, at[chosen[at] == own]] = 1
    return x


def _choose(sparse: list[np.ndarray], y: np.ndarray, most: int = CHOSEN) -> np.ndarray:
    """Features much more frequent with the category than without, the surest first, then in order."""
    counts = [np.bincount(np.concatenate([sparse[i] for i in np.flatnonzero(y == v)] or [np.empty(0, np.int64)]), minlength=1 << BITS) for v in (1, 0)]
    p, n = int((y == 1).sum()), int((y == 0).sum())
    if not p or not n:
        return np.empty(0, np.int64)
    a, b = counts[0] + 0.5, counts[1] + 0.5
    rate_a, rate_b = a / (p + 1), b / (n + 1)
    sure = (np.log(rate_a) - np.log(rate_b)) / np.sqrt(1 / a + 1 / b)
    fit = np.flatnonzero((counts[0] >= 3) & (rate_a >= LIFT * rate_b))
    best = fit[np.lexsort((fit, -sure[fit]))][:most]
    return np.sort(best)


def fit_chain(texts: list[bytes | None], labels: np.ndarray, folds: np.ndarray, names: tuple[str, ...], l2: float = 0.1) -> Chain:
    """``fit_features`` of the texts' features."""
    words = _Features()
    return fit_features([words.of(t) for t in texts], labels, folds, names, l2)


def fit_features(sparse: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, names: tuple[str, ...], l2: float = 0.1) -> Chain:
    """Fits the chain on rows of features; labels is (rows, categories) of 0 and 1, folds says which fold holds each row out."""
    links, held_out = [], np.zeros(labels.shape)
    for k, name in enumerate(names):
        y = labels[:, k]

        def fit(rows: np.ndarray) -> Link:
            chosen = _choose([sparse[i] for i in rows], y[rows])
            x = np.hstack([_dense([sparse[i] for i in rows], chosen), held_out[rows, :k]])
            return Link(name, chosen, fit_logistic(x, y[rows], l2))

        for f in np.unique(folds):
            out, kept = np.flatnonzero(folds == f), np.flatnonzero(folds != f)
            if not len(kept):
                held_out[out, k] = y.mean()
                continue
            part = fit(kept)
            x = np.hstack([_dense([sparse[i] for i in out], part.chosen), held_out[out, :k]])
            held_out[out, k] = apply_logistic(x, part.weights)
        links.append(fit(np.arange(len(sparse))))
    return Chain(links, best_threshold(held_out[:, -1], labels[:, -1]) if len(sparse) else 0.5)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The middle of the widest gap of log odds among the cuts that err least on predictions out of fold."""
    if not len(y) or y.min() == y.max():
        return 0.5
    order = np.argsort(p, kind="stable")
    p, y = p[order], y[order]
    wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    z = np.log(np.clip(p, 1e-6, 1 - 1e-6) / np.clip(1 - p, 1e-6, 1))
    cuts = [i for i in range(1, len(p)) if p[i] > p[i - 1] and wrong[i] == wrong.min()]
    if not cuts:
        return 0.5
    i = max(cuts, key=lambda c: (z[c] - z[c - 1], -c))
    return float(1 / (1 + np.exp(-(z[i] + z[i - 1]) / 2)))


def weak_categories(toxic: Column, text: Column) -> dict[str, Column]:
    """The labels table knows only toxic; its rows that use one of the plain words also have that category."""
    found = lambda words: F.coalesce(F.lower(text).rlike(rf"(?U)\b(?:{'|'.join(words)})\b"), F.lit(False))
    return {
        "insult": (toxic & found(INSULT + MORE_INSULT)).cast("int"),
        "contempt": (toxic & found(CONTEMPT + MORE_CONTEMPT)).cast("int"),
        "toxic": toxic.cast("int"),
    }


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the features of each text, in place of the text."""
    words = _Features()
    for batch in batches:
        own = [words.of(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        rest = [i for i, n in enumerate(batch.schema.names) if n != "text"]
        columns = [batch.column(i) for i in rest] + [pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in rest), "features"])


def train(
    documents: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    per_class: int = PER_CLASS,
    category_cols: tuple[str, ...] = (),
) -> Chain:
    """A chain fitted on a bounded sample of labelled documents.

    ``category_cols`` name columns of labels (0 or 1, null as 0) that come
    before ``label_col`` in the chain; without them weak categories do. Labels
    without an id or a value, labels of no document and documents without text
    are left out; of several labels of an id the largest counts, of several
    texts of an id the first in order, so the model is repeatable. What comes to
    the driver of a sampled text is its hashed features. Without labels of both
    kinds nothing is toxic.
    """
    modest_batches(documents.sparkSession)
    given = labels.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"), *[F.coalesce(F.col(c).cast("int"), F.lit(0)).alias(f"c_{c}") for c in category_cols]
    )
    given = given.filter("id IS NOT NULL AND y IN (0, 1)").groupBy("id").agg(F.max("y").alias("y"), *[F.max(f"c_{c}").alias(f"c_{c}") for c in category_cols])
    order = (F.xxhash64("id"), "id")
    sample = given.filter("y = 1").orderBy(*order).limit(per_class).unionByName(given.filter("y = 0").orderBy(*order).limit(per_class))
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    own = docs.join(F.broadcast(sample), "id").groupBy(*sample.columns).agg(F.min("text").alias("text"))  # at most 2 * per_class ids
    if category_cols:
        names = (*category_cols, label_col)
        marked = own.withColumn(f"c_{label_col}", F.col("y")).select("id", "text", *[f"c_{k}" for k in names])
    else:
        names = CATEGORIES
        marked = own.select("id", "text", *[c.alias(f"c_{k}") for k, c in weak_categories(F.col("y") == 1, F.col("text")).items()])
    kind = "id long, " + ", ".join(f"c_{k} int" for k in names) + ", features array<int>"
    found = marked.mapInArrow(tidy(_sampled), kind).toArrow()  # numbers stay packed, rows of Python objects would take many times as much
    order = np.argsort(found["id"].to_numpy(), kind="stable")
    ids = found["id"].to_numpy()[order]
    folds = np.array([xxhash.xxh3_64_intdigest(str(i).encode()) % FOLDS for i in ids.tolist()], np.int64)
    y = np.stack([found[f"c_{k}"].to_numpy()[order].astype(np.float64) for k in names], axis=1)
    return fit_features(unpacked(found["features"], order), y, folds, names)


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model.value
        words = _Chosen(own)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                p = own.predict(part.column(1).cast(pa.binary()).to_pylist(), words)
                columns = [part.column(0), *(pa.array(p[:, k]) for k in range(p.shape[1])), pa.array(p[:, -1] >= own.threshold)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", *(f"p_{x.name}" for x in own.links), own.links[-1].name])

    return run


def toxicity(documents: DataFrame, model: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, p_<category> for each category, toxic), one row for each input row.

    Null and blank texts have no features and get the intercepts' probabilities.
    Very long texts are read whole. Null ids stay null, repeated rows are each
    answered, other columns are ignored, an empty table gives none.
    """
    modest_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = documents.sparkSession.sparkContext.broadcast(model)  # a few hundred weights for each category
    columns = ", ".join(f"p_{x.name} double" for x in model.links)
    kind = f"id {docs.schema['id'].dataType.simpleString()}, {columns}, {model.links[-1].name} boolean"
    return docs.mapInArrow(tidy(_score(held)), kind).withColumnRenamed("id", id_col)


def without_toxic(documents: DataFrame, model: Chain, text_col: str = "text") -> DataFrame:
    """The rows of documents, with all their columns, that the chain doesn't find toxic."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index(text_col)
    modest_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Chosen(held.value)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                p = held.value.predict(part.column(place).cast(pa.binary()).to_pylist(), words)
                yield part.filter(pa.array(p[:, -1] < held.value.threshold))

    return documents.mapInArrow(tidy(run), documents.schema)
