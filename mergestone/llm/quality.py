"""Quality classifier by weak labels.

Overlapping heuristics each vote bad, good or nothing on a document. How often
each pattern of votes occurs is counted over all documents; the number of
patterns is fixed by the number of heuristics. Expectation-maximisation over
those counts estimates each heuristic's accuracy and the share of good
documents, and so a posterior for each pattern. As what is bad about documents
comes in kinds, each of which other heuristics see, there is one class for good
documents and several for bad ones; a heuristic's accuracy on bad documents is
its rate over all of those. Posteriors of a bounded sample of documents then
train a linear scorer over hashed word shapes, which scores every document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.llm.linear import sigmoid, unpacked
from mergestone.llm.scratch import modest_batches
from mergestone.llm.worker import tidy

BAD, GOOD, NONE = 0, 1, 2
HEURISTICS = ("symbols", "capitals", "function_words", "bare_marks", "repeats", "exclamations", "word_length", "symbol_endings", "stutter", "few_words")
#: Frequent function words of the four languages.
FUNCTION_WORDS = frozenset(
    b"the of and to in is a that for on are with as by this be it or from at was an have not "
    b"le la les de des du et en un une est que qui dans pour par sur au aux avec ou pas "
    b"der die das und in zu den mit von ist auf im dem nicht ein eine als auch sich es "
    b"el los las y que en un una por con para al se del su lo".split()
)
SAMPLE, BITS = 6000, 12
#: Classes of documents that are tried at most; the Bayesian information criterion picks their number.
MOST_CLASSES = 8
#: Bounds of the measure of few words: below the first a vote for bad, above the second for good.
FEW = (0.6, 0.7)
_UPPER, _LOWER = bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B))
_ODD = b"%*$#&!|=<>~^_{}[]\\/@+`"
_PUNCTUATION = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum())
#: Letters become a, capitals A, digits 0; other characters stay.
_SHAPE = bytes(0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x30 if 0x30 <= b <= 0x39 else b for b in range(256))


class Flags(dict):
    """1 for a function word, 2 for a word of marks only, 4 for one that ends in a symbol, added up."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 60_000:
            self.clear()
        self[word] = out = (
            (word.strip(b".,;:!?").lower() in FUNCTION_WORDS)
            + 2 * (not word.translate(None, _PUNCTUATION))
            + 4 * (len(word) > 1 and word[-1:] in b"%*$#&=~^_")
        )
        return out


_FLAGS = Flags()


def measures(text: bytes) -> dict[str, float]:
    """What the heuristics look at, over the whole text."""
    words = text.split()
    n = len(words)
    if not n:
        return {"n": 0}
    count = lambda kind: len(text) - len(text.translate(None, kind))
    upper, lower = count(_UPPER), count(_LOWER)
    kinds = Counter(map(_FLAGS.__getitem__, words))
    share = lambda bit: sum(c for k, c in kinds.items() if k & bit) / n
    solid = sum(map(len, words))
    return {
        "n": n,
        "symbols": count(_ODD) / solid,
        "capitals": upper / max(1, upper + lower),
        "function_words": share(1),
        "bare_marks": share(2),
        "repeats": 1 - len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2) if n > 2 else 0.0,
        "exclamations": text.count(b"!!") / n,
        "word_length": solid / n,
        "stutter": sum(map(eq, words, words[1:])) / n,
        # Herdan's measure hardly depends on the length, as the share of distinct words does
        "few_words": math.log(max(2, len(set(words)))) / math.log(max(2, n)),
        "symbol_endings": share(4),
    }


def votes(text: bytes | None) -> tuple[int, ...]:
    """A vote of each heuristic; none on texts too short for it."""
    m = measures(text or b"")
    n = m["n"]
    if n < 3:
        return (NONE,) * len(HEURISTICS)
    pick = lambda bad, good: BAD if bad else GOOD if good else NONE
    return (
        pick(m["symbols"] > 0.08, m["symbols"] < 0.03),
        pick(m["capitals"] > 0.4, m["capitals"] < 0.2),
        pick(n >= 20 and m["function_words"] < 0.04, m["function_words"] > 0.12),
        pick(m["bare_marks"] > 0.15, n >= 8 and m["bare_marks"] < 0.02),
        pick(n >= 30 and m["repeats"] > 0.3, n >= 30 and m["repeats"] < 0.1),
        pick(m["exclamations"] > 0.1, n >= 20 and m["exclamations"] == 0),
        pick(m["word_length"] > 9 or m["word_length"] < 2.5, 3.5 <= m["word_length"] <= 7.5),
        pick(m["symbol_endings"] > 0.2, n >= 8 and m["symbol_endings"] < 0.05),
        pick(n >= 10 and m["stutter"] > 0.2, n >= 10 and m["stutter"] < 0.05),
        pick(n >= 50 and m["few_words"] < FEW[0], n >= 50 and m["few_words"] > FEW[1]),
    )


@dataclass
class VoteModel:
    """share[c]: of documents in class c; caught[c, k]: rate of the vote bad among heuristic k's votes on them; bad[c]."""

    share: np.ndarray
    caught: np.ndarray
    bad: np.ndarray

    @property
    def prior(self) -> float:
        """Share of good documents."""
        return float(self.share[~self.bad].sum())

    @property
    def chance(self) -> np.ndarray:
        """[k, y, v]: the chance of heuristic k's vote v on documents of quality y, if it votes."""
        out = np.empty((self.caught.shape[1], 2, 2))
        for y, own in ((BAD, self.bad), (GOOD, ~self.bad)):
            weight = self.share * own
            rate = weight @ self.caught / weight.sum() if weight.sum() > 0 else np.full(len(out), 0.5)
            out[:, y, BAD], out[:, y, GOOD] = rate, 1 - rate
        return out

    def joint(self, patterns: np.ndarray) -> np.ndarray:
        """(patterns, classes): log of share times the chance of the votes; NONE says nothing."""
        votes_bad, votes_good = (patterns == BAD).astype(float), (patterns == GOOD).astype(float)
        return np.log(self.share) + votes_bad @ np.log(self.caught).T + votes_good @ np.log1p(-self.caught).T

    def classes(self, patterns: np.ndarray) -> np.ndarray:
        """Posterior of each class."""
        log = self.joint(patterns)
        p = np.exp(log - log.max(axis=1, keepdims=True)) if len(log) else log
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of good for each line of votes."""
        return self.classes(patterns) @ (~self.bad)


def _fit(patterns: np.ndarray, counts: np.ndarray, seeds: list[np.ndarray], rounds: int) -> tuple[VoteModel, float]:
    """EM for the class of documents without a vote for bad and one class for each seed; the log likelihood."""
    caught = np.array([np.full(patterns.shape[1], 0.05), *(np.where(s == BAD, 0.9, np.where(s == GOOD, 0.1, 0.3)) for s in seeds)])
    model = VoteModel(np.full(len(caught), 1 / len(caught)), caught, np.zeros(len(caught), bool))
    votes_bad, voted = (patterns == BAD).astype(float), (patterns != NONE).astype(float)
    for _ in range(rounds):
        weight = model.classes(patterns) * counts[:, None]
        share = (weight.sum(axis=0) + 1) / (counts.sum() + len(caught))
        caught = (weight.T @ votes_bad + 0.5) / (weight.T @ voted + 1)
        moved = np.abs(share - model.share).max() + np.abs(caught - model.caught).max()
        model = VoteModel(share, caught, model.bad)
        if moved < 1e-7:
            break
    log = model.joint(patterns)
    top = log.max(axis=1)
    return model, float(counts @ (top + np.log(np.exp(log - top[:, None]).sum(axis=1))))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300, most_classes: int = MOST_CLASSES) -> VoteModel:
    """EM over counted vote patterns. A class is bad if some heuristic calls most of it bad.

    The first class begins with the documents that no heuristic calls bad; each
    further one with the pattern that is most frequent and differs most from
    those before it. There are as many classes as the Bayesian information
    criterion prefers.
    """
    kinds = patterns.shape[1]
    best, least = VoteModel(np.ones(1), np.full((1, kinds), 0.05), np.zeros(1, bool)), np.inf
    if not len(patterns):
        return best
    seeds: list[np.ndarray] = []
    far = (patterns == BAD).sum(axis=1).astype(float)  # from the pattern without a vote for bad
    for _ in range(most_classes - 1):
        merit = counts * far
        if merit.max() <= 0:
            break
        seeds.append(patterns[int(merit.argmax())])
        far = np.minimum(far, ((patterns == BAD) != (seeds[-1] == BAD)).sum(axis=1))
        model, fit = _fit(patterns, counts, seeds, rounds)
        cost = (len(model.share) * (kinds + 1) - 1) * np.log(max(2.0, counts.sum())) - 2 * fit
        if cost < least:
            best, least = model, cost
    best.bad = best.caught.max(axis=1) > 0.5
    if best.bad.all():  # the better documents are the good ones
        best.bad[int(best.caught.mean(axis=1).argmin())] = False
    return best


class Shapes(dict):
    """Place of each word's shape, and of function words, in the hashed table."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 60_000:
            self.clear()
        plain = word.strip(b".,;:!?").lower()
        if plain in FUNCTION_WORDS and not word.isupper():
            shape = b"="
        else:
            drawn, shape = word.translate(_SHAPE), bytearray()
            for c in drawn:
                if not shape or shape[-1] != c:
                    shape.append(c)
            shape = bytes(shape)
        self[word] = place = xxhash.xxh3_64_intdigest(shape) >> 64 - BITS
        return place

    def of(self, text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
        """(places, values): the root of each shape's share of the words, and of the share of repeated runs."""
        words = (text or b"").split()
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        sums: dict[int, float] = Counter(map(self.__getitem__, words))
        repeated = 1 - len(set(zip(words, words[1:], words[2:]))) / (len(words) - 2) if len(words) > 2 else 0.0
        places = np.fromiter(sums, np.int64, len(sums))
        values = np.sqrt(np.fromiter(sums.values(), np.float64, len(sums)) / len(words))
        return np.append(places, 1 << BITS), np.append(values, repeated)


def fit_scorer(texts: list[bytes], target: np.ndarray, l2: float = 1e-4, rounds: int = 400) -> np.ndarray:
    """``fit_rows`` of the texts' shapes."""
    shapes = Shapes()
    return fit_rows([shapes.of(t) for t in texts], target, l2, rounds)


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, l2: float = 1e-4, rounds: int = 400) -> np.ndarray:
    """Weights over the hashed table, the repeats and an intercept, by accelerated gradient descent on soft labels."""
    size = (1 << BITS) + 2
    line = np.concatenate([np.full(len(p) + 1, i) for i, (p, _) in enumerate(rows)] or [np.empty(0, np.int64)])
    place = np.concatenate([np.append(p, size - 1) for p, _ in rows] or [np.empty(0, np.int64)])
    value = np.concatenate([np.append(v, 1.0) for _, v in rows] or [np.empty(0)])
    w = look = np.zeros(size)
    if not rows:
        return w
    step = 4 / max(1e-9, np.bincount(line, value * value, len(rows)).max())
    for t in range(rounds):
        p = sigmoid(np.bincount(line, value * look[place], len(rows)))
        slope = np.bincount(place, value * (p - target)[line], size) / len(rows) + l2 * look
        after = look - step * slope
        look = after + t / (t + 3) * (after - w)
        w = after
    return w


def score_of(places: np.ndarray, values: np.ndarray, w: np.ndarray) -> float:
    return float(sigmoid(np.array(w[places] @ values + w[-1])))


@dataclass
class Scorer:
    votes: VoteModel
    weights: np.ndarray


def _vote_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        seen.update(votes(t) for t in batch.column(0).cast(pa.binary()).to_pylist())
    keys = ["".join(map(str, k)) for k in seen]
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pattern", "n"])


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, pattern, places, values) of texts: what the scorer is fitted on, at most a table's size for each."""
    shapes = Shapes()
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        own = [shapes.of(t) for t in texts]
        patterns = ["".join(map(str, votes(t))) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(patterns, pa.string()), pa.array([p for p, _ in own], pa.list_(pa.int64())), pa.array([v for _, v in own], pa.list_(pa.float64()))],
            names=["id", "pattern", "places", "values"],
        )


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Scorer:
    """EM over the vote patterns of all documents, then the scorer on ``sample`` documents at most, in order of a hash.

    Null ids and null texts give votes but aren't sampled; of several texts of
    a sampled id the first in order counts, so the model is repeatable. What
    comes to the driver of a sampled text is its hashed shapes. Without
    documents every score is a half.
    """
    modest_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    counted = docs.select("text").mapInArrow(tidy(_vote_counts), "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    rows = sorted((r["pattern"], r["n"]) for r in counted.collect())  # 3 ** 10 patterns at most
    as_votes = lambda found: np.array([[int(c) for c in p] for p in found], np.int64).reshape(len(found), len(HEURISTICS))
    model = estimate(as_votes([p for p, _ in rows]), np.array([n for _, n in rows], np.float64))
    held = docs.filter("id IS NOT NULL AND text IS NOT NULL")
    chosen = held.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = held.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"))  # ``sample`` ids at most
    taken = texts.mapInArrow(tidy(_sampled), "id long, pattern string, places array<long>, values array<double>").toArrow()
    order = np.argsort(taken["id"].to_numpy(), kind="stable")
    shapes = list(zip(unpacked(taken["places"], order), unpacked(taken["values"], order)))
    patterns = taken["pattern"].to_pylist()
    return Scorer(model, fit_rows(shapes, model.posterior(as_votes([patterns[i] for i in order.tolist()]))))


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, w = Shapes(), model.value.weights
        for batch in batches:
            scores = [score_of(*shapes.of(t), w) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            good = [s >= 0.5 for s in scores]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(good)], names=["id", "score", "good"])

    return run


def quality(documents: DataFrame, model: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score, good), one row for each input row; good is a score of at least a half.

    Null and blank texts have no shapes and get the intercept's score. Very long
    texts are read whole. Null ids stay null, repeated rows are each answered,
    other columns are ignored, an empty table gives none.
    """
    modest_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    held = documents.sparkSession.sparkContext.broadcast(model)  # a table of 4096 weights
    kind = f"id {docs.schema['id'].dataType.simpleString()}, score double, good boolean"
    return docs.mapInArrow(tidy(_score(held)), kind).withColumnRenamed("id", id_col)


def only_good(documents: DataFrame, model: Scorer, text_col: str = "text") -> DataFrame:
    """The rows of documents, with all their columns, that score at least a half."""
    held = documents.sparkSession.sparkContext.broadcast(model)
    place = documents.columns.index(text_col)
    modest_batches(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes()
        for batch in batches:
            texts = batch.column(place).cast(pa.binary()).to_pylist()
            yield batch.filter(pa.array([score_of(*shapes.of(t), held.value.weights) >= 0.5 for t in texts], pa.bool_()))

    return documents.mapInArrow(tidy(run), documents.schema)
