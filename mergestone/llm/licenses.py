"""License scans: base phrases by consecutive words, and fuzzy search of short notices.

A notice of length L may differ in up to k characters. Split into k + 1 pieces,
every such occurrence holds one piece unchanged (pigeonhole), so an
Aho-Corasick automaton over all pieces finds every candidate place. The regex
library's bounded-error matching drops the places without an occurrence; edit
distances from every start to every end around the others give the edits and
the spans, so that notices next to each other are each found.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.llm.scratch import modest_batches
from mergestone.llm.words import alnum_words
from mergestone.llm.worker import tidy

#: Phrases whose words must stand consecutively, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices of the fuzzy search, in words of lower case, and their labels.
NOTICES = {
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the apache license version 2 0": "apache-2",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under the gnu general public license version 2": "gpl-2",
    "under the terms of the gnu lesser general public license": "lgpl",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "dedicated to the public domain under cc0": "cc0",
}
#: Characters of a notice for each allowed edit, and edits at most.
PER_EDIT, MOST_EDITS = 14, 4
#: Characters that tell two notices apart must stand unchanged, so an edit never turns one license into another.
FIXED_WORDS = {"mit", "apache", "cc", "by", "nc", "sa", "cc0", "2", "3", "4", "gnu", "lesser", "mozilla"}

SPANS = "spans array<struct<label:string,first_word:long,last_word:long,edits:int,similarity:double,found:string>>"
KIND = f"n_words long, base array<struct<label:string,word:long>>, {SPANS}"


class Scanner:
    """Compiled phrases and notices; built once in each worker."""

    def __init__(self, base: dict[str, str], notices: dict[str, str], per_edit: int, most_edits: int) -> None:
        self.base = [(f" {phrase} ".encode(), label) for phrase, label in base.items()]
        self.notices, self.seeds = [], ahocorasick.Automaton()
        for phrase, label in notices.items():
            edits = max(1, min(most_edits, len(phrase) // per_edit))
            self.notices.append((label, phrase, edits, regex.compile(f"(?:{regex.escape(phrase)}){{e<={edits}}}"), FIXED_WORDS & set(phrase.split())))
            cuts = [len(phrase) * i // (edits + 1) for i in range(edits + 2)]
            for start, end in zip(cuts, cuts[1:]):
                seed = phrase[start:end]
                places = self.seeds.get(seed, [])
                self.seeds.add_word(seed, [*places, (len(self.notices) - 1, start, len(seed))])
        if len(self.seeds):
            self.seeds.make_automaton()

    def base_places(self, line: bytes) -> list[tuple[int, str]]:
        """(word, label) of each place of a base phrase; line: the words, each between spaces."""
        found = []
        for phrase, label in self.base:
            at = line.find(phrase)
            while at >= 0:
                found.append((at, label))
                at = line.find(phrase, at + 1)
        if not found:
            return []
        spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
        return sorted((int(np.searchsorted(spaces, at)), label) for at, label in found)

    def spans(self, text: str) -> list[dict]:
        """Verified occurrences of the notices, best first within an overlap, in order of the text."""
        places: set[tuple[int, int]] = set()
        if len(self.seeds):
            for end, seeds in self.seeds.iter(text):
                places.update((number, end + 1 - length - offset) for number, offset, length in seeds)
        least: dict[tuple[int, int, int], int] = {}
        for number, first in places:
            _, phrase, edits, pattern, fixed = self.notices[number]
            # a seed that stands unchanged is moved by as many characters as there are edits, at most
            low, high = max(0, first - edits), min(len(text), first + len(phrase) + edits)
            if pattern.search(text, low, high) is None:
                continue
            for begin, finish, changed in near_places(phrase, text[low:high], 2 * edits + 1, edits):
                start, end = text.rfind(" ", 0, low + begin + 1) + 1, text.find(" ", low + finish)
                end = len(text) if end < 0 else end
                if changed < least.get((number, start, end), edits + 1) and fixed <= set(text[start:end].split()):
                    least[number, start, end] = changed
        if not least:
            return []
        spaces = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), np.uint32) == 0x20)
        out = []
        for (number, start, end), changed in least.items():
            label, phrase, _, _, _ = self.notices[number]
            found = text[start:end].strip()
            first = int(np.searchsorted(spaces, start)) - 1
            out.append({"label": label, "first_word": first, "last_word": first + found.count(" "), "edits": changed, "similarity": 1 - changed / len(phrase), "found": found})
        # of equally close ones the shortest, so that none takes a word of its neighbour
        kept: list[dict] = []
        taken: dict[str, list[tuple[int, int]]] = {}  # of each label the spans kept, in order; they don't overlap
        for span in sorted(out, key=lambda s: (s["edits"], s["last_word"] - s["first_word"], s["first_word"], s["label"], -s["similarity"])):
            own = taken.setdefault(span["label"], [])
            at = bisect.bisect(own, (span["first_word"], span["last_word"]))
            if not (at and own[at - 1][1] >= span["first_word"] or at < len(own) and own[at][0] <= span["last_word"]):
                own.insert(at, (span["first_word"], span["last_word"]))
                kept.append(span)
        return sorted(kept, key=lambda s: (s["first_word"], s["label"]))


def near_places(phrase: str, part: str, starts: int, edits: int) -> list[tuple[int, int, int]]:
    """(start, end, edits) of each substring of part that begins in its first places and is that near to phrase."""
    codes = np.frombuffer(part.encode("utf-32-le"), np.uint32)
    along = np.arange(len(part) + 1)
    begin = np.arange(min(starts, len(part)))[:, None]
    far = len(phrase) + len(part)
    line = np.where(along >= begin, along - begin, far)
    for char in phrase:
        after = line + 1
        np.minimum(after[:, 1:], line[:, :-1] + (codes != ord(char)), out=after[:, 1:])
        line = np.minimum.accumulate(after - along, axis=1) + along
    return [(int(b), int(e), int(line[b, e])) for b, e in zip(*np.nonzero((line <= edits) & (along > begin)))]


def _scan(make):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(*make)
        base_kind = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
        span_kind = pa.list_(
            pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32()), ("similarity", pa.float64()), ("found", pa.string())])
        )
        for batch in batches:
            words, base, spans = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                own = alnum_words(text or b"")
                line = b" " + b" ".join(own) + b" " if own else b""
                words.append(len(own))
                base.append([{"label": label, "word": at} for at, label in scanner.base_places(line)])
                spans.append(scanner.spans(line.decode()) if own else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(base, base_kind), pa.array(spans, span_kind)], names=["id", "n_words", "base", "spans"]
            )

    return run


def license_scan(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: dict[str, str] = BASE,
    notices: dict[str, str] = NOTICES,
    per_edit: int = PER_EDIT,
    most_edits: int = MOST_EDITS,
) -> DataFrame:
    """(id_col, n_words, base, spans), one row for each input row.

    ``base`` holds every place (word from 0) of a base phrase; ``spans`` the
    fuzzy occurrences with label, first and last word, edits, similarity and
    the words found. Occurrences of one label that overlap count once, the
    closest. Null and wordless texts have none; very long texts are read whole,
    in time in proportion to their length; a null id stays null; repeated rows
    are each answered; other columns are ignored; an empty table gives none.
    """
    modest_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = f"id {docs.schema['id'].dataType.simpleString()}, {KIND}"
    return docs.mapInArrow(tidy(_scan((base, notices, per_edit, most_edits))), kind).withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """license_scan()'s rows as the counts, first and last places, labels and score of each document."""
    at, own, fuzzy = F.col("base.word"), F.col("base.label"), F.col("spans.label")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    best = F.coalesce(F.array_max("spans.similarity"), F.lit(0.0))
    return found.select(
        id_col,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(at).alias("first_word"),
        F.array_max(at).alias("last_word"),
        joined(own).alias("base_labels"),
        joined(F.concat(own, fuzzy)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
    )
