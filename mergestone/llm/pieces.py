"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed here, by field number. From it come the
normaliser (character map, dummy prefix, white space rules), the metaspace
marker, the scores (unigram) or merges by score (BPE), byte fallback and
user-defined pieces. Batches are encoded by the library's threads.

With byte fallback and without unknown pieces decoding is the inverse of
encoding for a model that normalises nothing but the marker. ``parity`` holds
a sample of texts, and of ids back to texts, against the sentencepiece library;
each worker runs it once before its first batch and stops the job on a
difference.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, decoders, models, normalizers, pre_tokenizers

from mergestone.llm.scratch import modest_batches
from mergestone.llm.worker import keep, tidy

MARK = "▁"
#: Fixed values of the format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Fixed value: what an unknown piece is decoded as.
UNKNOWN_SHOWN = " \u2047 "
#: Threads of the library in a worker, unless RAYON_NUM_THREADS says otherwise; an executor has a worker for each core.
THREADS = 2
#: Parts that the library encodes in one batch.
TOGETHER = 2000
_PARTS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Texts that try white space, markers, bytes, scripts and marks.
PROBES = (
    "", " ", "  two  spaces ", "The quick brown fox.", "línea uno\nline two\ttab\r\n", "Größe, ça va? ñandú", "日本語のテキスト", "🦊 emoji \U0001f600‍",
    "▁ marker ▁▁", "%%% ### &&& *** $$$", "a" * 40, "\x00\x01 control", "<s> </s> <unk> <0x41>", "é  nbsp", "x = [1,2,3]; // code",
)


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return value, at
        shift += 7


def fields(data: bytes) -> list[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields; fixed-width values stay bytes."""
    out, at = [], 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        else:
            if kind == 2:
                size, at = _varint(data, at)
            elif kind in (1, 5):
                size = 8 if kind == 1 else 4
            else:
                raise ValueError(f"protobuf wire type {kind}")
            if at + size > len(data):
                raise ValueError("the model file is cut off")
            value, at = data[at : at + size], at + size
        out.append((key >> 3, value))
    return out


class Model:
    """What a SentencePiece model file says."""

    def __init__(self, data: bytes) -> None:
        import struct

        top = fields(data)
        self.pieces: list[tuple[str, float, int]] = []
        for number, value in top:
            if number == 1:
                one = dict(fields(value))
                self.pieces.append((one.get(1, b"").decode(), struct.unpack("<f", one[2])[0] if 2 in one else 0.0, one.get(3, NORMAL)))
        trainer, normal = ({} if n is None else dict(fields(n)) for n in (dict(top).get(2), dict(top).get(3)))
        self.kind = trainer.get(3, UNIGRAM)
        self.byte_fallback = bool(trainer.get(35, 0))
        self.suffix_mark = bool(trainer.get(24, 0))
        self.charsmap = normal.get(2, b"")
        self.dummy_prefix = bool(normal.get(3, 1))
        self.fold_spaces = bool(normal.get(4, 1))
        self.escape = bool(normal.get(5, 1))
        if not self.pieces or self.kind not in (UNIGRAM, BPE):
            raise ValueError("not a unigram or BPE SentencePiece model")


def build(model: Model) -> tokenizers.Tokenizer:
    """The model as a tokenizer of the tokenizers library."""
    if model.suffix_mark or not model.escape:
        raise ValueError("models that mark words at their end, or don't mark white space, are not supported")
    unknown = next((i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN), None)
    if model.kind == UNIGRAM:
        vocab = [(piece, score if kind in (NORMAL, USER) else -1e6 if kind == BYTE else score) for piece, score, kind in model.pieces]
        core = models.Unigram(vocab, unknown, model.byte_fallback)
    else:
        rank = {piece: i for i, (piece, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER)}
        order = []
        for piece, score, kind in model.pieces:
            if kind == NORMAL:
                for cut in range(1, len(piece)):
                    if piece[:cut] in rank and piece[cut:] in rank:
                        order.append((-score, rank[piece], rank[piece[:cut]], piece[:cut], piece[cut:]))
        core = models.BPE(
            {piece: i for i, (piece, _, _) in enumerate(model.pieces)},
            [(a, b) for *_, a, b in sorted(order)],
            unk_token=None if unknown is None else model.pieces[unknown][0],
            fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    out = tokenizers.Tokenizer(core)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.fold_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip(left=True, right=True)]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    # no piece has a marker after another character, so none can cross the start of a run of markers; short parts are cached
    if not any(MARK in piece.lstrip(MARK) for piece, _, kind in model.pieces if kind in (NORMAL, USER)):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    out.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
    user = [piece for piece, _, kind in model.pieces if kind == USER]
    if user:
        out.add_tokens([tokenizers.AddedToken(p, normalized=False) for p in user])
    return out


class Pieces:
    """Encoder and decoder of one model.

    Where no piece can cross the start of a run of markers, a text falls into
    independent parts, and most parts recur: the library encodes the parts of a
    batch that are new, and the rest come from two bounded tables. Other models go
    through the library whole text by whole text.
    """

    def __init__(self, data: bytes, most_parts: int = 50_000, longest_part: int = 100) -> None:
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))  # read when the library first needs its threads
        self.model = Model(data)
        self.tokenizer = build(self.model)
        self.normalizer = self.tokenizer.normalizer
        pieces = self.model.pieces
        self.by_parts = self.tokenizer.pre_tokenizer is not None and not any(kind == USER for *_, kind in pieces)
        if self.by_parts:  # texts are normalised and split before they come to the library
            self.tokenizer.normalizer = self.tokenizer.pre_tokenizer = None
        self.plain = self.by_parts and self.model.dummy_prefix and not self.model.charsmap and not self.model.fold_spaces
        self.known: dict[str, bytes] = {}  # ids of parts met lately
        self.earlier: dict[str, bytes] = {}  # the table before it, until this one is full
        self.most_parts, self.longest_part = most_parts, longest_part
        self.control = frozenset(i for i, (*_, kind) in enumerate(pieces) if kind == CONTROL)
        self.marked = frozenset(i for i, (piece, _, kind) in enumerate(pieces) if piece[:1] == MARK and kind in (NORMAL, USER))
        self.byte_of = {i: int(piece[3:5], 16) for i, (piece, _, kind) in enumerate(pieces) if kind == BYTE}
        self.unknown = next((i for i, (*_, kind) in enumerate(pieces) if kind == UNKNOWN), None)
        self.odd = self.control | {i for i in (self.unknown,) if i is not None}

    def _normal(self, text: str) -> str:
        if self.model.charsmap or self.model.fold_spaces:
            return self.normalizer.normalize_str(text)
        return (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Piece ids of each text; an empty text has none. The library encodes batches on its threads."""
        return [np.frombuffer(x, "<i4").tolist() for x in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """``encode`` with each text's ids as little-endian 32-bit integers."""
        packed = lambda x: array("i", x.ids).tobytes()
        blank = (lambda t: not t.strip(" ")) if self.model.fold_spaces else (lambda t: not t)
        if not self.by_parts:
            found = map(packed, self.tokenizer.encode_batch(texts, add_special_tokens=False))
            return [b"" if blank(t) else ids for t, ids in zip(texts, found)]
        split = [[] if blank(t) else self._parts(t) for t in texts]
        if len(self.known) > self.most_parts:
            self.known, self.earlier = {}, self.known
        known, fresh = self.known, []
        for p in set().union(*split) - known.keys():
            if p in self.earlier:
                known[p] = self.earlier[p]
            else:
                fresh.append(p)
        for start in range(0, len(fresh), TOGETHER):
            some = fresh[start : start + TOGETHER]
            found = self.tokenizer.encode_batch_fast([MARK + p if self.plain and p[:1] != MARK else p for p in some], add_special_tokens=False)
            known.update(zip(some, map(packed, found)))
        out = [b"".join(map(known.__getitem__, parts)) for parts in split]
        for p in fresh:
            if len(p) > self.longest_part:
                del known[p]
        return out

    def _parts(self, text: str) -> list[str]:
        """The text's independent parts. For a plain model all begin with a marker, and a word behind one is written without it."""
        if not self.plain:
            return _PARTS.findall(self._normal(text))
        if "  " not in text and MARK not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ")
        return [p[1:] if p[1:2] not in (MARK, "") else p for p in _PARTS.findall(self._normal(text))]

    def decode(self, ids: list[list[int]]) -> list[str]:
        """The text of each list of ids, by the library's batches.

        Control pieces have no text, an unknown one has a fixed one, and each
        byte that is no part of a UTF-8 character gives one replacement
        character: lists with such pieces are put together piece by piece. The
        marker that normalising put first goes again.
        """
        out = []
        for one, text in zip(ids, self.tokenizer.decode_batch(ids, skip_special_tokens=False)):
            first = one[0] if one else None
            if not self.odd.isdisjoint(one) or "\ufffd" in text and not self.byte_of.keys().isdisjoint(one):
                text = self._loose(one)
                first = next((i for i in one if i not in self.control), None)
            elif MARK in text:  # markers are put together in the library, and are spaces to whoever reads them
                text = text.replace(MARK, " ")
            out.append(text[1:] if self.model.dummy_prefix and first in self.marked else text)
        return out

    def _loose(self, ids: list[int]) -> str:
        """The text of ids with control or unknown pieces, or bytes that aren't all UTF-8."""
        out, held = [], bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            while held:
                for size in range(min(4, len(held)), 0, -1):
                    try:
                        out.append(bytes(held[:size]).decode())
                    except UnicodeDecodeError:
                        continue
                    del held[:size]
                    break
                else:
                    out.append("\ufffd")
                    del held[:1]
            if i is not None and i not in self.control:
                out.append(UNKNOWN_SHOWN if i == self.unknown else self.model.pieces[i][0].replace(MARK, " "))
        return "".join(out)


def parity(pieces: Pieces, data: bytes, texts: tuple[str, ...] | list[str] = PROBES) -> list[str]:
    """The texts whose ids, or whose ids' texts, differ from the sentencepiece library's."""
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_proto=data)
    ids = pieces.encode(list(texts))
    return [t for t, own, back in zip(texts, ids, pieces.decode(ids)) if own != other.encode(t) or back != other.decode(own)]


def _held(data: bytes) -> Pieces:
    def make() -> Pieces:
        pieces = Pieces(data)
        if wrong := parity(pieces, data):
            raise RuntimeError(f"the pieces differ from the sentencepiece library's on {wrong[:3]!r}")
        return pieces

    return keep(("pieces", len(data), hashlib.sha256(data).hexdigest()), make)


def _rows(batch: pa.RecordBatch, characters: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Runs of rows that hold a bounded number of characters, or one row."""
    sizes = batch.column(1).to_pylist()
    start = held = 0
    for i, text in enumerate(sizes):
        if held and held + len(text or "") > characters:
            yield start, i
            start, held = i, 0
        held += len(text or "")
    if start < len(sizes):
        yield start, len(sizes)


def _encode(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _held(model.value)
        for batch in batches:
            for start, end in _rows(batch):
                part = batch.slice(start, end - start)
                ids = pieces.encode_bytes([t or "" for t in part.column(1).to_pylist()])
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat, mask=part.column(1).is_null())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], names=["id", "text", "ids"])

    return run


def _decode(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _held(model.value)
        for batch in batches:
            lists = batch.column(1).to_pylist()
            texts = pieces.decode([[i for i in x if i is not None] if x else [] for x in lists])
            texts = [None if x is None else t for x, t in zip(lists, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return run


def default_model() -> str:
    """The path of the public 32k model among this machine's tokenizer files; where they are missing, name a model."""
    try:
        import public_tokenizers
    except ModuleNotFoundError as gone:
        raise RuntimeError("the public tokenizer files are not on this machine: give model_path") from gone

    return public_tokenizers.path("piece_bpe_32k.model")


def _share(frame: DataFrame, model_path: str | None):
    with open(model_path or default_model(), "rb") as file:
        return frame.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary, whatever the input


def encode(documents: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, ids): the piece ids of each whole text.

    A null text has null ids, an empty one none; null ids of rows stay null,
    repeated rows are each answered, other columns are ignored. model_path is
    read by the driver.
    """
    modest_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = f"id {docs.schema['id'].dataType.simpleString()}, text string, ids array<int>"
    return docs.mapInArrow(tidy(_encode(_share(documents, model_path)), keeps=True), kind).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, model_path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of rows of piece ids; null ids give a null text, no ids an empty one."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    kind = f"id {rows.schema['id'].dataType.simpleString()}, text string"
    return rows.mapInArrow(tidy(_decode(_share(encoded, model_path)), keeps=True), kind).withColumnRenamed("id", id_col)


def _digest(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _held(model.value)
        for batch in batches:
            for start, end in _rows(batch):
                part = batch.slice(start, end - start)
                texts = part.column(1).to_pylist()
                ids = pieces.encode_bytes([t or "" for t in texts])
                back = pieces.decode([np.frombuffer(x, "<i4").tolist() for x in ids])
                same = [t is None or t == b for t, b in zip(texts, back)]
                hashes = [hashlib.sha256(x).hexdigest() for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(hashes), pa.array(same)],
                    names=["doc_id", "n_pieces", "ids_sha256", "round_trip"],
                )

    return run


def digest(documents: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pieces, ids_sha256 of the ids as little-endian int32, round_trip): encoded and decoded in one pass."""
    modest_batches(documents.sparkSession)
    docs = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(tidy(_digest(_share(documents, model_path)), keeps=True), "doc_id long, n_pieces long, ids_sha256 string, round_trip boolean")
