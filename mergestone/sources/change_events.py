"""Decoders of change events: framed JSON, a compact binary form, and Canal's JSON of row images.

Framed JSON: the key is a 64-bit version (1) and then frames, the value frames
alone; a frame is a 64-bit length and JSON. The i-th key goes with the i-th
value; an empty value is a resolved event.

Compact: one buffer of little-endian base-128 numbers with the sizes of all
parts at its end; names are numbers of a dictionary, keys are columns of
running differences.
"""

from __future__ import annotations

import base64
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.operators.changelog import DDL, RESOLVED, ROW
from mergestone.operators.versions import COUNTER_BITS

#: MySQL's type codes by how their values are written.
TEXT_CODES = {0xF9, 0xFA, 0xFB, 0xFC}
INTEGER_CODES = {1, 2, 3, 8, 9}
YEAR_CODE = 13
ORDINAL_CODES = {16, 0xF7, 0xF8}
FLOAT_CODES = {4, 5}
BYTES_CODES = {15, 0xF9, 0xFA, 0xFB, 0xFC, 0xFD, 0xFE}
#: Bits of a column's flags.
BINARY, UNSIGNED = 1, 1 << 7
OLD, NEW = 2, 1
#: What a DDL event's number says.
DDL_KINDS = {
    1: "create schema", 2: "drop schema", 3: "create table", 4: "drop table", 5: "add column", 6: "drop column", 7: "add index", 8: "drop index",
    9: "add foreign key", 10: "drop foreign key", 11: "truncate table", 12: "modify column", 13: "rebase auto id", 14: "rename table", 15: "set default value",
    16: "shard rowid", 17: "modify table comment", 18: "rename index", 19: "add table partition", 20: "drop table partition", 21: "create view",
    22: "modify table charset and collate", 23: "truncate table partition", 24: "drop view", 25: "recover table", 26: "modify schema charset and collate",
    27: "lock table", 28: "unlock table", 29: "repair table", 30: "set columnar replica", 31: "update columnar replica status", 32: "add primary key",
    33: "drop primary key", 34: "create sequence", 35: "alter sequence", 36: "drop sequence",
}

EVENT = "schema string, table string, partition long, type_code int, commit_version long, old map<string,string>, new map<string,string>, ddl string, ddl_kind string"


def _frames(data: bytes, at: int = 0) -> Iterator[bytes]:
    while at < len(data):
        (size,) = struct.unpack_from(">q", data, at)
        at += 8
        if size < 0 or at + size > len(data):
            raise ValueError("a frame is cut off")
        yield data[at : at + size]
        at += size


def _plain(column: dict) -> str | None:
    value = column.get("v")
    if value is None:
        return None
    if column.get("t") in TEXT_CODES:
        body = base64.b64decode(value)
        return body.hex() if column.get("f", 0) & BINARY else body.decode("utf-8", "replace")
    return value if isinstance(value, str) else json.dumps(value)


def decode_framed(key: bytes, value: bytes) -> list[dict]:
    """The events of a framed JSON message; names in lower case."""
    if struct.unpack_from(">q", key)[0] != 1:
        raise ValueError("unknown version of framed JSON")
    out = []
    values = list(_frames(value))
    for i, frame in enumerate(_frames(key, 8)):
        k = json.loads(frame)
        event = {"schema": k.get("scm"), "table": k.get("tbl"), "partition": k.get("ptn", 0), "type_code": k["t"], "commit_version": k["ts"], "old": None, "new": None, "ddl": None, "ddl_kind": None}
        body = json.loads(values[i]) if i < len(values) and values[i] else {}
        side = lambda name: {c.lower(): _plain(v) for c, v in body[name].items()} if body.get(name) else None  # noqa: E731, B023
        if k["t"] == ROW:
            event["old"], event["new"] = (side("d"), None) if "d" in body else (side("p"), side("u"))
        elif k["t"] == DDL:
            event["ddl"], event["ddl_kind"] = body.get("q"), DDL_KINDS.get(body.get("t"))
        out.append(event)
    return out


def encode_framed(events: list[tuple[dict, dict | None]]) -> tuple[bytes, bytes]:
    """(key, value) of a framed JSON message of (key, value) dictionaries; None is an empty value."""
    frame = lambda d: struct.pack(">q", len(d)) + d
    keys = struct.pack(">q", 1) + b"".join(frame(json.dumps(k).encode()) for k, _ in events)
    return keys, b"".join(frame(b"" if v is None else json.dumps(v).encode()) for _, v in events)


class _Reader:
    """Numbers and runs of numbers of the compact form."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def unsigned(self) -> int:
        value = shift = 0
        while True:
            b = self.data[self.at]
            self.at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    def signed(self) -> int:
        n = self.unsigned()
        return (n >> 1) ^ -(n & 1)

    def run(self, n: int, one, summed: bool = False) -> list[int]:
        out: list[int] = []
        for _ in range(n):
            value = one()
            out.append(out[-1] + value if summed and out else value)
        return out

    def take(self, n: int) -> bytes:
        self.at += n
        if n < 0 or self.at > len(self.data):
            raise ValueError("the buffer is cut off")
        return self.data[self.at - n : self.at]


def _scalar(code: int, flags: int, body: bytes | None) -> str | None:
    if body is None:
        return None
    r = _Reader(body)
    if code in INTEGER_CODES:
        return str(r.unsigned() if flags & UNSIGNED else r.signed())
    if code == YEAR_CODE:
        return str(r.signed())
    if code in ORDINAL_CODES:
        return str(r.unsigned())
    if code in FLOAT_CODES:
        return repr(struct.unpack("<d", body)[0])
    return body.hex() if flags & BINARY and code in BYTES_CODES else body.decode("utf-8", "replace")


def decode_compact(data: bytes) -> list[dict]:
    """The events of a compact message; names in lower case."""
    r = _Reader(data)
    if r.unsigned() != 1:
        raise ValueError("unknown version of the compact form")
    # the last bytes, read backwards, give the size of the tables before them
    tail = _Reader(data[::-1][:10])
    size = tail.unsigned()
    end = len(data) - tail.at
    t, tables = _Reader(data[:end], end - size), []
    while t.at < end:
        tables.append(t.run(t.unsigned(), t.signed, summed=True))
    (key_size, term_size), sizes = tables[0], tables[1]
    start = r.at
    values_at = start + key_size
    words: list[str] = []
    if term_size:  # a message of resolved events alone has no dictionary
        terms = _Reader(data, values_at + sum(sizes))
        lengths = terms.run(terms.unsigned(), terms.unsigned)
        words = [terms.take(n).decode() for n in lengths]
        if terms.at != values_at + sum(sizes) + term_size:
            raise ValueError("the dictionary has another size than told")
    word = lambda i: None if i < 0 else words[i]
    n = len(sizes)
    stamps, kinds = r.run(n, r.unsigned, summed=True), r.run(n, r.unsigned)
    partitions = r.run(n, r.signed, summed=True)
    schemas, names = (r.run(n, r.signed, summed=True) for _ in range(2))
    out, at = [], values_at
    for i in range(n):
        event = {"schema": word(schemas[i]), "table": word(names[i]), "partition": partitions[i], "type_code": kinds[i], "commit_version": stamps[i], "old": None, "new": None, "ddl": None, "ddl_kind": None}
        v = _Reader(data, at)
        if kinds[i] == DDL:
            event["ddl_kind"] = DDL_KINDS.get(v.unsigned())
            event["ddl"] = v.take(v.unsigned()).decode()
        elif kinds[i] == ROW:
            for group in tables[2 + i] if 2 + i < len(tables) else []:
                stop = v.at + group
                side = "old" if v.take(1)[0] == OLD else "new"
                count = v.unsigned()
                columns = [words[k] for k in v.run(count, v.signed, summed=True)]
                codes, flags, lengths = v.run(count, v.unsigned), v.run(count, v.unsigned), v.run(count, v.signed)
                bodies = [None if x < 0 else v.take(x) for x in lengths]
                event[side] = {c.lower(): _scalar(k, f, b) for c, k, f, b in zip(columns, codes, flags, bodies)}
                v.at = stop
        at += sizes[i]
        out.append(event)
    return out


def _u(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _s(n: int) -> bytes:
    return _u(n << 1 if n >= 0 else (-n << 1) - 1)


def _steps(values: list[int], one) -> bytes:
    return b"".join(one(v - (values[i - 1] if i else 0)) for i, v in enumerate(values))


def encode_compact(events: list[dict]) -> bytes:
    """A compact message; rows are lists of (name, code, flags, body) under ``old`` and ``new``."""
    words: dict[str, int] = {}
    number = lambda w: -1 if w is None else words.setdefault(w, len(words))
    schemas, tables = ([number(e.get(k)) for e in events] for k in ("schema", "table"))
    values, groups = [], []
    for e in events:
        parts = []
        for side, mark in (("old", OLD), ("new", NEW)):
            if row := e.get(side):
                bodies = [b for *_, b in row]
                parts.append(
                    bytes([mark]) + _u(len(row)) + _steps([number(c) for c, *_ in row], _s) + b"".join(_u(k) for _, k, _, _ in row) + b"".join(_u(f) for _, _, f, _ in row)
                    + b"".join(_s(-1 if b is None else len(b)) for b in bodies) + b"".join(b or b"" for b in bodies)
                )
        ddl = e.get("ddl")
        values.append(_u(e.get("ddl_number", 0)) + _u(len(ddl.encode())) + ddl.encode() if ddl else b"".join(parts))
        groups.append([len(p) for p in parts])
    keys = _steps([e["commit_version"] for e in events], _u) + b"".join(_u(e["type_code"]) for e in events)
    keys += _steps([e.get("partition", 0) for e in events], _s) + _steps(schemas, _s) + _steps(tables, _s)
    encoded = [w.encode() for w in words]
    terms = _u(len(encoded)) + b"".join(_u(len(w)) for w in encoded) + b"".join(encoded) if encoded else b""
    sizes = b"".join(_u(len(t)) + _steps(t, _s) for t in [[len(keys), len(terms)], [len(v) for v in values], *groups])
    return _u(1) + keys + b"".join(values) + terms + sizes + _u(len(sizes))[::-1]


def integer_body(n: int, unsigned: bool = False) -> bytes:
    return _u(n) if unsigned else _s(n)


_FIELDS = [("schema", pa.string()), ("table", pa.string()), ("partition", pa.int64()), ("type_code", pa.int32()), ("commit_version", pa.int64()), ("old", pa.map_(pa.string(), pa.string())), ("new", pa.map_(pa.string(), pa.string())), ("ddl", pa.string()), ("ddl_kind", pa.string())]
#: Messages that are decoded together.
_TOGETHER = 200


def _decoder(codec: str, ignore_errors: bool):
    def batch_of(events: list[dict]) -> pa.RecordBatch:
        columns = []
        for name, kind in _FIELDS:
            values = [e[name] for e in events]
            columns.append(pa.array([None if v is None else list(v.items()) for v in values] if pa.types.is_map(kind) else values, kind))
        return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in _FIELDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, values = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start in range(0, len(values), _TOGETHER):
                out = []
                for key, value in zip(keys[start : start + _TOGETHER], values[start : start + _TOGETHER]):
                    try:
                        out += decode_framed(key, value or b"") if codec == "framed" else decode_compact(value)
                    except (ValueError, IndexError, KeyError, TypeError, struct.error):
                        if not ignore_errors:
                            raise
                yield batch_of(out)

    return run


def decode(messages: DataFrame, codec: str = "framed", ignore_errors: bool = False, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Events of messages, batch or streaming. With ``ignore_errors`` messages that can't be read are left out.

    Values are text as the database shows them; those of binary columns are hexadecimal.
    """
    if codec not in ("framed", "compact"):
        raise ValueError(f"unknown codec {codec}")
    key = F.col(key_col) if codec == "framed" else F.lit(None).cast("binary")
    return messages.select(key.cast("binary").alias("k"), F.col(value_col).cast("binary").alias("v")).mapInArrow(_decoder(codec, ignore_errors), EVENT)


#: Canal's message of row images; values are text.
CANAL = "database string, table string, type string, es long, isDdl boolean, data array<map<string,string>>, old array<map<string,string>>"


def decode_canal(messages: DataFrame, value_col: str = "value", ignore_errors: bool = False, own_version: str | None = None) -> DataFrame:
    """Canal JSON as (schema, table, commit_version, old, new), all in the JVM.

    Rows of INSERT, UPDATE and DELETE; other messages are skipped. An update's
    old image holds only what changed and is filled from the new one. The
    version is the message's time in milliseconds; ``own_version`` names, as in
    ``extension.commitTs``, where each message of the older form must carry it.
    """
    mode = "PERMISSIVE" if ignore_errors else "FAILFAST"
    text = F.col(value_col).cast("string")
    held = F.get_json_object(text, f"$.{own_version}").cast("long") if own_version else F.lit(None).cast("long")
    m = messages.select(F.from_json(text, CANAL, {"mode": mode}).alias("m"), held.alias("held")).select("m.*", "held")
    version = F.shiftleft("es", COUNTER_BITS)
    if own_version:
        version = F.col("held")
        if ignore_errors:
            m = m.filter(version.isNotNull())
        else:
            version = F.coalesce(version, F.raise_error(F.lit("a message has no commit version")).cast("long"))
    lower = lambda c: F.transform_keys(c, lambda k, _: F.lower(k))
    rows = m.filter("type IN ('INSERT', 'UPDATE', 'DELETE') AND NOT coalesce(isDdl, false)").select(
        F.lower("database").alias("schema"), F.lower("table").alias("table"), version.alias("commit_version"), "type", "old", F.posexplode("data").alias("i", "row")
    )
    row, old = lower(F.col("row")), F.when(F.col("type") == "UPDATE", lower(F.get("old", F.col("i"))))
    none = F.expr("CAST(map() AS map<string,string>)")
    rows = rows.withColumns({"row": row, "changed": F.coalesce(old, none)})
    # few columns change: what the old image lacks is taken from the new one
    filled = F.map_concat(F.map_filter("row", lambda k, _: ~F.map_contains_key("changed", k)), F.col("changed"))
    return rows.select(
        "schema", "table", "commit_version",
        F.when(F.col("type") == "DELETE", F.col("row")).when(F.col("type") == "UPDATE", filled).alias("old"),
        F.when(F.col("type") != "DELETE", F.col("row")).alias("new"),
    )


#: Field numbers of Canal's protobuf messages, and its kinds of entries and events.
PACKET_TYPE, PACKET_BODY, MESSAGES, BATCH_MESSAGES = 3, 5, 7, 2
ENTRY_HEADER, ENTRY_TYPE, ENTRY_BODY, ENTRY_ROWDATA = 1, 2, 3, 2
HEADER_TIME, HEADER_SCHEMA, HEADER_TABLE = 6, 8, 9
CHANGE_KIND, CHANGE_DDL, CHANGE_SQL, CHANGE_ROWS = 2, 10, 11, 12
ROW_BEFORE, ROW_AFTER = 1, 2
COLUMN_NAME, COLUMN_UPDATED, COLUMN_NULL, COLUMN_VALUE = 3, 5, 6, 8
EVENT_KINDS = {1: "INSERT", 2: "UPDATE", 3: "DELETE"}


def protobuf_fields(data: bytes) -> list[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: varints as integers, the rest as bytes."""
    r, out = _Reader(data), []
    while r.at < len(data):
        key = r.unsigned()
        kind = key & 7
        if kind == 0:
            out.append((key >> 3, r.unsigned()))
        elif kind == 2:
            out.append((key >> 3, r.take(r.unsigned())))
        elif kind in (1, 5):
            out.append((key >> 3, r.take(8 if kind == 1 else 4)))
        else:
            raise ValueError(f"protobuf wire type {kind}")
    return out


def decode_canal_packet(data: bytes) -> list[dict]:
    """The row changes of a Canal protobuf packet, in the shape of its JSON messages; old images hold what was updated."""
    packet = dict(protobuf_fields(data))
    if packet.get(PACKET_TYPE) != MESSAGES:
        raise ValueError("the packet holds no messages")
    out = []
    for number, entry in protobuf_fields(packet.get(PACKET_BODY, b"")):
        if number != BATCH_MESSAGES:
            continue
        held = dict(protobuf_fields(entry))
        if held.get(ENTRY_TYPE, ENTRY_ROWDATA) != ENTRY_ROWDATA:
            continue  # marks of transactions
        header, fields = dict(protobuf_fields(held[ENTRY_HEADER])), protobuf_fields(held[ENTRY_BODY])
        change = dict(fields)
        event = {"database": header.get(HEADER_SCHEMA, b"").decode(), "table": header.get(HEADER_TABLE, b"").decode(), "es": header.get(HEADER_TIME, 0), "isDdl": bool(change.get(CHANGE_DDL, 0))}
        event |= {"type": EVENT_KINDS.get(change.get(CHANGE_KIND, 2), "OTHER"), "data": [], "old": []}
        for number, row in fields:
            if number != CHANGE_ROWS:
                continue
            sides: dict[int, dict[str, str | None]] = {ROW_BEFORE: {}, ROW_AFTER: {}}
            updated = set()
            for side, column in protobuf_fields(row):
                if side not in sides:
                    continue
                c = dict(protobuf_fields(column))
                name = c[COLUMN_NAME].decode()
                sides[side][name] = None if c.get(COLUMN_NULL) else c.get(COLUMN_VALUE, b"").decode()
                if side == ROW_AFTER and c.get(COLUMN_UPDATED):
                    updated.add(name)
            event["data"].append(sides[ROW_BEFORE] if event["type"] == "DELETE" else sides[ROW_AFTER])
            event["old"].append({k: v for k, v in sides[ROW_BEFORE].items() if k in updated} if event["type"] == "UPDATE" else None)
        out.append(event)
    return out


def decode_canal_protobuf(messages: DataFrame, value_col: str = "value", ignore_errors: bool = False) -> DataFrame:
    """Canal protobuf packets as ``decode_canal`` gives JSON messages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(0).to_pylist():
                try:
                    out += [json.dumps(e) for e in decode_canal_packet(value)]
                except (ValueError, IndexError, KeyError, TypeError):
                    if not ignore_errors:
                        raise
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    return decode_canal(messages.select(F.col(value_col).cast("binary").alias("v")).mapInArrow(run, "value string"), ignore_errors=ignore_errors)
