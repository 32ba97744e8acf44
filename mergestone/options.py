"""Options as text, as SQL hints, sessions and job settings carry them, brought to reads and writes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from mergestone.engine import GLOBAL, MINIBATCH, UPDATE, WriteOptions
from mergestone.operators import write
from mergestone.operators.changelog import DDL, RESOLVED, ROW, split_names
from mergestone.operators.rowid import STEP

#: Options that say where and how to connect, which have no meaning here; they are accepted and ignored.
IGNORED_PREFIXES = ("url", "username", "user", "password", "tls.", "ssl.", "pool.", "replica", "dns.", "timeout.", "telemetry.", "jdbc.", "hostmapping")
_TYPES = {"row_changed": ROW, "ddl": DDL, "resolved": RESOLVED}


def flag(text: str) -> bool:
    low = str(text).strip().lower()
    if low not in ("true", "false"):
        raise ValueError(f"not true or false: {text!r}")
    return low == "true"


@dataclass(frozen=True)
class Options:
    """What a set of options says. Those given by a statement's hint override the session's and the table's."""

    version: int | None = None
    timestamp: str | None = None
    metadata: bool | dict[str, str] = False
    filter_pushdown: bool = False
    limit: int | None = None
    write: WriteOptions = WriteOptions()
    buffer: int = 1000
    id_step: int = STEP
    codec: str = "compact"
    ignore_errors: bool = False
    start_version: int | None = None
    start_timestamp: str | None = None
    types: tuple[int, ...] = ()
    schemas: str | None = None
    tables: str | None = None
    rest: dict[str, str] = field(default_factory=dict)


def parse(options: Mapping[str, str], hint: Mapping[str, str] | None = None) -> Options:
    """Options by name, without regard to case; a name that is none raises.

    ``hint`` holds the options of one statement. The columns that a write
    updates can be given there only, as another statement would write others.
    """
    own = {k.strip().lower(): v for k, v in options.items()}
    if "update-columns" in own:
        raise ValueError("update-columns is an option of a statement, not of a table or session")
    own |= {k.strip().lower(): v for k, v in (hint or {}).items()}
    take = lambda name, default=None: own.pop(name, default)
    mode = take("write_mode", write.APPEND).lower()
    change = WriteOptions(
        mode=mode,
        transaction=take("sink.transaction", MINIBATCH if flag(own.get("delete-enable", "false")) else GLOBAL).lower(),
        deduplicate=flag(take("deduplicate", "false")),
        sequence=tuple(split_names(take("sequence"))),
        update_columns=tuple(split_names(take("update-columns"))),
        skip_check=flag(take("skip-check-update-columns", "false")),
        deletes=flag(take("delete-enable", "false")),
        ignore_given_ids=any([flag(take("ignore-autoincrement-column-value", "false")), flag(take("ignore-autorandom-column-value", "false"))]),
    )
    if mode not in (write.APPEND, write.UPSERT, UPDATE):
        raise ValueError(f"unknown write mode {mode}")
    number = lambda name, default=None: default if (text := take(name)) is None else int(text)
    noted = take("metadata.included")
    codec = take("streaming.codec", "craft").lower()
    kinds = split_names(take("type.include"))
    if unknown := set(kinds) - set(_TYPES):
        raise ValueError(f"unknown event types {sorted(unknown)}")
    names = {"craft": "compact", "json": "framed", "canal_json": "canal", "canal_protobuf": "canal_protobuf"}
    if codec not in names:
        raise ValueError(f"unknown codec {codec}")
    made = Options(
        version=number("snapshot_version"), timestamp=take("snapshot_timestamp"), metadata=_metadata(noted), filter_pushdown=flag(take("filter-push-down", "false")), limit=number("limit"), write=change,
        buffer=number("sink.buffer-size", 1000), id_step=number("row-id-allocator.step", STEP), codec=names[codec], ignore_errors=flag(take("ignore-parse-errors", "false")),
        start_version=number("earliest.version"), start_timestamp=take("earliest.timestamp"), types=tuple(_TYPES[k] for k in kinds), schemas=take("schema.include"), tables=take("table.include"),
    )
    unknown = [k for k in own if not k.startswith(IGNORED_PREFIXES)]
    if unknown:
        raise ValueError(f"unknown options {sorted(unknown)}")
    made.rest.update(own)
    return made


def _metadata(text: str | None) -> bool | dict[str, str]:
    """``*`` for all by their own names, or ``name=other,name`` for some."""
    if not text:
        return False
    if text.strip() == "*":
        return True
    pairs = [p.partition("=") for p in text.split(",") if p.strip()]
    return {a.strip(): (b or a).strip() for a, _, b in pairs}
