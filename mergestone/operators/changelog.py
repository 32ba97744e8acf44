"""Change events to changelog rows, and changelogs to tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestone.functions import scalar
from mergestone.operators.ordered import greatest_before
from mergestone.operators.versions import as_of, timestamp_of
from mergestone.tabledef import ColumnDef, TableDef

ROW, DDL, RESOLVED = 1, 2, 3


def to_changelog(events: DataFrame, columns: Sequence[str], keep_noop: bool = False) -> DataFrame:
    """Events with structs ``old`` and ``new`` as rows of ``_change_type`` and the columns.

    Only new is an insert, only old a delete; both are a preimage and a
    postimage, left out if the two agree in all the columns.
    """
    pick = lambda side: F.struct(*[F.col(f"{side}.{c}").alias(c) for c in columns])
    row = lambda kind, side: F.struct(F.lit(kind).alias("_change_type"), F.lit(0 if kind == "update_preimage" else 1).alias("_step"), pick(side).alias("_row"))
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    if not keep_noop:
        events = events.filter(~(has_old & has_new & pick("old").eqNullSafe(pick("new"))))
    made = (
        F.when(has_old & has_new, F.array(row("update_preimage", "old"), row("update_postimage", "new")))
        .when(has_new, F.array(row("insert", "new")))
        .otherwise(F.array(row("delete", "old")))
    )
    rest = [c for c in events.columns if c not in ("old", "new")]
    out = events.filter(has_old | has_new).select(*rest, F.explode(made).alias("_c"))
    return out.select(*rest, "_c._change_type", "_c._step", *[F.col(f"_c._row.{c}").alias(c) for c in columns])


TYPE_NAMES = {ROW: "row_changed", DDL: "ddl", RESOLVED: "resolved"}


def typed(events: DataFrame, definition: TableDef, metadata: dict[str, str] | bool = False) -> DataFrame:
    """Decoded events with ``old`` and ``new`` as structs of a table's columns in its types, beside their other columns.

    Values come as text: numbers and dates are cast, TIME becomes an interval,
    binary is hexadecimal, numbers of ENUM and SET become their names.
    Timestamps are in UTC. metadata adds the columns of ``event_metadata``.
    """
    if metadata:
        events = event_metadata(events, metadata if isinstance(metadata, dict) else None)
    side = lambda name: F.when(F.col(name).isNotNull(), F.struct(*[_value(F.col(name)[c.name], c).alias(c.name) for c in definition.columns])).alias(name)
    return events.select(*[side(c) if c in ("old", "new") else F.col(f"`{c}`") for c in events.columns])


def _value(text: Column, c: ColumnDef) -> Column:
    kind, wanted = c.type.name, c.type.held
    if kind == "time":
        return F.make_dt_interval(secs=(scalar.duration_nanos(text) / 1_000_000_000).cast("decimal(18,6)"))
    if kind in ("binary", "varbinary", "tinyblob", "blob", "mediumblob", "longblob"):
        return F.unhex(text)
    if kind == "timestamp":
        return F.concat(text, F.lit("+00:00")).try_cast(wanted)
    if kind in ("date", "datetime"):
        return text.try_cast(wanted)  # the zero date is null
    if c.type.as_text:
        return scalar.wide_decimal(text, *c.type.digits, c.name)
    names = [F.lit(v) for v in c.type.arguments]
    number = text.try_cast("long")
    if kind == "enum" and names:
        return F.when(number.isNull(), text).otherwise(F.get(F.array(*names), (number - 1).cast("int")))
    if kind == "set" and names:
        picked = F.array_compact(F.array(*[F.when(F.shiftright(number, i).bitwiseAND(F.lit(1)) == 1, v) for i, v in enumerate(names)]))
        return F.when(number.isNull(), text).otherwise(F.array_join(picked, ","))
    if kind == "bit" and isinstance(wanted, T.BooleanType):
        return number == 1
    return text.cast(wanted)


def event_metadata(events: DataFrame, names: dict[str, str] | None = None) -> DataFrame:
    """Events with schema, table, commit_version, commit_timestamp, type, type_code, key, value and source_event; by other
    names, and only those, if a dictionary says which."""
    made = {
        "schema": F.col("schema"), "table": F.col("table"), "commit_version": F.col("commit_version"), "commit_timestamp": timestamp_of(F.col("commit_version")),
        "type": F.element_at(F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair]), F.col("type_code").cast("int")), "type_code": F.col("type_code").cast("int"),
        "key": F.to_json(F.struct(F.col("schema").alias("scm"), F.col("table").alias("tbl"), F.col("type_code").alias("t"), F.col("commit_version").alias("ts"))),
        "value": F.to_json(F.struct("old", "new", *[c for c in ("ddl",) if c in events.columns])), "source_event": F.lit("STREAMING"),
    }
    chosen = names or {k: k for k in made}
    if unknown := set(chosen) - set(made):
        raise ValueError(f"unknown metadata {sorted(unknown)}")
    taken = set(chosen.values())
    return events.select(*[F.col(f"`{c}`") for c in events.columns if c not in taken], *[made[k].alias(v) for k, v in chosen.items()])


def split_names(text: str | None) -> list[str]:
    """Names of an option, parted by commas, semicolons or bars, in lower case."""
    for mark in ";|":
        text = (text or "").replace(mark, ",")
    return [n.strip().lower() for n in text.split(",") if n.strip()]


def filter_events(
    events: DataFrame, start_version: int | None = None, types: Sequence[int] = (), schemas: str | None = None, tables: str | None = None
) -> DataFrame:
    """Events from ``start_version`` on (inclusive), of the types, schemas and tables; resolved events pass the last two."""
    if start_version is not None:
        events = events.filter(F.col("commit_version") >= start_version)
    if types:
        events = events.filter(F.col("type_code").isin(*types))
    for column, wanted in (("schema", split_names(schemas)), ("table", split_names(tables))):
        if wanted:
            events = events.filter((F.col("type_code") == RESOLVED) | F.lower(column).isin(*wanted))
    return events


def materialise(log: DataFrame, key: Sequence[str], sequence: Sequence[str] = ()) -> DataFrame:
    """The table that a changelog leaves: the last change of each key, unless it is a delete; preimages are ignored."""
    return as_of(log.filter("_change_type <> 'update_preimage'"), key, sequence=sequence)


def drop_replayed(events: DataFrame, objects: Sequence[str], arrival: str) -> DataFrame:
    """Row events in order of arrival, without those at or before a version that their object, or a resolved event, had reached.

    Resolved events reach for all objects of their stream and aren't returned.
    Streams and objects are cut along their arrival, so one of them may hold
    most events.
    """
    resolved = F.when(F.col("type_code") == RESOLVED, F.col("commit_version"))
    marked = greatest_before(events, ["stream"], arrival, resolved, "_resolved").filter(F.col("type_code") != RESOLVED)
    marked = greatest_before(marked, ["stream", *objects], arrival, F.col("commit_version"), "_own")
    reached: Column = F.greatest(F.coalesce("_own", F.lit(-1)), F.coalesce("_resolved", F.lit(-1)))
    return marked.filter(F.col("commit_version") > reached).drop("_resolved", "_own")


def fill_preimage(old: Column, new: Column) -> Column:
    """A preimage map that holds only the changed columns, with the others from the postimage map."""
    return F.map_concat(F.map_filter(new, lambda k, _: ~F.array_contains(F.map_keys(old), k)), old)


def drop_replayed_stream(events: DataFrame, objects: Sequence[str]) -> DataFrame:
    """``drop_replayed`` for a stream of events in order of arrival: kept rows of (stream, objects..., commit_version, payload).

    The state of a stream is the version its resolved events reached and the
    greatest version of each object since; objects that a resolved event has
    passed are forgotten.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    kind = ", ".join(f"{c} {events.schema[c].dataType.simpleString()}" for c in ("stream", *objects, "commit_version", "payload"))
    names = ["stream", *objects, "commit_version", "payload"]

    def step(key, batches, state):
        reached, seen = (state.get[0], dict(state.get[1])) if state.exists else (-1, {})
        out = []
        for batch in batches:
            for row in batch.sort_values("arrival").itertuples(index=False):
                version = int(row.commit_version)
                if row.type_code == RESOLVED:
                    reached = max(reached, version)
                    seen = {k: v for k, v in seen.items() if v > reached}
                    continue
                one = "\x00".join(str(getattr(row, c)) for c in objects)
                if version > max(reached, seen.get(one, -1)):
                    seen[one] = version
                    out.append([getattr(row, c) for c in names])
        state.update((reached, seen))
        yield pd.DataFrame(out, columns=names)

    return events.groupBy("stream").applyInPandasWithState(step, kind, "reached long, seen map<string,long>", "append", GroupStateTimeout.NoTimeout)
