"""Keyed writes as algebra over a target and a source frame: append, upserts, partial upsert, delete, changes.

Each function returns the table's new rows; ``VersionedTable`` publishes them.
A key with a null part matches nothing, as in SQL joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mergestone.operators.dedup import Key, last_wins, reject_duplicates
from mergestone.tabledef import TableDef, all_present

APPEND, UPSERT = "append", "upsert"


def conflicts(target: DataFrame, source: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Source rows that collide with a target row on any key."""
    out = None
    for key in keys:
        hit = source.join(target.select(*key).distinct(), list(key), "left_semi").select(*source.columns)
        out = hit if out is None else out.unionByName(hit)
    return source.limit(0) if out is None else out.distinct()


def append(target: DataFrame, source: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Target and source together; an error if a source row collides with the target or within the source."""
    reject_duplicates(source, keys)
    if not conflicts(target, source, keys).isEmpty():
        raise ValueError("rows collide with existing ones on a unique key; use upsert")
    return target.unionByName(source)


def replace_upsert(target: DataFrame, source: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Every target row that collides with a source row on any key goes; then the source is added whole."""
    kept = target
    for key in keys:
        kept = kept.join(source.select(*key).distinct(), list(key), "left_anti").select(*target.columns)
    return kept.unionByName(source)


def update_upsert(target: DataFrame, source: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Insert, or on a duplicate key update: a source row overwrites the one target row that it matches on the first
    key that matches, and is added if none does. With a single key this is ``replace_upsert``."""
    if len(keys) <= 1:
        return replace_upsert(target, source, keys)
    left = source.withColumn("_row", F.monotonically_increasing_id())
    open_rows, out, touched = left, None, None
    for key in keys:
        hit = open_rows.join(target.select(*key).distinct(), list(key), "left_semi").select(*left.columns)
        touched_now = target.join(hit.select(*key).distinct(), list(key), "left_semi").select(*target.columns)
        touched = touched_now if touched is None else touched.unionByName(touched_now)
        out = hit if out is None else out.unionByName(hit)
        open_rows = open_rows.join(hit.select("_row"), "_row", "left_anti").select(*left.columns)
    kept = target.exceptAll(touched.distinct())
    return kept.unionByName(out.drop("_row")).unionByName(open_rows.drop("_row"))


def check_partial(table: TableDef, update_columns: Sequence[str], mode: str, skip: bool = False) -> tuple[str, ...]:
    """The key of a partial-column upsert, or an error if the write isn't allowed."""
    update = [c.lower() for c in update_columns]
    if unknown := set(update) - set(table.column_names):
        raise ValueError(f"unknown update columns {sorted(unknown)}")
    if mode != UPSERT:
        raise ValueError("update columns need the write mode upsert")
    if not table.keys:
        raise ValueError("update columns need a primary or unique key")
    key = table.keys[0]
    if skip:
        return key
    if len(table.keys) > 1:
        raise ValueError("update columns need exactly one primary or unique key")
    nullable = {c.name for c in table.columns if c.nullable}
    if nullable & set(key):
        raise ValueError("the key's columns must be NOT NULL")
    if not set(key) <= set(update):
        raise ValueError("the update columns must include the key")
    return key


def partial_upsert(target: DataFrame, source: DataFrame, key: Key, update_columns: Sequence[str]) -> DataFrame:
    """Only the update columns are written: over a matching row's, or into a new row whose other columns are null."""
    update = [c for c in target.columns if c in set(update_columns) | set(key)]
    given = source.select(*[F.col(c).alias(f"_s_{c}") for c in update], F.lit(True).alias("_given"))
    on = [F.col(c) == F.col(f"_s_{c}") for c in key]
    both = target.join(given, on, "full_outer")
    return both.select(*[F.when(F.col("_given"), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in update else F.col(c) for c in target.columns])


def delete_key(table: TableDef) -> list[tuple[str, ...]]:
    if not table.keys:
        raise ValueError("a delete needs a primary or unique key")
    return table.keys


def delete(target: DataFrame, gone: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Without the target rows that a row of ``gone`` names by its first key that has no null; unknown rows are ignored."""
    kept, rest = target, gone
    for key in keys:
        named = rest.filter(all_present(tuple(key)))
        kept = kept.join(named.select(*key).distinct(), list(key), "left_anti").select(*target.columns)
        rest = rest.filter(~all_present(tuple(key)))
    return kept


def split_changes(changes: DataFrame, keys: Sequence[Key], sequence: Sequence[str], change_col: str = "_change_type", deletes: bool = True, mode: str = UPSERT) -> tuple[DataFrame, DataFrame]:
    """(rows to put, rows to delete) of a changelog: preimages are ignored, the last change of each row counts, deletes only if enabled."""
    if deletes and mode != UPSERT:
        raise ValueError("deletes need the write mode upsert")
    live = changes.filter(F.col(change_col) != "update_preimage")
    if not deletes:
        live = live.filter(F.col(change_col) != "delete")
    last = last_wins(live, keys, sequence)
    return last.filter(F.col(change_col) != "delete"), last.filter(F.col(change_col) == "delete")


def apply_changes(
    target: DataFrame, changes: DataFrame, keys: Sequence[Key], sequence: Sequence[str], change_col: str = "_change_type", deletes: bool = True, mode: str = UPSERT
) -> DataFrame:
    """The target after a changelog."""
    put, gone = (x.select(*target.columns) for x in split_changes(changes, keys, sequence, change_col, deletes, mode))
    return delete(replace_upsert(target, put, keys), gone, keys)


def taken_by(put: DataFrame | None, gone: DataFrame | None, keys: Sequence[Key]) -> dict[tuple[str, ...], DataFrame]:
    """By key, the values whose rows a write takes away: all keys of rows put, and of rows deleted the first key without a null."""
    out: dict[tuple[str, ...], DataFrame] = {}
    rest = gone
    for key in keys:
        parts = [] if put is None else [put.select(*key)]
        if rest is not None:
            parts.append(rest.filter(all_present(tuple(key))).select(*key))
            rest = rest.filter(~all_present(tuple(key)))
        if parts:
            out[tuple(key)] = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out


def merged_partial(target: DataFrame, source: DataFrame, key: Key, update_columns: Sequence[str]) -> DataFrame:
    """The rows of ``partial_upsert`` that the source names: updated ones whole, and new ones."""
    hit = target.join(source.select(*key).distinct(), list(key), "left_semi").select(*target.columns)
    return partial_upsert(hit, source, key, update_columns)
