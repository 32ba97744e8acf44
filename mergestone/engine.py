"""Tables as a user meets them: typed, keyed, versioned; read by snapshot, written by mode."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mergestone.functions import parser, predicates, scalar
from mergestone.operators import dedup, partition, rowid, versions, write
from mergestone.tabledef import TableDef

#: Transactions of a write: a bounded set of rows, or one batch of a stream; either is published as one version.
GLOBAL, MINIBATCH = "global", "minibatch"
UPDATE = "update"
#: Scans of a read from which a write rewrites the table as one layer: a row is rewritten once in so many writes.
MOST_SCANS = 32


@dataclass(frozen=True)
class WriteOptions:
    """mode: append, upsert (every row that collides goes) or update (insert, or on a duplicate key update). deduplicate: of colliding rows of a batch the last stays, in order of ``sequence``.

    update_columns: only these are written over, for upserts by the one key.
    deletes: rows whose ``change_col`` is delete remove the row they name.
    ignore_given_ids: generated ids replace given ones.
    """

    mode: str = write.APPEND
    transaction: str = GLOBAL
    deduplicate: bool = False
    sequence: tuple[str, ...] = ()
    update_columns: tuple[str, ...] = ()
    skip_check: bool = False
    deletes: bool = False
    change_col: str = "_change_type"
    ignore_given_ids: bool = False

    def check(self) -> None:
        if self.mode not in (write.APPEND, write.UPSERT, UPDATE):
            raise ValueError(f"unknown write mode {self.mode}")
        if self.transaction not in (GLOBAL, MINIBATCH):
            raise ValueError(f"the transaction {self.transaction} is not supported")
        if self.deletes and (self.mode != write.UPSERT or self.transaction != MINIBATCH):
            raise ValueError("deletes need the write mode upsert and the transaction minibatch")
        if self.deduplicate and not self.sequence:
            raise ValueError("deduplication needs the columns that say which row is the last")


class Table:
    """A table in a folder. Versions are milliseconds times 2^18; a read without one sees the newest."""

    def __init__(self, spark: SparkSession, path: str, definition: TableDef) -> None:
        self.spark, self.definition = spark, definition
        self.store = versions.VersionedTable(spark, path)

    def create(self) -> "Table":
        """The empty table as the first version."""
        empty = self.spark.createDataFrame([], self.definition.schema)
        self.store.commit(self._placed(empty), 1, self._folders(), notes={"last_id": 0})
        return self

    def _folders(self) -> list[str]:
        return [partition.COLUMN] if self.definition.partitioning else []

    def _placed(self, rows: DataFrame) -> DataFrame:
        return partition.routed(rows, self.definition.partitioning) if self.definition.partitioning else rows

    def version_at(self, version: int | None = None, timestamp: str | None = None) -> int | None:
        """A version goes before a timestamp (ISO, with zone); all of the timestamp's millisecond counts."""
        if version is not None or timestamp is None:
            return version
        first = self.spark.range(1).select(versions.version_of(F.to_timestamp(F.lit(timestamp))).alias("v")).first()["v"]
        return first + (1 << versions.COUNTER_BITS) - 1

    def read(
        self,
        columns: Sequence[str] | None = None,
        where=None,
        between: tuple | None = None,
        partitions: Sequence[int] | None = None,
        limit: int | None = None,
        version: int | None = None,
        timestamp: str | None = None,
        metadata: dict[str, str] | bool = False,
    ) -> DataFrame:
        """Rows of a snapshot.

        where is a condition as text, a predicate tree or a Column; of a partitioned table text or a tree, or
        between, (low, high) of the partition column, reads only the folders that
        can hold such rows; partitions names folders by number. metadata adds
        the version, its time and the source, by other names if a dictionary.
        """
        at = self.version_at(version, timestamp)
        rows, parted = self.store.read(at), self.definition.partitioning
        if isinstance(where, str):
            where = parser.parse(where)
        tree = None if where is None or isinstance(where, Column) else predicates.normalise(where, self.definition.type_names)
        self.definition.check_ordered(predicates.compared(tree))
        if not parted and (between or partitions is not None):
            raise ValueError(f"{self.definition.name} has no partitions")
        if parted:
            if between:
                rows = partition.pruned(rows, parted, *between)
            if partitions is not None:
                rows = partition.only(rows, partitions)
            if tree is not None:
                rows = partition.matching(rows, parted, tree)
            rows = rows.drop(partition.COLUMN)
        if where is not None and not (parted and tree is not None):
            rows = rows.filter(where if tree is None else predicates.column(tree))
        if columns is not None:
            rows = rows.select(*[c.lower() for c in columns])
        if limit is not None:
            rows = rows.limit(limit)
        if metadata:
            held = self.store.manifest(at)["version"]
            names = metadata if isinstance(metadata, dict) else {}
            rows = versions.with_metadata(rows.withColumn("_version", F.lit(held).cast("long")), version_col="_version", names=names)
        return rows

    def write(self, rows: DataFrame, options: WriteOptions = WriteOptions()) -> int:
        """Publishes a version with the rows written; its number."""
        options.check()
        self.definition.check_ordered(options.sequence)
        definition, keys = self.definition, self.definition.keys
        if {"commit_version", "commit_timestamp", "source_event"} & set(rows.columns):
            raise ValueError("rows with metadata columns are read-only")
        before = self.store.manifest()
        target = self.read()
        changes = options.change_col in rows.columns
        extra = [c for c in (options.change_col, *options.sequence) if c in rows.columns and c not in definition.column_names]
        definition.check_columns(rows.drop(*extra))
        kinds = definition.conform(rows, tuple(extra))
        kinds, last_id = self._with_ids(kinds, before["last_id"], options)
        if options.deduplicate:
            kinds = dedup.last_wins(kinds, definition.dedup_keys(options.ignore_given_ids), options.sequence)
        else:
            dedup.reject_duplicates(kinds.filter(F.col(options.change_col) != "update_preimage") if changes else kinds, keys)
        names = definition.column_names
        gone: dict = {}
        if options.update_columns:
            key = write.check_partial(definition, options.update_columns, options.mode, options.skip_check)
            put = write.merged_partial(target, kinds.select(*names), key, [c.lower() for c in options.update_columns])
            gone = {key: kinds.select(*key)}
        elif changes:
            put, away = write.split_changes(kinds, keys, options.sequence or (options.change_col,), options.change_col, options.deletes, options.mode)
            put = put.select(*names)
            gone = write.taken_by(put, away, keys)
        else:
            put = kinds.select(*names)
            if options.mode == write.APPEND:
                if not write.conflicts(target, put, keys).isEmpty():
                    raise ValueError("rows collide with existing ones on a unique key; use upsert")
            elif options.mode == write.UPSERT or len(keys) <= 1:
                gone = write.taken_by(put, None, keys)
        version = max(int(time.time() * 1000) << versions.COUNTER_BITS, before["version"] + 1)
        publish = dict(partition_by=self._folders(), expected=before["version"], notes={"last_id": last_id})
        if options.mode == UPDATE and len(keys) > 1:  # which row is updated depends on the table's rows: all are written
            self.store.commit(self._placed(write.update_upsert(target, put, keys)), version, **publish)
        else:
            self.store.add(self._placed(put), version, gone, **publish)
        if self.store.scans() >= MOST_SCANS:
            version += 1
            self.store.compact(version)
        return version

    def expire(self, keep: int) -> None:
        """Only the newest ``keep`` versions can be read from now on; what only others need is deleted."""
        self.store.expire(keep)

    def _with_ids(self, rows: DataFrame, last_id: int, options: WriteOptions) -> tuple[DataFrame, int]:
        auto = next((c for c in self.definition.columns if c.auto_increment or c.auto_random), None)
        if auto is None:
            return rows, last_id
        # rows are numbered once and written, as a second run of the same input may come in another order
        order = self._held(rows.withColumn("_order", F.monotonically_increasing_id()))
        n = order.count()
        bits = auto.type.bounds[1].bit_length()
        shards = auto.auto_random or 0
        allocator = rowid.Allocator(last_id, bits=bits - shards)
        first, last = allocator.take(n) if n else (last_id + 1, last_id)
        rowid.check_shards(shards, auto.type.unsigned, last)
        given = F.col(auto.name)
        if shards and not options.ignore_given_ids:
            order = order.withColumn(auto.name, F.when(given.isNull(), given).otherwise(F.raise_error(F.lit(f"{auto.name} is generated: leave it null or ignore given ids")).cast(given_type(order, auto.name))))
        made = rowid.with_auto_id(order.withColumn("_given", F.col(auto.name).cast("long")), "_given", "_order", base=first - 1, ignore_given=options.ignore_given_ids)
        value = F.col("_given")
        if shards:
            value = rowid.sharded(value, F.xxhash64(F.lit(first), F.spark_partition_id()), shards, auto.type.unsigned)
        if auto.type.unsigned:
            value = scalar.unsigned_long(value)
        made = self._held(made.withColumn(auto.name, value.cast(auto.type.spark)).select(*rows.columns))
        return made, last

    def _held(self, rows: DataFrame) -> DataFrame:
        """The rows, written in a folder that no manifest names."""
        place = f"{self.store.path}/_staged-{uuid.uuid4().hex}"
        rows.write.parquet(place)
        return self.spark.read.schema(rows.schema).parquet(place)


def given_type(rows: DataFrame, column: str) -> str:
    return rows.schema[column].dataType.simpleString()
