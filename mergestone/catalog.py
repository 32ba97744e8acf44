"""A catalog of typed, keyed tables over Spark's own: definitions are kept as table properties."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from mergestone import options as opts
from mergestone import types
from mergestone.engine import Table
from mergestone.operators import partition
from mergestone.tabledef import ColumnDef, TableDef

BUILT_IN = {"information_schema", "performance_schema", "mysql", "sys"}
PROPERTY, PLACE = "mergestone.definition", "mergestone.place"


def quoted(*names: str) -> str:
    return ".".join("`" + n.replace("`", "``") + "`" for n in names)


class Catalog:
    """Names are lower case. Dropping and renaming columns rewrite the table, as Parquet tables can't do it in place.

    ``create_versioned`` makes tables of the engine, which keep versions and are
    written by mode; ``open`` and ``sql`` read both kinds. properties are
    options for all tables, which a statement's own override.
    """

    def __init__(self, spark: SparkSession, show_built_in: bool = False, properties: Mapping[str, str] | None = None) -> None:
        self.spark, self.show_built_in, self.properties = spark, show_built_in, dict(properties or {})
        opts.parse(self.properties)  # unknown ones fail here

    def create_versioned(self, database: str, table: TableDef, path: str | None = None) -> Table:
        """An empty versioned table, at a path or in the database's folder; the catalog keeps its definition and place."""
        if path is None:
            place = self.spark.sql(f"DESCRIBE DATABASE {quoted(database.lower())}").filter("info_name = 'Location'").first()["info_value"]
            path = f"{place.rstrip('/')}/{table.name}-{uuid.uuid4().hex}"
        made = Table(self.spark, path, table).create()
        self.create_table(database, table)
        self.spark.sql(f"ALTER TABLE {quoted(database.lower(), table.name)} SET TBLPROPERTIES ('{PLACE}' = '{path.encode().hex()}')")
        return made

    def open(self, database: str, table: str) -> Table:
        """The versioned table of that name."""
        held = self._properties(database, table).get(PLACE)
        if held is None:
            raise ValueError(f"{database}.{table} has no versions")
        return Table(self.spark, bytes.fromhex(held).decode(), self.definition(database, table))

    def read(self, database: str, table: str, hint: Mapping[str, str] | None = None, where=None) -> DataFrame:
        """Rows of either kind of table; the options may choose a snapshot, metadata columns and a limit."""
        chosen = opts.parse(self.properties, hint)
        if PLACE in self._properties(database, table):
            return self.open(database, table).read(where=where, version=chosen.version, timestamp=chosen.timestamp, metadata=chosen.metadata, limit=chosen.limit)
        if chosen.version is not None or chosen.timestamp is not None or chosen.metadata:
            raise ValueError(f"{database}.{table} has no versions")
        rows = self.spark.table(quoted(database.lower(), table.lower()))
        return rows if chosen.limit is None else rows.limit(chosen.limit)

    def write(self, database: str, table: str, rows: DataFrame, hint: Mapping[str, str] | None = None) -> int:
        """Writes to a versioned table by the options; its new version."""
        return self.open(database, table).write(rows, opts.parse(self.properties, hint).write)

    def sql(self, text: str) -> DataFrame:
        """A query over tables named ``database.table``, each with options of its own behind it:
        ``FROM shop.users /*+ OPTIONS('snapshot_version'='5') */ u``. Names of no table here stay as they are."""

        def view(found: re.Match) -> str:
            database, table = found[1].strip("`"), found[2].strip("`")
            if not self.table_exists(database, table):
                return found[0]
            hint = dict(re.findall(r"'([^']*)'\s*=\s*'([^']*)'", found[3] or ""))
            name = f"_mergestone_{uuid.uuid4().hex}"
            self.read(database, table, hint).createOrReplaceTempView(name)
            views.append(name)
            return name

        views: list[str] = []
        out = self.spark.sql(re.sub(r"(`[^`]+`|\b[A-Za-z_]\w*)\.(`[^`]+`|[A-Za-z_]\w*)(\s*/\*\+\s*OPTIONS\s*\(.*?\)\s*\*/)?", view, text, flags=re.I | re.S))
        for name in views:  # the frame has resolved them
            self.spark.catalog.dropTempView(name)
        return out

    def _properties(self, database: str, table: str) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {quoted(database.lower(), table.lower())}").collect()}

    def list_databases(self) -> list[str]:
        names = sorted(d.name.lower() for d in self.spark.catalog.listDatabases())
        return [n for n in names if self.show_built_in or n not in BUILT_IN]

    def database_exists(self, name: str) -> bool:
        return name.lower() in self.list_databases()

    def create_database(self, name: str, ignore_if_exists: bool = False) -> None:
        self.spark.sql(f"CREATE DATABASE {'IF NOT EXISTS ' * ignore_if_exists}{quoted(name.lower())}")

    def drop_database(self, name: str, ignore_if_missing: bool = False, cascade: bool = False) -> None:
        self.spark.sql(f"DROP DATABASE {'IF EXISTS ' * ignore_if_missing}{quoted(name.lower())}{' CASCADE' * cascade}")

    def list_tables(self, database: str) -> list[str]:
        return sorted(t.name.lower() for t in self.spark.catalog.listTables(database.lower()) if not t.isTemporary)

    def table_exists(self, database: str, table: str) -> bool:
        return self.database_exists(database) and table.lower() in self.list_tables(database)

    def create_table(self, database: str, table: TableDef, ignore_if_exists: bool = False) -> None:
        columns = ", ".join(f"{quoted(c.name)} {c.type.held.simpleString()}{' NOT NULL' * (not c.nullable)}" for c in table.columns)
        self.spark.sql(
            f"CREATE TABLE {'IF NOT EXISTS ' * ignore_if_exists}{quoted(database.lower(), table.name)} ({columns}) USING parquet "
            f"TBLPROPERTIES ('{PROPERTY}' = '{self._dump(table)}')"
        )

    def definition(self, database: str, table: str) -> TableDef:
        held = self._properties(database, table).get(PROPERTY)
        if held is not None:
            return self._load(held)
        schema = self.spark.table(quoted(database.lower(), table.lower())).schema
        return TableDef(table.lower(), tuple(ColumnDef(f.name.lower(), types.parse(types.render(f.dataType)), f.nullable) for f in schema))

    def drop_table(self, database: str, table: str, ignore_if_missing: bool = False) -> None:
        self.spark.sql(f"DROP TABLE {'IF EXISTS ' * ignore_if_missing}{quoted(database.lower(), table.lower())}")

    def rename_table(self, database: str, table: str, to: str) -> None:
        held = self.definition(database, table)
        self.spark.sql(f"ALTER TABLE {quoted(database.lower(), table.lower())} RENAME TO {quoted(database.lower(), to.lower())}")
        self._keep(database, replace(held, name=to.lower()))

    def add_column(self, database: str, table: str, column: str, kind: str) -> None:
        held, made = self.definition(database, table), ColumnDef(column.lower(), types.parse(kind))
        self.spark.sql(f"ALTER TABLE {quoted(database.lower(), table.lower())} ADD COLUMNS ({quoted(made.name)} {made.type.held.simpleString()})")
        self._keep(database, replace(held, columns=(*held.columns, made)))

    def drop_column(self, database: str, table: str, column: str) -> None:
        held, low = self.definition(database, table), column.lower()
        if any(low in k for k in held.keys) or getattr(held.partitioning, "column", None) == low:
            raise ValueError(f"{column} is part of a key or of the partitioning")
        self._rewrite(database, held, replace(held, columns=tuple(c for c in held.columns if c.name != low)), {})

    def rename_column(self, database: str, table: str, column: str, to: str) -> None:
        held, old, new = self.definition(database, table), column.lower(), to.lower()
        swap = lambda names: tuple(new if n == old else n for n in names)
        columns = tuple(replace(c, name=new) if c.name == old else c for c in held.columns)
        parted = replace(held.partitioning, column=new) if getattr(held.partitioning, "column", None) == old else held.partitioning
        self._rewrite(database, held, replace(held, columns=columns, primary_key=swap(held.primary_key), unique=tuple(map(swap, held.unique)), partitioning=parted), {old: new})

    def primary_key(self, database: str, table: str) -> tuple[str, ...]:
        return self.definition(database, table).primary_key

    def unique_keys(self, database: str, table: str) -> list[tuple[str, ...]]:
        return list(self.definition(database, table).unique)

    def count(self, database: str, table: str) -> int:
        return self.spark.table(quoted(database.lower(), table.lower())).count()

    def _rewrite(self, database: str, held: TableDef, made: TableDef, renamed: dict[str, str]) -> None:
        if PLACE in self._properties(database, held.name):
            raise ValueError("columns of versioned tables stay, as their old versions have them")
        staged, old = f"{held.name}__rewritten", f"{held.name}__before"
        self.create_table(database, replace(made, name=staged))
        rows = self.spark.table(quoted(database.lower(), held.name)).withColumnsRenamed(renamed).select(*made.column_names)
        rows.write.insertInto(quoted(database.lower(), staged))
        # the old table goes when the new one is in its place
        self.rename_table(database, held.name, old)
        self.rename_table(database, staged, held.name)
        self.drop_table(database, old)

    def _keep(self, database: str, table: TableDef) -> None:
        self.spark.sql(f"ALTER TABLE {quoted(database.lower(), table.name)} SET TBLPROPERTIES ('{PROPERTY}' = '{self._dump(table)}')")

    @staticmethod
    def _dump(table: TableDef) -> str:
        columns = [[c.name, c.type.name, list(c.type.arguments), c.type.unsigned, c.nullable, c.auto_increment, c.auto_random] for c in table.columns]
        text = json.dumps({"name": table.name, "columns": columns, "primary_key": table.primary_key, "unique": table.unique, "partitioning": partition.dump(table.partitioning)})
        return text.encode().hex()  # free of quotes

    @staticmethod
    def _load(text: str) -> TableDef:
        d = json.loads(bytes.fromhex(text))
        columns = tuple(ColumnDef(n, types.MySQLType(k, tuple(a), u), nullable, auto, shards) for n, k, a, u, nullable, auto, shards in d["columns"])
        return TableDef(d["name"], columns, tuple(d["primary_key"]), tuple(tuple(k) for k in d["unique"]), partition.load(d["partitioning"]))
