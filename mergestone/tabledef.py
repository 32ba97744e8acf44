"""Table definitions: typed columns, keys, partitioning, generated ids; and bringing rows to them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mergestone import types
from mergestone.functions import scalar


@dataclass(frozen=True)
class ColumnDef:
    name: str
    type: types.MySQLType
    nullable: bool = True
    auto_increment: bool = False
    auto_random: int = 0  # shard bits of generated ids; none if 0

    @property
    def field(self) -> T.StructField:
        noted = {"mysql_type": self.type.name, "unsigned": self.type.unsigned}
        if self.type.name in ("enum", "set"):
            noted["values"] = list(self.type.arguments)
        return T.StructField(self.name, self.type.held, self.nullable, noted)


@dataclass(frozen=True)
class TableDef:
    """Column names are kept in lower case. ``unique`` holds the unique keys besides the primary key."""

    name: str
    columns: tuple[ColumnDef, ...]
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    partitioning: object = None
    comment: str = field(default="", compare=False)

    @staticmethod
    def of(name: str, columns: dict[str, str], primary_key=(), unique=(), partitioning=None) -> "TableDef":
        """Columns as name → type text, which may end in NOT NULL and AUTO_INCREMENT or AUTO_RANDOM(shard bits)."""
        out = []
        for column, text in columns.items():
            upper = text.upper()
            shards = re.search(r"\s*AUTO_RANDOM(?:\((\d+)\))?", upper)
            kind = upper.replace("NOT NULL", "").replace("AUTO_INCREMENT", "").replace(shards[0] if shards else " AUTO_RANDOM", "").strip()
            kind = text[: len(kind)] if "(" in kind else kind
            low = column.lower()
            out.append(ColumnDef(low, types.parse(kind), "NOT NULL" not in upper and low not in primary_key, "AUTO_INCREMENT" in upper, int(shards[1] or 5) if shards else 0))
        made = TableDef(name.lower(), tuple(out), tuple(c.lower() for c in primary_key), tuple(tuple(c.lower() for c in k) for k in unique), partitioning)
        for key in made.keys:
            if missing := set(key) - set(made.column_names):
                raise ValueError(f"key columns {sorted(missing)} are not columns of {name}")
        made.check_ordered([partitioning.column] if partitioning else [])
        return made

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def keys(self) -> list[tuple[str, ...]]:
        return ([self.primary_key] if self.primary_key else []) + list(self.unique)

    @property
    def type_names(self) -> dict[str, str]:
        """MySQL type name of each column, as predicates want them; an unsigned integer goes by a signed type that holds it."""
        wider = {"tinyint": "smallint", "smallint": "int", "mediumint": "int", "int": "bigint", "bigint": "decimal"}
        return {c.name: wider[c.type.name] if c.type.unsigned else c.type.name for c in self.columns}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([c.field for c in self.columns])

    def dedup_keys(self, generated: bool) -> list[tuple[str, ...]]:
        """The keys that rows of a batch can collide on; those with a generated id can't."""
        auto = {c.name for c in self.columns if c.auto_increment or c.auto_random}
        return [k for k in self.keys if not (generated and auto & set(k))]

    def check_ordered(self, names) -> None:
        """Decimals that are kept as text are equal as text, but not in its order."""
        if found := sorted({c.name for c in self.columns if c.type.as_text} & {n.lower() for n in names}):
            raise ValueError(f"columns {found} have more than 38 digits and can't be compared or ordered")

    def check_columns(self, frame: DataFrame) -> None:
        """A full-row write needs exactly these columns, in this order."""
        if [c.lower() for c in frame.columns] != self.column_names:
            raise ValueError(f"{self.name} has columns {self.column_names}, not {frame.columns}")

    def conform(self, frame: DataFrame, others: tuple[str, ...] = ()) -> DataFrame:
        """The frame's columns in the table's types; out-of-range numbers, unknown ENUM values and nulls in NOT NULL columns raise. ``others`` are kept as they are."""
        out = []
        for c in self.columns:
            value = F.col(c.name)
            given = frame.schema[next(f for f in frame.columns if f.lower() == c.name)].dataType
            if c.type.bounds and not isinstance(given, (T.StringType, T.BinaryType)):
                low, high = c.type.bounds
                if not isinstance(given, T.BooleanType):
                    value = F.when(value.between(*[F.lit(str(b)).cast("decimal(20,0)") for b in (low, high)]) | value.isNull(), value).otherwise(
                        F.raise_error(F.lit(f"value out of range for column {c.name}"))
                    )
            if c.type.name == "enum":
                values = F.array(*[F.lit(v) for v in c.type.arguments])
                if isinstance(given, T.IntegralType):
                    value = F.element_at(values, value.cast("int"))
                value = F.when(F.array_contains(values, value) | value.isNull(), value).otherwise(F.raise_error(F.lit(f"unknown value for enum column {c.name}")))
            if c.type.name == "binary" and c.type.arguments:
                value = F.rpad(value.cast("binary"), int(c.type.arguments[0]), F.lit(b"\x00"))
            if c.type.name in ("timestamp", "datetime") and isinstance(given, T.StringType):
                value = value.try_cast(c.type.spark)  # the zero date is null
            if c.type.as_text:
                value = scalar.wide_decimal(value.cast("int") if isinstance(given, T.BooleanType) else value, *c.type.digits, c.name)
            value = value.cast(c.type.held)
            if not c.nullable and not c.auto_increment and not c.auto_random:
                value = F.coalesce(value, F.raise_error(F.lit(f"null in NOT NULL column {c.name}")).cast(c.type.held))
            out.append(value.alias(c.name))
        return frame.select(*out, *others)


def all_present(key: tuple[str, ...]) -> Column:
    """Whether no part of a key is null; a key with a null part never collides."""
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
