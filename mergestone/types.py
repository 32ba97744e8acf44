"""MySQL column types as Spark types."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import types as T

_PATTERN = re.compile(r"^\s*([a-z]+)\s*(?:\(([^)]*)\))?\s*((?:unsigned|signed|zerofill|\s)*)$", re.I)
#: Names that mean the same type, or one Spark type whatever the length.
ALIASES = {"bool": "boolean", "integer": "int", "dec": "decimal", "numeric": "decimal", "real": "double", "newdate": "date"}
PLAIN = {
    "boolean": T.ByteType(), "year": T.ShortType(), "float": T.FloatType(), "double": T.DoubleType(), "date": T.DateType(),
    "datetime": T.TimestampNTZType(), "timestamp": T.TimestampType(), "time": T.DayTimeIntervalType(), "json": T.StringType(),
    "char": T.StringType(), "varchar": T.StringType(), "tinytext": T.StringType(), "text": T.StringType(), "mediumtext": T.StringType(), "longtext": T.StringType(),
    "enum": T.StringType(), "set": T.StringType(), "binary": T.BinaryType(), "varbinary": T.BinaryType(), "tinyblob": T.BinaryType(),
    "blob": T.BinaryType(), "mediumblob": T.BinaryType(), "longblob": T.BinaryType(), "null": T.NullType(),
}
#: Signed and unsigned type of each integer, and its bits.
INTEGERS = {
    "tinyint": (T.ByteType(), T.ShortType(), 8), "smallint": (T.ShortType(), T.IntegerType(), 16), "mediumint": (T.IntegerType(), T.LongType(), 24),
    "int": (T.IntegerType(), T.LongType(), 32), "bigint": (T.LongType(), T.DecimalType(20, 0), 64),
}


@dataclass(frozen=True)
class MySQLType:
    """A parsed column type; ``arguments`` are the length, precision and scale, or the values of ENUM and SET."""

    name: str
    arguments: tuple[str, ...] = field(default=())
    unsigned: bool = False

    @property
    def spark(self) -> T.DataType:
        if self.name in INTEGERS:
            return INTEGERS[self.name][self.unsigned]
        if self.name == "bit":
            return T.BooleanType() if int(self.arguments[0] if self.arguments else 1) == 1 else T.LongType()
        if self.name == "decimal":
            precision, scale = self.digits
            if precision > 38:
                raise ValueError(f"DECIMAL({precision}) has more digits than Spark's 38")
            return T.DecimalType(precision, scale)
        if self.name in PLAIN:
            return PLAIN[self.name]
        raise ValueError(f"no Spark type for {self.name.upper()}")

    @property
    def digits(self) -> tuple[int, int]:
        """Precision and scale of DECIMAL."""
        return (*map(int, self.arguments), 0)[:2] if self.arguments else (10, 0)

    @property
    def as_text(self) -> bool:
        """Whether it is a DECIMAL of more than Spark's 38 digits: its values are exact text, with every digit of the scale."""
        return self.name == "decimal" and self.digits[0] > 38

    @property
    def held(self) -> T.DataType:
        """The Spark type of a table's column: text for a DECIMAL that no Spark type fits."""
        if not self.as_text:
            return self.spark
        precision, scale = self.digits
        if precision > 65 or scale > 30:
            raise ValueError(f"DECIMAL({precision},{scale}) has more digits than MySQL's 65, or 30 after the point")
        return T.StringType()

    @property
    def bounds(self) -> tuple[int, int] | None:
        """Least and greatest value of integer types, YEAR and BIT."""
        if self.name in INTEGERS:
            bits = INTEGERS[self.name][2]
            return (0, 2**bits - 1) if self.unsigned else (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)
        if self.name == "year":
            return (0, 2155)
        if self.name == "bit" and self.arguments and int(self.arguments[0]) > 1:
            return (0, min(2 ** int(self.arguments[0]), 2**63) - 1)
        return None


def parse(text: str) -> MySQLType:
    m = _PATTERN.match(text)
    if m is None:
        raise ValueError(f"not a column type: {text!r}")
    name = ALIASES.get(m[1].lower(), m[1].lower())
    arguments = tuple(a.strip().strip("'") for a in m[2].split(",")) if m[2] else ()
    return MySQLType(name, arguments, "unsigned" in m[3].lower())


def render(kind: T.DataType) -> str:
    """The MySQL type that a Spark type is stored as."""
    names = {
        T.BooleanType: "BOOLEAN", T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT", T.FloatType: "FLOAT",
        T.DoubleType: "DOUBLE", T.DateType: "DATE", T.TimestampType: "TIMESTAMP(6)", T.TimestampNTZType: "DATETIME(6)", T.StringType: "LONGTEXT",
        T.BinaryType: "LONGBLOB", T.DayTimeIntervalType: "TIME(6)",
    }
    if isinstance(kind, T.DecimalType):
        return f"DECIMAL({kind.precision},{kind.scale})"
    for spark, name in names.items():
        if isinstance(kind, spark):
            return name
    raise ValueError(f"no MySQL type for {kind.simpleString()}")
