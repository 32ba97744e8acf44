"""All queries of the table engine, by name, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mergestone.plans import changes, relational, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

for _part in (relational, tables, changes):
    QUERIES.update(_part.QUERIES)
    ORACLE_SQL.update(_part.ORACLE_SQL)
