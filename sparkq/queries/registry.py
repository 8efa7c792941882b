"""The two tables behind ``queries()`` and ``oracle_sql()``."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sparkq.operators.params import QuerySpec, run_query
from sparkq.sources.views import CALL_LOG_SQL, LOG_LINES_SQL, register_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The derived inputs, spelled as common table expressions for the oracle.
CALL_LOG_CTE = "call_log AS (" + CALL_LOG_SQL.format(events="events") + ")"
LOG_LINES_CTE = "log_lines AS (" + LOG_LINES_SQL.format(documents="documents") + ")"


def query(oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the oracle SQL if there is one."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn

    return register


def literal(value: Any) -> str:
    """A bound value as the oracle's SQL text spells it."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def inline(sql: str, args: Mapping[str, Any]) -> str:
    """Oracle text of a statement: markers replaced by literals."""
    return re.sub(
        r"(?<!:):([A-Za-z_][A-Za-z0-9_]*)", lambda m: literal(args[m.group(1)]), sql
    )


def sql_query(
    name: str, tables: str, sql: str, args: Mapping[str, Any] | None = None, oracle: str | None = None
) -> None:
    """Register a statement run through ``run_query`` with bound parameters."""
    spec = QuerySpec(name=name, sql=sql, params=tuple(args or ()))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        register_views(spark, sf_dir, tables.split())
        return run_query(spark, spec, args)

    query(oracle or inline(sql, args or {}), name)(run)
