"""Ordered steps over several tables that count together or not at all.

A group takes tables as DataFrames and never changes them: a write step makes a new
DataFrame of its table, later steps see it, and ``commit`` hands the final DataFrames
to the caller, who stores them with whatever table format is in use. A group that
fails or is left has nothing to undo.

Every write step runs once: its rows are staged and counted as they are written, so
that later steps read them instead of running the steps before again, and what was
counted is what is kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sparkq.functions.common import require_column_name
from sparkq.functions.text import check_statement
from sparkq.operators.params import MissingParameter, bind_value
from sparkq.plans.staging import stage

ROW_MODES = ("affected_rows", "many", "single", "scalar")
KINDS = ("query", "insert", "update", "delete")
_HIT = "__hit"


class StepFailed(RuntimeError):
    """A step failed; nothing of its group was kept."""


class TransactionClosed(RuntimeError):
    """The transaction was already committed or rolled back."""


@dataclass(frozen=True)
class Step:
    """One statement of a group.

    ``query`` and ``insert`` carry one SELECT in ``sql``; an insert appends its
    rows to ``table``. ``update`` sets ``assign`` (column to SQL expression)
    where ``where`` holds, ``delete`` removes such rows. Values come from the
    group's input as ``:name`` markers.
    """

    id: str
    kind: str
    table: str | None = None
    sql: str | None = None
    where: str = "true"
    assign: Mapping[str, str] = field(default_factory=dict)
    params: tuple[str, ...] = ()
    row_mode: str = "affected_rows"


class Transaction:
    """Steps over tables; leaving the block without commit discards them."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, DataFrame]):
        self.spark = spark
        self._tables = {require_column_name(name): df for name, df in tables.items()}
        self._written: set[str] = set()
        self._closed = False

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, *_exc) -> None:
        if not self._closed:
            self.rollback()

    @property
    def is_closed(self) -> bool:
        return self._closed

    def _check_open(self) -> None:
        if self._closed:
            raise TransactionClosed("the transaction is closed")

    def commit(self) -> dict[str, DataFrame]:
        """The tables that steps wrote, as they are after the last step."""
        self._check_open()
        self._closed = True
        return {name: self._tables[name] for name in sorted(self._written)}

    def rollback(self) -> None:
        """Discard the steps."""
        self._check_open()
        self._closed = True

    def read(self, table: str) -> DataFrame:
        """A table with the writes of earlier steps."""
        self._check_open()
        return self._tables[table]

    def _stage(self, rows: DataFrame, hit: Column) -> tuple[DataFrame, int]:
        """Rows as written, and for how many ``hit`` held, counted in the same run."""
        seen = Observation()
        written = stage(rows.observe(seen, F.count_if(hit).alias("n")).drop(_HIT), "step")
        return written, seen.get.get("n") or 0

    def _put(self, table: str, df: DataFrame) -> None:
        self._tables[table] = df
        self._written.add(table)

    def insert(self, table: str, rows: DataFrame) -> int:
        """Append rows, matched by name; returns how many."""
        old = self.read(table)
        new, n = self._stage(old.limit(0).unionByName(rows), F.lit(True))
        self._put(table, old.unionByName(new))
        return n

    def update(
        self, table: str, assign: Mapping[str, str], where: str = "true", args: Mapping[str, Any] = {}
    ) -> int:
        """Set columns where a condition holds; returns the rows affected."""
        columns = ", ".join(
            f"CAST(CASE WHEN {where} THEN {assign[f.name]} ELSE {f.name} END"
            f" AS {f.dataType.simpleString()}) AS {f.name}"
            if f.name in assign
            else f.name
            for f in self.read(table).schema
        )
        # A null condition is not a match, so the row stays as it is.
        sql = f"SELECT {columns}, coalesce({where}, false) AS {_HIT} FROM {{t}}"
        rows, n = self._stage(self.spark.sql(sql, args=dict(args), t=self.read(table)), F.col(_HIT))
        self._put(table, rows)
        return n

    def delete(self, table: str, where: str = "true", args: Mapping[str, Any] = {}) -> int:
        """Remove rows where a condition holds; returns the rows affected."""
        old, seen = self.read(table), Observation()
        sql = f"SELECT *, coalesce({where}, false) AS {_HIT} FROM {{t}}"
        judged = self.spark.sql(sql, args=dict(args), t=old).observe(seen, F.count_if(F.col(_HIT)).alias("n"))
        self._put(table, stage(judged.where(~F.col(_HIT)).select(*old.columns), "step"))
        return seen.get.get("n") or 0

    def query(self, sql: str, args: Mapping[str, Any] = {}) -> DataFrame:
        """A SELECT over the tables with the writes of earlier steps; the session's own
        views are neither replaced nor left behind."""
        self._check_open()
        check_statement(sql)
        named = ", ".join(f"{name} AS (SELECT * FROM {{{name}}})" for name in self._tables)
        body = sql.strip().removesuffix(";").replace("{", "{{").replace("}", "}}")
        text = f"WITH {named} SELECT * FROM ({body})" if named else body
        return self.spark.sql(text, args=dict(args), **self._tables)

    def run(self, step: Step, step_input: Mapping[str, Any]) -> Any:
        """One step, shaped by its row mode."""
        if step.kind not in KINDS:
            raise ValueError(f"unknown step kind {step.kind!r}")
        if step.row_mode not in ROW_MODES:
            raise ValueError(f"unsupported row_mode {step.row_mode!r} (supported: {ROW_MODES})")
        for name in step.params:
            if name not in step_input:
                raise MissingParameter(f"missing required parameter '{name}'")
        args = {n: bind_value(v) for n, v in step_input.items()}
        if step.kind == "insert":
            count = self.insert(step.table, self.query(step.sql, args))
        elif step.kind == "update":
            count = self.update(step.table, step.assign, step.where, args)
        elif step.kind == "delete":
            count = self.delete(step.table, step.where, args)
        else:
            rows = self.query(step.sql, args)
            if step.row_mode == "affected_rows":
                rows.limit(0).collect()  # a read affects nothing, but must be valid
                return {"rows_affected": 0}
            if step.row_mode == "many":
                return rows
            first = rows.first()
            if step.row_mode == "single":
                return None if first is None else first.asDict(recursive=True)
            return None if first is None else first[0]
        return {"rows_affected": count}


def run_group(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    steps: Sequence[Step],
    step_input: Mapping[str, Any] | None = None,
) -> tuple[dict[str, Any], dict[str, DataFrame]]:
    """Run all steps; returns their results by id and the tables they wrote.

    Every step binds from the same input and sees the writes before it. The first
    step that fails raises ``StepFailed`` with its name, and no table comes out.
    """
    results: dict[str, Any] = {}
    with Transaction(spark, tables) as tx:
        for step in steps:
            try:
                results[step.id] = tx.run(step, step_input or {})
            except Exception as error:
                raise StepFailed(f"step '{step.id}': {error}") from error
        return results, tx.commit()
