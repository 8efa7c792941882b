"""Named procedures that answer with several result sets.

A procedure of one SELECT is a SQL table function (``params.define_procedure``). One of
several statements is a Python function that yields a DataFrame for each, with the
columns that order its rows; it is called by name, with arguments checked against what
it declares, and its sets share one row budget.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from sparkq.functions.common import require_column_name
from sparkq.operators.params import MissingParameter
from sparkq.operators.shape import ResultSets, run_result_sets

DEFAULT_MAX_ROWS = 1000
# (rows, unique order columns) of each statement, in order
Sets = Iterable[tuple[DataFrame, Sequence[str]]]


@dataclass(frozen=True)
class Procedure:
    """``body`` gets the session and the arguments by name."""

    name: str
    params: tuple[str, ...]
    body: Callable[..., Sets]


@dataclass
class Procedures:
    """A registry of procedures."""

    by_name: dict[str, Procedure] = field(default_factory=dict)

    def define(self, name: str, params: Sequence[str], body: Callable[..., Sets]) -> Procedure:
        require_column_name(name)
        for p in params:
            require_column_name(p)
        self.by_name[name] = Procedure(name, tuple(params), body)
        return self.by_name[name]

    def call(
        self,
        spark: SparkSession,
        name: str,
        args: Mapping[str, Any] | None = None,
        max_rows: int = DEFAULT_MAX_ROWS,
    ) -> ResultSets:
        """The result sets of a procedure; each statement runs once.

        Empty sets are dropped. ``max_rows`` is shared in set order; later sets stay as
        empty slots. A missing argument is an error that names it, others are ignored.
        """
        if name not in self.by_name:
            raise KeyError(f"unknown procedure '{name}'")
        if max_rows < 0:
            raise ValueError("max_rows must not be negative")
        procedure, given = self.by_name[name], dict(args or {})
        for p in procedure.params:
            if p not in given:
                raise MissingParameter(f"missing required parameter '{p}'")
        return run_result_sets(procedure.body(spark, **{p: given[p] for p in procedure.params}), max_rows)
