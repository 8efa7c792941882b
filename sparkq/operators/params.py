"""Named queries with bound, derived and swept parameters, and row policies."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkq.functions.common import require_column_name, require_identifier
from sparkq.functions.text import check_statement
from sparkq.operators.sweeps import PARAM_ID, common_type, number_params, scan_points
from sparkq.plans.ordered import Running

# Names that only the engine may bind.
RESERVED = ("idempotency_key", "idempotency_scope_hash")
AFTER_PREFIX = "_after_"

ROW_MODES = (
    "single", "many", "scalar", "affected_rows", "resource_contents", "stream", "result_sets",
)


class MissingParameter(ValueError):
    """A marker in the SQL text has no argument."""


@dataclass(frozen=True)
class QuerySpec:
    """A named query.

    ``params`` are the declared argument names; the text may use no others. None
    accepts any. ``derived``
    maps names to SQL expressions over the other arguments. ``session_vars``
    are visible to the text as markers too (dots become underscores). Rows are capped
    only where ``max_rows`` says so.
    """

    name: str
    sql: str
    params: tuple[str, ...] | None = None
    derived: Mapping[str, str] = field(default_factory=dict)
    session_vars: Mapping[str, str] = field(default_factory=dict)
    row_mode: str = "many"
    max_rows: int | None = None

    def __post_init__(self) -> None:
        check_statement(self.sql)
        if self.row_mode not in ROW_MODES:
            raise ValueError(f"row mode must be one of {ROW_MODES}, not {self.row_mode!r}")
        if self.max_rows is not None and self.max_rows < 0:
            raise ValueError("max_rows must not be negative")
        for key in self.session_vars:
            require_identifier(key)


def bind_value(value: Any) -> Any:
    """An argument as ``spark.sql`` takes it.

    Whole numbers beyond 64 bits become text, objects become JSON text.
    """
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int) and not -(2**63) <= value < 2**63:
        return str(value)
    if isinstance(value, Mapping):
        return json.dumps(value)
    if isinstance(value, (list, tuple)):
        return [bind_value(v) for v in value]
    return value


def check_arguments(spec: QuerySpec, args: Mapping[str, Any] | None) -> dict[str, Any]:
    """Arguments as a dict; refuses non-objects, reserved and missing names."""
    if args is None:
        args = {}
    if not isinstance(args, Mapping):
        raise TypeError("arguments must be an object (or null)")
    taken = [n for n in args if n in RESERVED]
    if taken:
        raise ValueError(f"reserved argument names: {', '.join(taken)}")
    for name in spec.params or ():
        engine_bound = name in RESERVED or name.startswith(AFTER_PREFIX)
        if name not in args and name not in spec.derived and not engine_bound:
            raise MissingParameter(f"missing required parameter '{name}'")
    return dict(args)


def derive_params(params: DataFrame, exprs: Mapping[str, str]) -> DataFrame:
    """Add derived parameters to a table of arguments, all rows in one plan.

    Expressions run in alphabetical order of their names. Later ones see earlier
    results, and a result replaces a given value of the same name.
    """
    for name in sorted(exprs):
        params = params.withColumn(name, F.expr(exprs[name]))
    return params


def derive_arguments(
    spark: SparkSession, args: Mapping[str, Any], exprs: Mapping[str, str]
) -> dict[str, Any]:
    """``derive_params`` for the arguments of one call (one row)."""
    if not exprs:
        return dict(args)
    given = spark.sql(
        "SELECT " + (", ".join(f":{require_column_name(n)} AS {n}" for n in args) or "1 AS __no_args"),
        args={n: bind_value(v) for n, v in args.items()},
    )
    row = derive_params(given, exprs).first().asDict()
    row.pop("__no_args", None)
    return {**args, **{n: row[n] for n in exprs}}


def run_query(
    spark: SparkSession,
    spec: QuerySpec,
    args: Mapping[str, Any] | None = None,
    *,
    after: Mapping[str, Any] | None = None,
    idempotency: tuple[str, str] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The rows of a named query; nothing runs until the caller acts on them.

    Values are bound by Spark and never become SQL text. ``after`` binds
    ``_after_<column>`` markers, ``idempotency`` is ``(scope_hash, key)``.
    """
    bound = check_arguments(spec, args)
    bound = derive_arguments(spark, bound, spec.derived)
    if spec.params is not None:
        # An undeclared name in the text stays unbound, whatever the caller sent.
        bound = {n: v for n, v in bound.items() if n in spec.params or n in spec.derived}
    bound.update({k.replace(".", "_"): v for k, v in spec.session_vars.items()})
    bound.update({f"{AFTER_PREFIX}{c}": v for c, v in (after or {}).items()})
    if idempotency is not None:
        bound["idempotency_scope_hash"], bound["idempotency_key"] = idempotency
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(require_identifier(name))
    try:
        return spark.sql(spec.sql, args={n: bind_value(v) for n, v in bound.items()})
    except AnalysisException as error:
        if error.getCondition() == "UNBOUND_SQL_PARAMETER":
            name = error.getMessageParameters().get("name", "?")
            raise MissingParameter(f"missing required parameter '{name}'") from error
        raise


def define_procedure(
    spark: SparkSession, name: str, params: Mapping[str, str], returns: str, body: str
) -> None:
    """Register a named procedure as a SQL table function of this session.

    ``params`` maps names to SQL types, ``returns`` is the column list, and
    ``body`` one SELECT over the parameters.
    """
    require_column_name(name)
    check_statement(body)
    declared = ", ".join(f"{require_column_name(p)} {kind}" for p, kind in params.items())
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({declared}) RETURNS TABLE ({returns}) RETURN {body}"
    )


def call_procedure(
    spark: SparkSession, name: str, args: Mapping[str, Any] | None = None
) -> DataFrame:
    """Rows of a procedure; arguments are passed by name."""
    args = dict(args or {})
    listed = ", ".join(f"{require_column_name(n)} => :{n}" for n in args)
    return spark.sql(
        f"SELECT * FROM {require_column_name(name)}({listed})",
        args={n: bind_value(v) for n, v in args.items()},
    )


@contextmanager
def session_variables(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """SQL session variables for the length of one call, dropped afterwards."""
    names = [require_column_name(k.replace(".", "_")) for k in values]
    try:
        for name, value in zip(names, values.values()):
            spark.sql(f"DECLARE OR REPLACE VARIABLE {name} STRING")
            spark.sql(f"SET VARIABLE {name} = :value", args={"value": value})
        yield
    finally:
        for name in names:
            spark.sql(f"DROP TEMPORARY VARIABLE IF EXISTS {name}")


def apply_policy(
    df: DataFrame,
    predicate: str,
    session_vars: Mapping[str, Any],
    declared: Iterable[str] = (),
) -> DataFrame:
    """Keep the rows that ``predicate`` allows for these session variables.

    Variables are markers in the predicate, dots written as underscores. A
    declared variable without a value is null, so its comparisons keep no row.
    """
    check_statement(predicate)
    values: dict[str, Any] = {require_identifier(n).replace(".", "_"): None for n in declared}
    values.update(
        {require_identifier(n).replace(".", "_"): v for n, v in session_vars.items()}
    )
    return df.sparkSession.sql(
        "SELECT * FROM {source} WHERE " + predicate,
        args={n: bind_value(v) for n, v in values.items()},
        source=df,
    )


def run_batch(
    data: DataFrame,
    params: DataFrame,
    *,
    equal: Mapping[str, str] | None = None,
    between: tuple[str, str, str] | None = None,
    where: Column | str | None = None,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Run one parameterised filter for every row of a parameter table.

    The result has the columns of both sides, one row per (parameter row, data
    row) that match. ``equal`` maps data columns to parameter columns. ``between``
    is ``(data column, low, high)``, low inclusive and high exclusive, with the
    bounds in parameter columns; numbers, dates and timestamps will do, compared in the
    type that both sides have in common. ``where``
    is a further condition over both. ``keep_unmatched`` answers every parameter
    row: one without a match stays, with nulls for the data (rows that agree in
    all columns are one call).

    The join is always by equal keys or by bins of the ranges, so no plan pairs
    every parameter row with every data row; a side that Spark knows to be small
    is broadcast. Where only counts or sums are wanted, ``sweep_totals`` makes no
    pairs at all.
    """
    if not equal and between is None:
        raise ValueError("give equal columns, a between range, or both")
    conditions: list[Column] = [F.col(d) == F.col(p) for d, p in (equal or {}).items()]
    if between is not None:
        value, low, high = between
        conditions += [F.col(value) >= F.col(low), F.col(value) < F.col(high)]
    if where is not None:
        conditions.append(F.expr(where) if isinstance(where, str) else where)
    matches = reduce(lambda a, b: a & b, conditions)

    if equal:
        found = data.join(params, matches)
    else:
        found = _join_on_bins(data, params, *between, matches)
    if not keep_unmatched:
        return found
    names = params.columns
    met = found.select(*[F.col(c).alias(f"__met{i}") for i, c in enumerate(names)]).distinct()
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__met{i}")) for i, c in enumerate(names)]
    )
    rest = params.distinct().join(met, same, "left_anti")
    return found.unionByName(rest, allowMissingColumns=True)


def _axis(c: Column, kind: T.DataType) -> Column:
    """A value's place on a line, in its order: days, seconds or the number itself."""
    c = c.cast(kind)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double") / 1e6
    if isinstance(kind, T.TimestampNTZType):
        # A wall clock is not taken through the session's zone, where hours may be missing.
        second = F.extract(F.lit("SECOND"), c).cast("double")
        return F.unix_date(c.cast("date")) * 86400.0 + F.hour(c) * 3600 + F.minute(c) * 60 + second
    return c.cast("double")


def _join_on_bins(
    data: DataFrame, params: DataFrame, value: str, low: str, high: str, matches: Column
) -> DataFrame:
    """Range join as an equi join on power-of-two bins.

    A range takes the bin size just above its own width, so it touches at most
    two bins however wide it is. A data row is repeated once per bin size in use
    (ranges of like width share one).
    """
    kind = common_type(data, value, params, [low, high])
    start, end = _axis(F.col(low), kind), _axis(F.col(high), kind)
    # Neighbouring instants may have one double, so a width is at least that of a bin
    # that keeps its numbers whole.
    least = F.greatest(F.abs(start), F.abs(end)) * 2.0**-50
    width = F.greatest(end - start, least, F.lit(2.0**-60))
    sized = params.where(F.col(low) < F.col(high)).withColumn(
        "__size", F.pow(F.lit(2.0), F.ceil(F.log2(width)))
    )
    # Bin sizes are powers of two between the narrowest and the widest range.
    sizes = [r["__size"] for r in sized.select("__size").distinct().collect()]

    def bin_of(place: Column, size: str) -> Column:
        return F.floor(place / F.col(size))

    binned = sized.withColumn(
        "__bin", F.explode(F.sequence(bin_of(start, "__size"), bin_of(end, "__size")))
    )
    placed = data.withColumn(
        "__width", F.explode(F.lit(sizes) if sizes else F.array().cast("array<double>"))
    ).withColumn("__at", bin_of(_axis(F.col(value), kind), "__width"))
    same_bin = (F.col("__width") == F.col("__size")) & (F.col("__at") == F.col("__bin"))
    return placed.join(binned, same_bin & matches).drop("__size", "__bin", "__width", "__at")


# Beyond this many rows of one group, a sweep is spread over ranges.
SWEEP_ROWS = 1_000_000


def sweep_totals(
    data: DataFrame,
    params: DataFrame,
    *,
    between: tuple[str, str, str],
    equal: Mapping[str, str] | None = None,
    sums: Mapping[str, Column] | None = None,
    low_open: bool = False,
    count: str = "n",
) -> DataFrame:
    """For every parameter row the number of data rows in its range, and sums over them.

    ``between`` is ``(data column, low, high)``, low inclusive unless ``low_open``,
    high exclusive; a null bound is open. Data and bounds are compared in their common
    type. Every parameter row is answered, with 0 rows and null sums where nothing
    matches; rows that agree in all columns are one.

    Data and bounds are put in one order and counted through once; a range is the
    difference of the running totals at its bounds. No pairs are made.
    """
    sums = dict(sums or {})
    wanted = number_params(params)
    kinds = [data.select(t.alias("t")).schema["t"].dataType for t in sums.values()]
    zeros = [F.lit(0).cast(k) for k in kinds]
    steps = [Running("n", "sum", F.when(F.col("sign") == 0, 1).otherwise(0).cast("bigint"))]
    steps += [Running(f"total{i}", "sum", F.coalesce(F.col(f"v{i}"), z)) for i, z in enumerate(zeros)]
    scanned = scan_points(data, wanted, between, equal, list(sums.values()), [], low_open, steps, SWEEP_ROWS)
    # Empty ranges may have their bounds the wrong way round.
    n = F.greatest(F.sum(F.col("n") * F.col("sign")), F.lit(0))
    differences = [F.sum(F.col(f"total{i}") * F.col("sign")).alias(f"__d{i}") for i in range(len(sums))]
    found = scanned.rows.where("sign <> 0").groupBy(F.col("id").alias(PARAM_ID)).agg(n.alias("__n"), *differences)
    return wanted.join(found, PARAM_ID).select(
        *params.columns,
        F.col("__n").alias(count),
        *[F.when(F.col("__n") > 0, F.col(f"__d{i}")).alias(name) for i, name in enumerate(sums)],
    )


def apply_once(
    batch: DataFrame,
    order: list[str],
    ledger: DataFrame | None = None,
    scope: str = "idempotency_scope_hash",
    key: str = "idempotency_key",
) -> DataFrame:
    """Rows to apply: the first of each (scope, key) that the ledger lacks.

    The first row is picked by an aggregation, which combines on the map side,
    so a key repeated very often never meets in one sort.
    """
    kept = F.struct(*[F.col(c) for c in batch.columns])
    first = (
        batch.groupBy(F.col(scope).alias("__s"), F.col(key).alias("__k"))
        .agg(F.min_by(kept, F.struct(*order)).alias("__row"))
        .select("__row.*")
    )
    if ledger is None:
        return first
    applied = ledger.select(F.col(scope).alias("__ls"), F.col(key).alias("__lk"))
    return first.join(
        applied,
        F.col(scope).eqNullSafe(F.col("__ls")) & F.col(key).eqNullSafe(F.col("__lk")),
        "left_anti",
    )


def context_variables(context: Mapping[str, str]) -> dict[str, str]:
    """Context entries by lower-case key; keys that are not plain names are left out."""
    return {k.lower(): v for k, v in context.items() if re.fullmatch(r"[A-Za-z0-9_]+", k)}


def complete_prefix(
    df: DataFrame,
    column: str,
    prefix: str,
    context: Mapping[str, str] | None = None,
    max_results: int | None = None,
) -> DataFrame:
    """Distinct text values of ``column`` that start with ``prefix``, in order.

    ``context`` restricts other columns to given values. The prefix test reaches
    the scan.
    """
    rows = df.where(F.col(column).startswith(prefix))
    for name, value in context_variables(context or {}).items():
        rows = rows.where(F.col(require_column_name(name)) == value)
    values = rows.select(column).distinct().orderBy(column)
    return values if max_results is None else values.limit(max_results)


def complete_variable(
    spark: SparkSession,
    sql: str,
    prefix: str,
    context: Mapping[str, str] | None = None,
    max_results: int | None = None,
) -> DataFrame:
    """Completions from a statement of one's own over ``:prefix`` and ``:ctx_<key>``.

    The result is its first column, text only; ``max_results`` caps the rows read.
    """
    if ":prefix" not in sql:
        raise ValueError("a completion query must reference `:prefix`")
    args = {f"ctx_{k}": v for k, v in context_variables(context or {}).items()}
    rows = run_query(spark, QuerySpec(name="completion", sql=sql), {**args, "prefix": prefix})
    first, kind = rows.dtypes[0]
    values = (rows if max_results is None else rows.limit(max_results)).select(F.col(f"`{first}`"))
    return values.where(F.col(f"`{first}`").isNotNull()) if kind == "string" else values.limit(0)


# Parts in which the values of one prefix are ranked.
RANK_PARTS = 64


def first_per_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[str], n: int, parts: int = RANK_PARTS
) -> DataFrame:
    """The first ``n`` rows of each group in ``order``.

    Rows are ranked in parts of their group first, dealt by a hash of the order columns,
    and the winners of the parts among each other; so of a group of any size a task gets
    a part, or ``n`` rows of each part. Rows that tie in ``order`` are taken by no rule.
    """
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    for keys in ([*group, "__part"], list(group)):
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        dealt = dealt.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
    return dealt.drop("__part")


def complete_prefixes(
    df: DataFrame, column: str, prefixes: DataFrame, prefix: str = "prefix", max_results: int | None = None
) -> DataFrame:
    """``complete_prefix`` for a whole table of prefixes: ``(prefix, value)`` rows.

    Values are made distinct first, then meet prefixes of their own first
    characters in an equi join, one candidate per prefix length in use. A short prefix
    that very many values share is ranked in parts.
    """
    wanted = prefixes.select(F.col(prefix).alias("prefix")).where("prefix IS NOT NULL").distinct()
    # Distinct lengths only: as many numbers as the longest prefix has characters.
    lengths = [r["n"] for r in wanted.select(F.length("prefix").alias("n")).distinct().collect()]
    values = df.select(F.col(column).alias("value")).where("value IS NOT NULL").distinct()
    candidates = values.select(
        "value",
        F.explode(
            F.filter(F.lit(lengths or [0]), lambda n: n <= F.length("value"))
        ).alias("n"),
    ).select("value", F.substring(F.col("value"), F.lit(1), F.col("n")).alias("prefix"))
    found = candidates.join(wanted, "prefix").select("prefix", "value")
    if max_results is None:
        return found
    return first_per_group(found, ["prefix"], ["value"], max_results)
