"""Result shapes: what a caller gets back from a query's rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.functions.common import as_column, bound
from sparkq.functions.jsontext import is_json, members
from sparkq.plans.ordered import row_index
from sparkq.plans.staging import stage

# Rows up to here come through one sorted limit; a longer cut uses a row index.
LIMIT_ROWS = 100_000


def single(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The first row, or none."""
    return (df.orderBy(*order) if order else df).limit(1)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key, by an aggregation that combines before the shuffle."""
    kept = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(*[F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)])
        .agg(F.min_by(kept, F.struct(*order)).alias("__row"))
        .select("__row.*")
    )


def many(df: DataFrame, max_rows: int | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """All rows, or at most ``max_rows``: the response cap of a query spec.

    Whether the cap cut something is for ``is_truncated`` or ``execute`` to say.
    """
    rows = df.orderBy(*order) if order else df
    return rows if max_rows is None else rows.limit(max_rows)


def is_truncated(df: DataFrame, max_rows: int) -> bool:
    """Whether a cap of ``max_rows`` drops rows; looks at one row past the cap."""
    return df.limit(max_rows + 1).count() > max_rows


def scalar(df: DataFrame) -> DataFrame:
    """First column of the first row; no row when the result is empty."""
    return df.limit(1).select(F.col(f"`{df.columns[0]}`"))


def scalar_value(df: DataFrame):
    """``scalar`` as a Python value, None when empty."""
    row = scalar(df).first()
    return None if row is None else row[0]


def affected_rows(spark: SparkSession, count: int | None) -> DataFrame:
    """One row with ``rows_affected``; a missing count is 0."""
    return spark.range(1).select(F.lit(count or 0).cast("bigint").alias("rows_affected"))


def resource_contents(
    df: DataFrame, position: Column | str | None = None, strict: bool = False
) -> DataFrame:
    """Rows ``uri, text, blob, mime_type`` as resource contents.

    Every row needs a ``uri`` and exactly one of ``text`` and ``blob``. The
    ``error`` column says what is wrong, else null. In strict mode the job fails
    on the first bad row. ``position`` names the row in messages.
    """
    have = set(df.columns)

    def text(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("string")

    # Only text counts as a uri or a MIME type.
    kinds = dict(df.dtypes)
    uri = text("uri") if kinds.get("uri") == "string" else F.lit(None).cast("string")
    mime = text("mime_type") if kinds.get("mime_type") == "string" else F.lit(None).cast("string")
    where = F.lit("resource_contents")
    if position is not None:
        where = F.concat(
            where, F.lit("["), as_column(position).cast("string"), F.lit("]")
        )
    problem = (
        F.when(uri.isNull(), F.lit(" missing required 'uri' column"))
        .when(
            text("text").isNotNull() & text("blob").isNotNull(),
            F.lit(" has both 'text' and 'blob'; pick one per row"),
        )
        .when(
            text("text").isNull() & text("blob").isNull(),
            F.lit(" must have either 'text' or 'blob'"),
        )
    )
    error = F.concat(where, problem)
    if strict:
        error = F.when(error.isNotNull(), F.raise_error(error).cast("string"))
    shaped = df.select(
        uri.alias("uri"),
        mime.alias("mime_type"),
        text("text").alias("text"),
        text("blob").alias("blob"),
        error.alias("error"),
    )
    # The filter keeps the check alive when a caller drops the column.
    return shaped.where(F.col("error").isNull()) if strict else shaped


@dataclass(frozen=True)
class ResultSets:
    """Several results under one row budget.

    ``kept`` has one entry per non-empty set, in order. ``rows()`` puts all of
    them in one table tagged ``set_no``.
    """

    sets: tuple[DataFrame, ...]
    kept: tuple[int, ...]
    truncated: bool

    def rows(self) -> DataFrame:
        tagged = [df.withColumn("set_no", F.lit(i)) for i, df in enumerate(self.sets)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def _first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    if n <= LIMIT_ROWS:
        return df.orderBy(*order).limit(n)
    return row_index(df, order, "__idx").where(F.col("__idx") < n).drop("__idx")


def result_sets(
    sets: Sequence[tuple[DataFrame, Sequence[str]]], max_rows: int
) -> ResultSets:
    """Share ``max_rows`` over ``(rows, unique order)`` pairs in the given order.

    Empty sets are dropped first. A set past the budget stays as an empty slot.
    Sizes come from one aggregation over all sets; at most one set is cut.
    """
    sizes = reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("n")).withColumn("i", F.lit(i)) for i, (df, _) in enumerate(sets)],
    )
    counts = {r["i"]: r["n"] for r in sizes.collect()}
    left, rows, kept, total = max_rows, [], [], 0
    for i, (df, order) in enumerate(sets):
        n = counts[i]
        if n == 0:
            continue
        total += n
        keep = min(n, left)
        left -= keep
        kept.append(keep)
        rows.append(df if keep == n else df.limit(0) if keep == 0 else _first_rows(df, order, keep))
    return ResultSets(tuple(rows), tuple(kept), total > max_rows)


def run_result_sets(
    sets: Iterable[tuple[DataFrame, Sequence[str]]], max_rows: int
) -> ResultSets:
    """``result_sets`` of statements that run once, one after the other.

    Of each set no more is run than the budget has left and one row more, which tells
    whether there are further ones; what was run is written and read from there.
    """
    left, rows, kept, truncated = max_rows, [], [], False
    for df, order in sets:
        found = stage(_first_rows(df, order, left + 1), "result-set")
        n = found.count()
        if n == 0:
            continue
        keep = min(n, left)
        truncated = truncated or n > left
        left -= keep
        kept.append(keep)
        rows.append(found if keep == n else found.limit(0) if keep == 0 else _first_rows(found, order, keep))
    return ResultSets(tuple(rows), tuple(kept), truncated)


def row_count_hint(payload: Column | str) -> Column:
    """Number of rows a JSON response stands for, read off its shape.

    Array: its length. Object: ``rows_affected`` if a number, else the length of
    an array ``contents``, else 1. Anything else, null included: null.
    """
    text = as_column(payload)
    of_array = F.when(is_json(text), F.json_array_length(text).cast("bigint"))
    found = members(text, {"rows_affected": "variant", "contents": "array<string>"})
    return F.when(text.rlike(r"^[ \t\r\n]*\["), of_array).otherwise(bound(found, _rows_of))


def _rows_of(found: Column) -> Column:
    affected = F.coalesce(F.schema_of_variant(found["rows_affected"]), F.lit(""))
    whole = F.try_variant_get(found["rows_affected"], "$", "bigint")
    number = affected.isin("BIGINT", "DOUBLE", "FLOAT") | affected.startswith("DECIMAL")
    return F.when(
        found.isNotNull(),
        F.when(number, F.when((affected == "BIGINT") & (whole >= 0), whole))
        .when(found["contents"].isNotNull(), F.size(found["contents"]).cast("bigint"))
        .otherwise(F.lit(1).cast("bigint")),
    )
