"""Ordered computations over rows without a task that owns a whole hot group.

``scan_in_order`` computes running values per group. Groups up to ``hot_rows``
rows use a plain window. Larger groups are range-partitioned by (group, order),
so one group is spread over many tasks, each range is scanned on its own, and a
small table of per-range totals carries state from range to range.

``row_index`` numbers all rows of a table in key order in the same manner.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkq.plans.staging import stage

# A group of this many rows is still one comfortable task: its sort and the window hold
# some 200 bytes a row of scans with a few columns (measured in the replay of requests).
HOT_GROUP_ROWS = 2_000_000
# Aim for ranges of this size when the session's partition count would exceed it.
RANGE_ROWS = 1_000_000

_RANGE = "__range"
_TIE = "__row_hash"
_POS = "__pos"
# monotonically_increasing_id keeps the row position in its low 33 bits.
_POS_MASK = (1 << 33) - 1


@dataclass(frozen=True)
class Running:
    """One running value.

    ``kind`` is ``sum``, ``max`` or ``min`` (over all rows up to and including
    the current one, nulls ignored) or ``prev`` (value on the row before, null
    on the first). ``expr`` may use the outputs of earlier steps.
    """

    out: str
    kind: str
    expr: Column


def hashable(kind: T.DataType) -> bool:
    """Whether values of a type have a hash and an order; maps and variants have neither."""
    if isinstance(kind, T.StructType):
        return all(hashable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return hashable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _by_range(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Range partitions in key order, more than the session's count if ``rows`` need them.

    Without a number adaptive execution merges small neighbours.
    """
    wanted = -(-rows // RANGE_ROWS)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(*([wanted] if wanted > usual else []), *keys)


def _local(step: Running, group: Sequence[str], order: Sequence[str]) -> Column:
    window = W.partitionBy(*group).orderBy(*order)
    if step.kind == "prev":
        return F.lag(step.expr).over(window)
    agg = {"sum": F.sum, "max": F.max, "min": F.min}[step.kind]
    return agg(step.expr).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))


def _carried(df: DataFrame, group: list[str], order: list[str], step: Running) -> DataFrame:
    """One step over staged ranges: value inside the range, then the carry."""
    in_range = [_RANGE, *group]
    position = F.row_number().over(W.partitionBy(*in_range).orderBy(*order))
    scanned = df.withColumn("__local", _local(step, in_range, order))
    if step.kind == "prev":
        scanned = scanned.withColumn("__first", position == 1)

    by_range = W.partitionBy(*group).orderBy(_RANGE)
    before = by_range.rowsBetween(W.unboundedPreceding, -1)
    if step.kind == "prev":
        total = F.max_by(step.expr, F.struct(*order))
        carry = F.lag("__total").over(by_range)
    else:
        agg = {"sum": F.sum, "max": F.max, "min": F.min}[step.kind]
        total = agg(step.expr)
        carry = agg("__total").over(before)
    # One row per (group, range): its size follows the number of ranges and
    # groups, not the number of rows.
    carries = (
        df.groupBy(*group, _RANGE)
        .agg(total.alias("__total"))
        .withColumn("__carry", carry)
        .drop("__total")
    )
    renamed = carries.select(
        *[F.col(c).alias(f"__carry_k{i}") for i, c in enumerate([*group, _RANGE])], "__carry"
    )
    on = reduce(
        lambda a, b: a & b,
        [scanned[c].eqNullSafe(renamed[f"__carry_k{i}"]) for i, c in enumerate([*group, _RANGE])],
    )
    joined = scanned.join(renamed, on, "left")
    if step.kind == "prev":
        value = F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__local"))
    elif step.kind == "sum":
        both = F.col("__local") + F.col("__carry")
        value = F.coalesce(both, F.col("__local"), F.col("__carry"))
    else:
        pick = F.greatest if step.kind == "max" else F.least
        value = pick(F.col("__local"), F.col("__carry"))
    return joined.select(*df.columns, value.alias(step.out))


def scan_in_order(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    steps: Sequence[Running],
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Add the running values ``steps`` per ``group`` in ascending ``order``.

    Rows that tie in ``order`` are taken by a hash of the whole row, so the answer
    does not depend on the way taken; what still ties is equal. The input is run once
    and written; group sizes are counted on what was written (its group columns only).
    Between the steps over hot groups the rows are written again, so every step reads
    the one before it once for its values and once for its carries.
    """
    group, order, columns = list(group), [*order, _TIE], df.columns
    told_apart = [F.col(f.name) for f in df.schema if hashable(f.dataType)]
    df = stage(df.withColumn(_TIE, F.xxhash64(*told_apart)), "scan")

    def plain(rows: DataFrame) -> DataFrame:
        for step in steps:
            rows = rows.withColumn(step.out, _local(step, group, order))
        return rows.drop(_TIE)

    names = [f"__hot_k{i}" for i in range(len(group))]
    hot = (
        df.groupBy(*[F.col(c).alias(n) for c, n in zip(group, names)])
        .agg(F.count("*").alias("__n"))
        .where(F.col("__n") > hot_rows)
    )
    hot_total = hot.agg(F.sum("__n")).first()[0]
    if hot_total is None:
        return plain(df)

    # At most (rows of df / hot_rows) groups can be hot, so this side is bounded.
    hot = stage(hot.drop("__n"), "hot")
    keys = F.broadcast(hot)
    on = reduce(lambda a, b: a & b, [df[c].eqNullSafe(keys[n]) for c, n in zip(group, names)])
    cold = plain(df.join(keys, on, "left_anti"))
    ranged = _by_range(df.join(keys, on, "left_semi"), [*group, *order], hot_total)
    split = ranged.withColumn(_RANGE, F.spark_partition_id())
    for step in steps:
        split = _carried(stage(split, "ranges"), group, order, step)
    return cold.unionByName(split.drop(_RANGE, _TIE)).select(*columns, *[s.out for s in steps])


def row_index(df: DataFrame, keys: Sequence[str], out: str = "row_index") -> DataFrame:
    """Number all rows from 0 in ``keys`` order; ``keys`` must be unique.

    One range shuffle. The position inside a range is free, and the offset of a
    range comes from a table with one row per range.
    """
    placed = stage(
        _by_range(df, keys, df.count())
        .sortWithinPartitions(*keys)
        .select(
            "*",
            F.spark_partition_id().alias(_RANGE),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK)).alias(_POS),
        ),
        "index",
    )
    before = W.partitionBy(F.lit(0)).orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(F.col(_RANGE).alias("__r"))
        .agg(F.count("*").alias("__n"))
        .select("__r", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    )
    # One row per range partition: bounded by spark.sql.shuffle.partitions.
    return placed.join(F.broadcast(offsets), F.col(_RANGE) == F.col("__r")).select(
        *df.columns, (F.col("__off") + F.col(_POS)).alias(out)
    )
