"""Sweeps that answer every parameter row from the rows of its range, without pairs.

``sweep_positions`` puts data and bounds in one order: data rows are numbered inside
their group, and every parameter row learns from which number up to which its rows
reach. What is asked of a range is then a matter of whole numbers:

* counts and sums are differences of running totals (``params.sweep_totals``),
* minima and maxima have no inverse; they come from blocks of ``2 ** BLOCK_BITS``
  neighbours, blocks of blocks and so on, of which a range touches at most two on each
  tier (``sweep_extremes``),
* its first rows are the data rows of its first numbers (``sweep_rows``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkq.plans.ordered import Running, scan_in_order
from sparkq.plans.staging import stage

# Beyond this many rows of one group, a sweep is spread over ranges.
SWEEP_ROWS = 1_000_000
# Blocks have 2 ** BLOCK_BITS neighbours.
BLOCK_BITS = 10

PARAM_ID = "__param"


def common_type(data: DataFrame, column: str, params: DataFrame, bounds: Sequence[str]) -> T.DataType:
    """The type in which a data column and its bounds are compared."""
    both = data.select(F.col(column).alias("v"))
    for bound in bounds:
        both = both.union(params.select(bound))
    return both.schema["v"].dataType


def number_params(params: DataFrame) -> DataFrame:
    """Distinct parameter rows with a number, written once."""
    return stage(stage(params.distinct(), "params").withColumn(PARAM_ID, F.monotonically_increasing_id()), "params")


@dataclass(frozen=True)
class Scanned:
    """Data and bounds in one order. Bounds have ``id`` and ``sign``: -1 low, 1 high."""

    rows: DataFrame
    keys: list[str]


def scan_points(
    data: DataFrame,
    wanted: DataFrame,
    between: tuple[str, str, str],
    equal: Mapping[str, str] | None,
    payload: Sequence[Column],
    order: Sequence[str],
    low_open: bool,
    steps: Sequence[Running],
    hot_rows: int = SWEEP_ROWS,
) -> Scanned:
    """Run ``steps`` over data rows and the bounds of ``wanted`` (numbered) in one order.

    Data rows carry ``payload`` as ``v0``, ``v1`` ...; they are ordered by value, then
    by ``order``. A bound stands before the rows of its own value, an open low one
    behind them; null bounds are open ends. Rows without a value or key take no part.
    """
    value, low, high = between
    keys = [f"k{i}" for i in range(len(equal or {}))] or ["k0"]
    data_keys = [F.col(c) for c in (equal or {})] or [F.lit(0)]
    param_keys = [F.col(c) for c in (equal or {}).values()] or [F.lit(0)]
    kind = common_type(data, value, wanted, [low, high])
    ties = [f"t{i}" for i in range(len(order))]
    # A null key equals nothing, as in a join.
    present = reduce(lambda a, b: a & b, [c.isNotNull() for c in [F.col(value), *data_keys]])
    points = data.where(present).select(
        *[c.alias(k) for c, k in zip(data_keys, keys)],
        F.lit(1).alias("place"),
        F.col(value).cast(kind).alias("at"),
        F.lit(1).alias("tie"),
        F.lit(0).alias("sign"),
        F.lit(None).cast("long").alias("id"),
        *[F.col(c).alias(t) for c, t in zip(order, ties)],
        *[p.alias(f"v{i}") for i, p in enumerate(payload)],
    )

    def bound(column: str, sign: int, open_end: int, tie: int) -> DataFrame:
        place = F.when(F.col(column).isNull(), open_end).otherwise(1)
        return wanted.select(
            *[c.alias(k) for c, k in zip(param_keys, keys)],
            place.alias("place"),
            F.col(column).cast(kind).alias("at"),
            F.lit(tie).alias("tie"),
            F.lit(sign).alias("sign"),
            F.col(PARAM_ID).alias("id"),
        )

    bounds = bound(low, -1, 0, 2 if low_open else 0).unionByName(bound(high, 1, 2, 0))
    both = points.unionByName(bounds, allowMissingColumns=True)
    return Scanned(scan_in_order(both, keys, ["place", "at", "tie", *ties, "id", "sign"], steps, hot_rows), keys)


@dataclass(frozen=True)
class Positions:
    """Numbered data rows (keys, ``pos``, values) and ranges (``__param``, keys, ``first``,
    ``end``) of the numbered parameter rows; both written."""

    params: DataFrame
    rows: DataFrame
    ranges: DataFrame
    keys: list[str]


def sweep_positions(
    data: DataFrame,
    params: DataFrame,
    between: tuple[str, str, str],
    equal: Mapping[str, str] | None = None,
    payload: Sequence[Column] = (),
    order: Sequence[str] = (),
    low_open: bool = False,
) -> Positions:
    """Data rows numbered from 0 in each group, by value and ``order``, and of every
    parameter row the numbers its range has: from ``first`` to before ``end``."""
    wanted = number_params(params)
    steps = [Running("n", "sum", F.when(F.col("sign") == 0, 1).otherwise(0).cast("bigint"))]
    scanned = scan_points(data, wanted, between, equal, payload, order, low_open, steps)
    rows, keys = stage(scanned.rows, "sweep"), scanned.keys
    values = [f"v{i}" for i in range(len(payload))]
    numbered = rows.where("sign = 0").select(*keys, (F.col("n") - 1).alias("pos"), *values)
    ranges = (
        rows.where("sign <> 0")
        .groupBy("id")
        .agg(
            *[F.first(k).alias(k) for k in keys],
            F.max(F.when(F.col("sign") == -1, F.col("n"))).alias("first"),
            F.max(F.when(F.col("sign") == 1, F.col("n"))).alias("end"),
        )
        .withColumnRenamed("id", PARAM_ID)
    )
    return Positions(wanted, numbered, stage(ranges, "ranges"), keys)


def _same_place(left: str, right: str, keys: Sequence[str]) -> Column:
    on = F.col(left) == F.col(right)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"b_{k}"))
    return on


def _extremes(greatest: Sequence[bool]) -> list[Column]:
    return [(F.max if most else F.min)(f"v{i}").alias(f"v{i}") for i, most in enumerate(greatest)]


def _member(name: str) -> Callable[[Column], Column]:
    return lambda row: row[name]


def _by_blocks(
    rows: DataFrame, ranges: DataFrame, keys: list[str], greatest: Sequence[bool], bits: int
) -> DataFrame:
    """The least (or greatest) of each value ``v0`` .. over the rows (keys, pos) of each
    range, as parts (__param, v0 ..) that are still to be combined.

    A tier's rows are gathered in blocks of 2 ** bits neighbours. A range takes what it
    has of its first and of its last block; the whole blocks between are a range of the
    next tier, whose rows are the blocks.
    """
    values = [f"v{i}" for i in range(len(greatest))]
    in_block = F.struct("pos", *values)
    blocks = (
        rows.groupBy(*[F.col(k).alias(f"b_{k}") for k in keys], F.shiftright("pos", bits).alias("block"))
        # At most 2 ** bits rows, as positions are unique.
        .agg(F.array_sort(F.collect_list(in_block)).alias("held"), *_extremes(greatest))
    )
    blocks = stage(blocks, "blocks")
    last = F.col("end") - 1
    first_block, last_block = F.shiftright("first", bits), F.shiftright(last, bits)
    asked = ranges.where("first < end").withColumns({"from_block": first_block, "to_block": last_block})
    ends = asked.withColumn(
        "touched", F.explode(F.array_distinct(F.array("from_block", "to_block")))
    )
    met = ends.join(blocks, _same_place("touched", "block", keys))
    start = F.greatest(F.col("first") - F.shiftleft("block", bits), F.lit(0))
    stop = F.least(F.col("end") - F.shiftleft("block", bits), F.lit(1 << bits))
    cut = F.slice("held", (start + 1).cast("int"), (stop - start).cast("int"))
    parts = met.select(
        PARAM_ID,
        *[
            (F.array_max if most else F.array_min)(F.transform(cut, _member(v))).alias(v)
            for v, most in zip(values, greatest)
        ],
    )
    inner = asked.where("to_block - from_block > 1").select(
        PARAM_ID, *keys, (F.col("from_block") + 1).alias("first"), F.col("to_block").alias("end")
    )
    inner = stage(inner, "ranges")
    if inner.isEmpty():
        return parts
    above = blocks.select(*[F.col(f"b_{k}").alias(k) for k in keys], F.col("block").alias("pos"), *values)
    return parts.unionByName(_by_blocks(above, inner, keys, greatest, bits))


def sweep_extremes(
    data: DataFrame,
    params: DataFrame,
    *,
    between: tuple[str, str, str],
    equal: Mapping[str, str] | None = None,
    minima: Mapping[str, Column] | None = None,
    maxima: Mapping[str, Column] | None = None,
    low_open: bool = False,
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """For every parameter row the least and greatest values over the rows of its range.

    Ranges are as in ``sweep_totals``. ``minima`` and ``maxima`` name expressions over
    the data; nulls are left out, and a range without a value gives null. A range is met
    by at most two blocks of each tier, and there are as many tiers as the row count has
    digits to the base 2 ** bits; so the work grows with the data and the parameter
    rows, not with the pairs.
    """
    minima, maxima = dict(minima or {}), dict(maxima or {})
    greatest = [False] * len(minima) + [True] * len(maxima)
    payload = [*minima.values(), *maxima.values()]
    placed = sweep_positions(data, params, between, equal, payload, (), low_open)
    parts = _by_blocks(placed.rows, placed.ranges, placed.keys, greatest, bits)
    found = parts.groupBy(PARAM_ID).agg(*_extremes(greatest)).withColumnsRenamed(
        {f"v{i}": f"__v{i}" for i in range(len(greatest))}
    )
    return placed.params.join(found, PARAM_ID, "left").select(
        *params.columns, *[F.col(f"__v{i}").alias(name) for i, name in enumerate([*minima, *maxima])]
    )


def sweep_rows(
    data: DataFrame,
    params: DataFrame,
    *,
    between: tuple[str, str, str],
    equal: Mapping[str, str] | None = None,
    order: Sequence[str] = (),
    row_mode: str = "many",
    max_rows: int = 1000,
    low_open: bool = False,
) -> DataFrame:
    """The response of every parameter row, in a row mode of its own.

    * ``many``: the first ``max_rows`` data rows of the range, by value and ``order``,
      one row each with ``row_no`` (from 1) and ``truncated`` (whether there are more);
      a range without rows gives one row with ``row_no`` 0 and nulls,
    * ``single``: the first data row, nulls if there is none,
    * ``scalar``: ``value``, the first column of the first data row.

    Only the rows of the answer are looked up, by their numbers, so a range of any
    length costs as much as what is answered.
    """
    if row_mode not in ("many", "single", "scalar"):
        raise ValueError(f"a sweep answers many, single or scalar, not {row_mode!r}")
    if max_rows < 0:
        raise ValueError("max_rows must not be negative")
    columns = data.columns[:1] if row_mode == "scalar" else data.columns
    placed = sweep_positions(data, params, between, equal, [F.col(f"`{c}`") for c in columns], order, low_open)
    wanted = max_rows if row_mode == "many" else 1
    size = F.greatest(F.col("end") - F.col("first"), F.lit(0))
    ranges = placed.ranges.withColumn("size", size)
    last = F.col("first") + F.least(F.col("size"), F.lit(wanted)) - 1
    asked = ranges.where(F.least(F.col("size"), F.lit(wanted)) > 0).select(
        PARAM_ID, *placed.keys, "first", F.explode(F.sequence(F.col("first"), last)).alias("asked")
    )
    rows = placed.rows.select(
        *[F.col(k).alias(f"b_{k}") for k in placed.keys], "pos", *[f"v{i}" for i in range(len(columns))]
    )
    values = [f"__v{i}" for i in range(len(columns))]
    met = asked.join(rows, _same_place("asked", "pos", placed.keys)).select(
        F.col(PARAM_ID).alias("__of"),
        (F.col("pos") - F.col("first") + 1).alias("__row_no"),
        *[F.col(f"v{i}").alias(v) for i, v in enumerate(values)],
    )
    sizes = ranges.select(PARAM_ID, F.col("size").alias("__size"))
    known = placed.params.join(sizes, PARAM_ID).join(met, F.col(PARAM_ID) == F.col("__of"), "left")
    own = [F.col(c) for c in params.columns]
    if row_mode == "scalar":
        return known.select(*own, F.col("__v0").alias("value"))
    found = [F.col(v).alias(c) for v, c in zip(values, columns)]
    if row_mode == "single":
        return known.select(*own, *found)
    row_no = F.coalesce("__row_no", F.lit(0).cast("bigint"))
    return known.select(*own, row_no.alias("row_no"), (F.col("__size") > max_rows).alias("truncated"), *found)
