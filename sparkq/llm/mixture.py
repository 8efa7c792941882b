"""Mixing of sources to target weights over time, in column expressions only.

Each source has a schedule of weights over training time. Its mean decides the source's
share of the words to take, up to a number of passes over the source; the excess is
shared out again by weight until no source is above its bound. Its integral, scaled to
the source's target, is the demand for its words up to any time; the time at which the
demand reaches the place of a document in its source is the document's position.

Documents of a source stand in the order of a hash of id and text, pass after pass.
Words before each are summed in two steps, over cells of a source (ranges of the hash)
and inside a cell, so that a source of any size is spread over many tasks. The last
document taken is cut so that a source's words meet its target.

Defined results: null texts have no words and are never taken; rows without a source
form a source of their own, which comes last; repeated rows are documents of their own.
A row repeated very often falls into one cell, as nothing tells its copies apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from functools import reduce
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkq.plans.ordered import row_index
from sparkq.plans.staging import stage

WORD = r"[^\x20\x09-\x0D]+"
# Cells of a source at least, and rows a cell should have at most.
CELLS, CELL_ROWS = 256, 100_000
# Weights over equal spans of training time, one schedule for each source in turn: the
# first fades, the second is steady, the third comes in later. Means: 5, 2, 1.
SCHEDULES = ((7, 5, 3), (2, 2, 2), (0, 1, 2))


def words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mean(schedule: Sequence[int]) -> float:
    return float(Fraction(sum(schedule), len(schedule)))


def by_turn(turn: Column, values: Sequence) -> Column:
    """The value of the source of rank ``turn``; the values repeat."""
    nth = F.pmod(turn, F.lit(len(values))).cast("int")
    return F.element_at(F.array(*values), nth + 1)


def demand(schedule: Sequence[int]) -> Column:
    """Shares of the schedule's integral up to the end of each span."""
    total = sum(schedule)
    return F.array(*[F.lit(x / total) for x in accumulate(schedule, initial=0)])


def when_demanded(share: Column, reached: Column, spans: int) -> Column:
    """Time (0 to 1) at which the demand has reached ``share`` of its whole."""
    span = F.least(F.size(F.filter(reached, lambda x: x <= share)) - 1, F.lit(spans - 1))
    low, high = F.element_at(reached, span + 1), F.element_at(reached, span + 2)
    return (span + (share - low) / (high - low)) / spans


def targets(sources: DataFrame, share: float, most: int) -> DataFrame:
    """Adds ``target`` to sources (weight, source_size).

    Each round shares out what the bounded sources leave; only sums reach the driver.
    A round bounds at least one more source or is the last.
    """
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    bound = F.col("source_size") * F.lit(float(most))

    def split(left: float, weight: float) -> Column:
        return F.lit(float(left)) * F.col("weight") / F.lit(float(weight)) if weight else F.lit(0.0)

    left, weight, capped = share * total, None, -1
    over = F.lit(False)
    while True:
        row = sources.agg(
            F.count_if(over).alias("n"),
            F.sum(F.when(over, bound).otherwise(0.0)).alias("taken"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["n"] == capped or row["weight"] is None:
            return sources.withColumn("target", F.when(over, bound).otherwise(split(left, weight or 0.0)))
        capped, left, weight = row["n"], share * total - row["taken"], row["weight"]
        over = over | (split(left, weight) > bound)


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    source: str = "source",
    text: str = "text",
    schedules: Sequence[Sequence[int]] = SCHEDULES,
    share: float = 1.5,
    most: int = 2,
) -> DataFrame:
    """Every row of ``docs`` as doc_id, source, size, source_size, target, taken,
    position and uses, in the order of first use.

    Sources take ``schedules`` in turn, by code point, and are to give ``share`` times
    all words together, none more than ``most`` times its own. ``uses`` has a struct
    (words, position) for each pass that takes the document; ``position`` is that of
    the first, null if there is none.
    """
    spans = len(schedules[0])
    if any(len(s) != spans or min(s) < 0 or sum(s) <= 0 for s in schedules):
        raise ValueError("schedules need equal numbers of weights, none negative, not all zero")
    own = F.col(f"`{text}`")
    told = F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("-")), F.lit(":"), F.coalesce(own, F.lit("")))
    sized = stage(
        docs.select(
            F.col(f"`{doc_id}`").alias("doc_id"),
            F.col(f"`{source}`").alias("source"),
            # A key of the source that is never null.
            F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("")).alias("key"),
            words(own).alias("size"),
            F.md5(told.cast("binary")).alias("hash"),
        ),
        "mix-sizes",
    )
    cells = max(CELLS, ceil(sized.count() / CELL_ROWS))
    place = F.conv(F.substring("hash", 1, 8), 16, 10).cast("long")
    sized = sized.withColumn("cell", F.shiftright(place * F.lit(cells), 32))
    sums = stage(sized.groupBy("key", "cell").agg(F.sum("size").alias("words")), "mix-cells")
    sources = sums.groupBy("key").agg(F.sum("words").alias("source_size"))
    sources = row_index(sources.withColumn("last", F.col("key") == ""), ["last", "key"], "turn")
    weights = [F.lit(mean(s)) for s in schedules]
    sources = stage(sources.withColumn("weight", by_turn(F.col("turn"), weights)), "mix-sources")
    sources = targets(sources, share, most).drop("last", "weight")
    before = W.partitionBy("key").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("key", "cell", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    starts = stage(starts.join(sources, "key"), "mix-starts")

    inside = W.partitionBy("key", "cell").orderBy("hash", "size")
    upto = F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow))
    placed = sized.withColumn("upto", upto - F.col("size")).join(starts, ["key", "cell"])
    placed = placed.withColumn("at", F.col("start") + F.col("upto"))

    goal = F.floor(F.col("target") + 0.5)
    reached = by_turn(F.col("turn"), [demand(s) for s in schedules])

    def use(nth: int) -> Column:
        offset = F.col("at") + F.col("source_size") * nth
        taken = F.greatest(F.least(goal - offset, F.col("size")), F.lit(0))
        # The share of the goal, as the last word of a source may round it up.
        when = when_demanded(offset / goal, reached, spans)
        return F.when(taken > 0, F.struct(taken.alias("words"), when.alias("position")))

    uses = F.filter(F.array(*[use(n) for n in range(most)]), lambda u: u.isNotNull())
    mixed = placed.withColumn("uses", uses)
    mixed = mixed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.aggregate("uses", F.lit(0).cast("long"), lambda sum_, u: sum_ + u["words"]).alias("taken"),
        F.try_element_at("uses", F.lit(1))["position"].alias("position"),
        "uses",
    )
    order = [F.col("position").asc_nulls_last(), F.col("doc_id")]
    return mixed.repartitionByRange(*order).sortWithinPartitions(*order)


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each use of a document (doc_id, source, words, position), in the order
    of training."""
    used = mixed.select("doc_id", "source", F.explode("uses").alias("u")).select("doc_id", "source", "u.words", "u.position")
    return used.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")
