"""Join helper shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than this share of the rows is hot; so there are fewer than
# HOT_KEYS hot keys, whatever the size of the table.
HOT_KEYS = 1000


def join_unique(left: DataFrame, right: DataFrame, key: str, count: str) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row for each value of
    ``key`` and in ``count`` the number of rows of ``left`` with it.

    Hot keys (fewer than ``HOT_KEYS`` of them) are broadcast, so their rows stay
    where they are; the rest is joined by shuffle. Both sides are read twice and
    should be staged. Null keys find no partner.
    """
    total = right.agg(F.sum(count)).first()[0] or 0
    limit = total // HOT_KEYS
    hot = right.where(F.col(count) > limit).drop(count)
    rest = right.where(F.col(count) <= limit).drop(count)
    by_copy = left.join(F.broadcast(hot), key)
    by_key = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(rest, key)
    return by_copy.unionByName(by_key)
