"""Packing into length buckets that waste the least padding.

Lengths are counted in one global histogram, which has at most ``max_tokens`` bins
because longer documents are cut into pieces of ``max_tokens``. Dynamic programming
over its bins chooses the bucket boundaries with the least total padding. Inside a
bucket sequences are numbered in a global order and batched so that a batch, padded
to the boundary, stays within the token budget.

Null and empty texts are sequences of no tokens; they go to the first bucket. Rows
that repeat a document are sequences of their own, as are rows without id.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.plans.ordered import row_index
from sparkq.plans.staging import stage


def boundaries(histogram: Sequence[tuple[int, int]], buckets: int) -> list[int]:
    """The upper ends of at most ``buckets`` ranges of lengths with the least padding.

    ``histogram`` has (length, number of sequences). Of equally good ends the smaller
    ones are taken. The rows of the table are monotone, so each is filled by halving
    the range of possible ends (O(bins log bins) per bucket).
    """
    if not histogram:
        return []
    lengths, counts = (np.array(c, np.int64) for c in zip(*sorted(histogram)))
    n = len(lengths)
    upto = np.concatenate(([0], np.cumsum(counts)))
    total = np.concatenate(([0], np.cumsum(counts * lengths)))
    buckets = min(buckets, n)

    def padding(i: np.ndarray, j: int) -> np.ndarray:
        """Padding of bins i..j-1 in one bucket."""
        return lengths[j - 1] * (upto[j] - upto[i]) - (total[j] - total[i])

    never = np.int64(1) << 62
    cost = np.full(n + 1, never)
    cost[0] = 0
    chosen = []
    for _ in range(buckets):
        nxt, cut = np.full(n + 1, never), np.zeros(n + 1, np.int64)
        nxt[0] = 0
        todo = [(1, n, 0, n - 1)]
        while todo:
            first, last, low, high = todo.pop()
            if first > last:
                continue
            j = (first + last) // 2
            i = np.arange(low, min(high, j - 1) + 1)
            values = np.minimum(cost[i] + padding(i, j), never)
            best = int(np.argmin(values))
            nxt[j], cut[j] = values[best], i[best]
            todo += [(first, j - 1, low, int(cut[j])), (j + 1, last, int(cut[j]), high)]
        chosen.append(cut)
        cost = nxt
    ends, j = [], n
    for cut in reversed(chosen):
        if j == 0:
            break
        ends.append(int(lengths[j - 1]))
        j = int(cut[j])
    return ends[::-1]


def sequences(docs: DataFrame, length: Column, max_tokens: int, *keep: str) -> DataFrame:
    """Columns ``keep``, piece and n_tokens: one row for each piece of at most
    ``max_tokens`` of a document."""
    pieces = F.greatest(F.ceil(F.col("__n") / max_tokens), F.lit(1)).cast("int")
    return (
        docs.select(*keep, F.coalesce(length.cast("long"), F.lit(0)).alias("__n"))
        .select(*keep, "__n", F.posexplode(F.array_repeat(F.lit(0), pieces)).alias("piece", "__one"))
        .select(
            *keep,
            "piece",
            F.least(F.col("__n") - F.col("piece") * max_tokens, F.lit(max_tokens)).cast("int").alias("n_tokens"),
        )
    )


def pack(
    docs: DataFrame,
    doc_id: str,
    length: Column,
    buckets: int = 16,
    max_tokens: int = 4096,
    token_budget: int = 65_536,
) -> DataFrame:
    """One row per sequence: doc_id, piece, n_tokens, bucket, boundary, batch, slot.

    ``batch`` counts inside its bucket; a batch holds ``token_budget // boundary``
    sequences (at least one). The order inside a bucket is that of a hash of the
    document id, so batches mix sources.
    """
    measured = docs.select(F.col(doc_id).alias("doc_id"), length.alias("__len"))
    rows = stage(sequences(measured, F.col("__len"), max_tokens, "doc_id"), "sequences")
    # At most max_tokens + 1 rows come back.
    histogram = [(r["n_tokens"], r["count"]) for r in rows.groupBy("n_tokens").count().collect()]
    ends = boundaries(histogram, buckets)
    if not ends:
        return rows.selectExpr("*", "0 AS bucket", "0 AS boundary", "0L AS batch", "0L AS slot")
    array = F.array(*[F.lit(e) for e in ends])
    bucket = F.size(F.filter(array, lambda end: end < F.col("n_tokens")))
    placed = rows.withColumn("bucket", bucket).withColumn("mix", F.xxhash64("doc_id", "piece"))
    order = ["bucket", "mix", "doc_id", "piece", "n_tokens"]
    numbered = row_index(placed.select(*order), order, "__at")
    # One row per bucket.
    firsts = numbered.groupBy("bucket").agg(F.min("__at").alias("first")).collect()
    first = F.element_at(F.create_map(*[F.lit(x) for r in firsts for x in (r["bucket"], r["first"])]), F.col("bucket"))
    boundary = F.element_at(array, F.col("bucket") + 1)
    room = F.greatest(F.floor(F.lit(token_budget) / F.greatest(boundary, F.lit(1))), F.lit(1))
    at = F.col("__at") - first
    return numbered.select(
        "doc_id",
        "piece",
        "n_tokens",
        "bucket",
        boundary.alias("boundary"),
        F.floor(at / room).cast("long").alias("batch"),
        (at % room).cast("long").alias("slot"),
    )
