"""Exact top-k inner products by norm-bucketed retrieval.

Candidates are dealt into stripes and queries into groups of bounded size; every
group meets every stripe once (a stated query set against all rows, in blocks).
Within such a pair candidates are grouped by length into buckets, longest first. A
bucket's local cosine threshold for a query is the query's k-th best score so far,
divided by the query's length and the bucket's greatest length:

* above 1 the query is done, since no shorter vector can reach its score either;
* from ``COORDINATE_FROM`` on, coordinate pruning: a vector at that cosine must lie in
  a narrow range of the query's largest coordinates;
* below, length pruning: only vectors long enough to reach the score.

What is left is verified by its exact product. The best of all stripes are merged
with a limit per query before the shuffle.

Vectors that are null or hold null or non-finite components take no part, nor do
rows without id. Vectors of different dimension are not compared. A candidate with
the query's own id is left out; an id that comes twice queries once, with its
smallest vector. Empty vectors score zero. Scores beyond a long are held at its
bounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparkq.plans.staging import stage

STRIPE = 65_536
GROUP = 2_048
BUCKET = 1_024
COORDINATE_FROM = 0.9
# Coordinates looked at when pruning by coordinates.
FOCUS = 2
# Bounds are computed in floating point; a bound within this of a score decides nothing.
SLACK = 1e-9
EXACT = float(1 << 53)


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int = 1024) -> DataFrame:
    """vec_id, dim and the vector of floor(scale * x) as little-endian 64-bit integers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims, packed = [], [], []
            for i, v in zip(batch["id"].to_pylist(), batch["v"].to_pylist()):
                if v is None or None in v:
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all():
                    continue
                whole = np.clip(np.floor(x * scale), -(2.0**62), 2.0**62).astype("<i8")
                ids.append(i)
                dims.append(len(whole))
                packed.append(whole.tobytes())
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())],
                ["vec_id", "dim", "v"],
            )

    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"))
    return rows.where("id IS NOT NULL AND v IS NOT NULL").mapInArrow(
        pack, "vec_id long, dim int, v binary"
    )


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<i8").reshape(-1, dim) if dim else np.zeros((len(column), 0), np.int64)


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products: in floats where they hold the integers, else in integers."""
    if not queries.size or not vectors.size:
        return np.zeros((len(queries), len(vectors)), np.int64)
    largest = float(np.abs(queries).max()) * float(np.abs(vectors).max()) * queries.shape[1]
    if largest < EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    if largest < 2.0**62:
        return queries @ vectors.T
    whole = queries.astype(object) @ vectors.astype(object).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


class Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.row, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.threshold = np.full(n, np.iinfo(np.int64).min)
        self.full = np.zeros(n, bool)

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        row, score, ids = (
            np.concatenate(pair) for pair in ((self.row, row), (self.score, score), (self.id, ids))
        )
        # ~score falls as score rises, without the overflow of -score.
        order = np.lexsort((ids, ~score, row))
        row, score, ids = row[order], score[order], ids[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, int)
        place = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
        keep = place < self.k
        self.row, self.score, self.id = row[keep], score[keep], ids[keep]
        last = place == self.k - 1
        self.threshold[row[last]] = score[last]
        self.full[row[last]] = True


def retrieve(q: np.ndarray, q_ids: np.ndarray, p: np.ndarray, p_ids: np.ndarray, k: int) -> Best:
    """Top k of every query among the vectors ``p``."""
    best = Best(len(q), k)
    q_len = np.sqrt((q.astype(np.float64) ** 2).sum(1))
    p_len = np.sqrt((p.astype(np.float64) ** 2).sum(1))
    order = np.argsort(-p_len, kind="stable")
    p, p_ids, p_len = p[order], p_ids[order], p_len[order]
    open_ = np.arange(len(q))
    for at in range(0, len(p), BUCKET):
        vectors, ids, lengths = (x[at : at + BUCKET] for x in (p, p_ids, p_len))
        goal = best.threshold[open_].astype(np.float64)
        reach = q_len[open_] * lengths[0]
        # A score of the threshold still counts, as its id may be smaller.
        alive = ~best.full[open_] | (reach * (1 + SLACK) + SLACK >= goal)
        open_, goal, reach = open_[alive], goal[alive], reach[alive]
        if not len(open_):
            break
        # Queries without k scores yet, or of length zero, rule nothing out.
        bound = best.full[open_] & (reach > 0)
        local = np.divide(goal, reach, out=np.full(len(goal), -np.inf), where=bound)
        by_coordinate = local >= COORDINATE_FROM
        if by_coordinate.any():
            _coordinates(best, open_[by_coordinate], local[by_coordinate], q, q_ids, q_len, vectors, ids, lengths)
        rest = open_[~by_coordinate]
        if len(rest):
            need = np.divide(goal, q_len[open_], out=np.full(len(goal), -np.inf), where=bound)
            need = need[~by_coordinate]
            # Lengths fall, so those long enough for some query are a beginning of the bucket.
            enough = int((lengths * (1 + SLACK) + SLACK >= need.min()).sum())
            scores = products(q[rest], vectors[:enough])
            scores_of(best, rest, scores, q_ids, ids[:enough], k)
    return best


def scores_of(
    best: Best, rows: np.ndarray, scores: np.ndarray, q_ids: np.ndarray, ids: np.ndarray, k: int
) -> None:
    floor = best.threshold[rows]
    other = q_ids[rows][:, None] != ids
    if scores.shape[1] > 4 * k:
        # Rows of the query's own id, however many, take no place among the k best.
        others = np.where(other, scores, np.iinfo(np.int64).min)
        floor = np.maximum(floor, np.partition(others, -k, axis=1)[:, -k])
    r, c = np.nonzero((scores >= floor[:, None]) & other)
    best.add(rows[r], scores[r, c], ids[c])


def _coordinates(best, rows, local, q, q_ids, q_len, vectors, ids, lengths) -> None:
    """Vectors within the range that a cosine of ``local`` leaves to the largest
    coordinates of each query; sorted coordinates give the first range."""
    unit = vectors / np.maximum(lengths, 1e-300)[:, None]
    order = {}
    for row, t in zip(rows.tolist(), np.minimum(local, 1.0).tolist()):
        direction = q[row] / q_len[row]
        focus = np.argsort(-np.abs(direction))[:FOCUS]
        chosen = None
        for f in focus.tolist():
            spread = np.sqrt(max(0.0, (1 - t * t) * (1 - direction[f] ** 2)))
            # A query closer to the axis than the threshold's angle allows its very end.
            low = -1.0 if direction[f] <= -t else direction[f] * t - spread
            high = 1.0 if direction[f] >= t else direction[f] * t + spread
            low, high = low - 1e-7, high + 1e-7
            if chosen is None:
                if f not in order:
                    by = np.argsort(unit[:, f], kind="stable")
                    order[f] = by, unit[by, f]
                by, values = order[f]
                chosen = by[np.searchsorted(values, low) : np.searchsorted(values, high, "right")]
            else:
                x = unit[chosen, f]
                chosen = chosen[(x >= low) & (x <= high)]
        if chosen is not None and len(chosen):
            scores = products(q[row : row + 1], vectors[chosen])
            scores_of(best, np.array([row]), scores, q_ids, ids[chosen], best.k)


def block(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


RESULT = "query_id long, vec_id long, score long"


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = 1024,
    stripe: int = STRIPE,
    group: int = GROUP,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k best other rows of each query row.

    ``is_query`` is a condition on the column vec_id.
    """
    spark = vectors.sparkSession
    # Rows of one id are dealt apart by a number that is written with them.
    salted = quantised(vectors, vec_id, embedding, scale).withColumn("salt", F.monotonically_increasing_id())
    rows = stage(salted, "vectors")
    asked = stage(
        rows.where(is_query).groupBy("vec_id").agg(F.min(F.struct("dim", "v")).alias("one")).select(
            "vec_id", "one.dim", "one.v"
        ),
        "queries",
    )
    # Blocks of bounded size, and enough stripes for all tasks.
    stripes = max(-(-rows.count() // stripe), int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = max(1, -(-asked.count() // group))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = asked.withColumn("g", block(groups, "vec_id")).withColumn("s", every(stripes))
    right = rows.withColumn("s", block(stripes, "vec_id", "salt")).drop("salt").withColumn("g", every(groups))
    keys = ["dim", "g", "s"]

    def best_of(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        schema = pa.schema([(c, pa.int64()) for c in ("query_id", "vec_id", "score")])
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        dim = queries["dim"][0].as_py()
        q_ids = queries["vec_id"].to_numpy()
        found = retrieve(
            _matrix(queries["v"], dim), q_ids, _matrix(candidates["v"], dim), candidates["vec_id"].to_numpy(), k
        )
        return pa.table([q_ids[found.row], found.id, found.score], schema=schema)

    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best_of, RESULT)
    by_score = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        best.withColumn("rank", F.row_number().over(by_score))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
