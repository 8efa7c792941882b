"""Exact top-k against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkq.llm.topk import block, retrieve, top_k


def brute(rows, k, is_query):
    import math

    good = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, a in good:
        if is_query(q):
            scored = sorted(
                (-sum(x * y for x, y in zip(a, b)), p) for p, b in good if p != q and len(a) == len(b)
            )[:k]
            out |= {(q, r + 1, p, -s) for r, (s, p) in enumerate(scored)}
    return out


def search(spark, rows, k=10, every=5, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = top_k(df, F.col("vec_id") % every == 0, k, **options)
    return {tuple(r) for r in got.collect()}


@pytest.mark.parametrize("kind", ["normal", "lengths", "clustered", "ties"])
def test_against_all_products(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 8))
    if kind == "lengths":
        x *= np.exp(rng.normal(size=(300, 1)) * 2)
    if kind == "clustered":
        x = x[rng.integers(0, 6, 300)] + rng.normal(size=(300, 8)) * 0.01
    if kind == "ties":
        x = np.repeat(x[:3], 100, axis=0)
    rows = [(int(i), v) for i, v in enumerate(x.astype(np.float32).tolist())]
    assert search(spark, rows, stripe=40, group=20) == brute(rows, 10, lambda i: i % 5 == 0)


def test_pruning_paths_agree_with_products():
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16) * 1000
    p = np.rint(centre + rng.normal(size=(5000, 16)) * rng.choice([5, 800], size=(5000, 1))).astype(np.int64)
    q = p[:50]
    best = retrieve(q, np.arange(50), p, np.arange(5000), 10)
    scores = q @ p.T
    for i in range(50):
        want = sorted((-s, j) for j, s in enumerate(scores[i].tolist()) if j != i)[:10]
        got = sorted((-s, j) for s, j in zip(best.score[best.row == i].tolist(), best.id[best.row == i].tolist()))
        assert got == want


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 2.0]),
        (5, [1.0, float("nan")]),
        (10, None),
        (15, [1.0, None]),
        (20, [float("inf"), 1.0]),
        (25, [3.0, -1.0, 2.0]),
        (30, []),
        (None, [9.0, 9.0]),
        (1, [0.5, -0.25]),
        (2, [0.0, 0.0]),
        (3, [float(2**40), 1.0]),
    ]
    got = search(spark, rows)
    assert got == brute(rows, 10, lambda i: i % 5 == 0)
    assert not search(spark, [])
    # An id that comes twice queries once.
    twice = search(spark, [(0, [1.0]), (0, [1.0]), (1, [2.0])])
    assert twice == {(0, 1, 1, 1024 * 2048)}


def test_own_rows_take_no_place(spark):
    rng = np.random.default_rng(8)
    p = rng.normal(size=(211, 8))
    p = np.rint(1024 * p / np.linalg.norm(p, axis=1)[:, None]).astype(np.int64)
    p[200:] = p[0]
    ids = np.r_[np.arange(200), np.zeros(11, np.int64)]
    best = retrieve(p[:1], ids[:1], p, ids, 10)
    want = sorted((-s, j) for j, s in enumerate((p[:200] @ p[0]).tolist()) if j)[:10]
    assert sorted(zip((-best.score).tolist(), best.id.tolist())) == want
    rows = [(int(i), v) for i, v in zip(ids, (p / 1024).tolist())]
    assert search(spark, rows, every=1000) == brute(rows, 10, lambda i: i == 0)


def test_rows_of_one_id_are_dealt_apart(spark):
    rows = spark.range(1000).select(F.lit(7).cast("long").alias("vec_id"), F.col("id").alias("salt"))
    assert rows.select(block(8, "vec_id", "salt")).distinct().count() == 8
