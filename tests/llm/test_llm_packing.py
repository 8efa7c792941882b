"""Bucket boundaries against all choices, and batches."""

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sparkq.llm.packing import boundaries, pack


def padding(histogram, ends):
    return sum(n * (min(e for e in ends if e >= size) - size) for size, n in histogram)


@pytest.mark.parametrize("seed", range(12))
def test_boundaries_are_optimal(seed):
    rng = random.Random(seed)
    histogram = [(size, rng.randint(1, 50)) for size in rng.sample(range(0, 60), rng.randint(1, 9))]
    buckets = rng.randint(1, 4)
    ends = boundaries(histogram, buckets)
    sizes = sorted(s for s, _ in histogram)
    best = min(
        padding(histogram, [*some, sizes[-1]])
        for k in range(min(buckets, len(sizes)))
        for some in combinations(sizes[:-1], k)
    )
    assert len(ends) <= buckets and ends[-1] == sizes[-1] and padding(histogram, ends) == best


def test_boundaries_of_nothing_and_of_one():
    assert boundaries([], 4) == [] and boundaries([(7, 3)], 4) == [7]


def test_batches(spark):
    rng = random.Random(1)
    sizes = [rng.choice([0, 1, 5, 6, 7, 40, 41, 100, 250, 1234]) for _ in range(400)] + [None]
    rows = [(i if i else None, n) for i, n in enumerate(sizes)] + [(3, sizes[3])] * 5
    docs = spark.createDataFrame(rows, "doc_id long, n int").withColumn("bucket", F.lit("clash"))
    got = pack(docs, "doc_id", F.col("n"), buckets=4, max_tokens=100, token_budget=500).collect()
    want = Counter()
    for i, n in rows:
        left = n or 0
        piece = 0
        while piece == 0 or left > 0:
            want[i, piece, min(left, 100)] += 1
            left, piece = left - 100, piece + 1
    assert Counter((r.doc_id, r.piece, r.n_tokens) for r in got) == want
    batches = defaultdict(list)
    for r in got:
        assert r.n_tokens <= r.boundary
        batches[r.bucket, r.batch].append(r)
    for rows_ in batches.values():
        assert len({r.boundary for r in rows_}) == 1
        assert len(rows_) * rows_[0].boundary <= max(500, rows_[0].boundary)
        assert sorted(r.slot for r in rows_) == list(range(len(rows_)))
    for b in {r.bucket for r in got}:
        numbers = sorted(k for bucket, k in batches if bucket == b)
        assert numbers == list(range(len(numbers)))
        room = max(500 // max(batches[b, 0][0].boundary, 1), 1)
        assert all(len(batches[b, k]) == room for k in numbers[:-1])


def test_no_rows(spark):
    none = pack(spark.createDataFrame([], "doc_id long, n int"), "doc_id", F.col("n"))
    assert none.count() == 0
    assert none.columns == ["doc_id", "piece", "n_tokens", "bucket", "boundary", "batch", "slot"]
