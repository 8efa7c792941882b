"""Replay of a request log against a store with expiry, compared with a plain loop."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkq.operators import reuse as R

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, at timestamp_ntz, fingerprint string, status string"


def brute(rows, ttl, puts=()):
    """(id, outcome, written, stored_at) of each request, one after the other."""
    events = [(at, 0, -1, p, "put") for p, at in puts] + [(at, 1, i, p, s) for i, at, p, s in rows if at]
    store, out = {}, [(i, "miss", False, None) for i, at, _, _ in rows if not at]
    for at, _, i, print_, status in sorted(events, key=lambda e: e[:3]):
        if status == "put":
            store[print_] = at
            continue
        have = store.get(print_)
        if have is not None and (ttl == 0 or at - have <= timedelta(seconds=ttl)):
            out.append((i, "hit", False, have))
        elif status == "success":
            store[print_] = at
            out.append((i, "miss", True, at))
        else:
            out.append((i, "miss", False, None))
    return sorted(out)


def log(n, seed, spread):
    rng = random.Random(seed)
    prints = ["hot"] * 4 + ["a", "b", None]
    return [
        (i, None if i % 97 == 50 else T0 + timedelta(seconds=rng.randrange(spread)), rng.choice(prints), rng.choice(["success", "success", "timeout", None]))
        for i in range(n)
    ]


@pytest.mark.parametrize("hot_rows", [5, 20_000_000])
@pytest.mark.parametrize("ttl, puts", [(10, 0), (10, 6), (1000, 3), (0, 0), (0, 4)])
def test_replay_equals_a_loop(spark, ttl, puts, hot_rows):
    rows = log(300, ttl + puts, 900)
    rng = random.Random(1)
    stored = {(rng.choice(["hot", "a", "new"]), T0 + timedelta(seconds=rng.randrange(-50, 900))) for _ in range(puts)}
    table = spark.createDataFrame(list(stored), "fingerprint string, computed_at timestamp_ntz") if puts else None
    got = R.reuse_within_ttl(
        spark.createDataFrame(rows, SCHEMA).repartition(3), F.col("status") == "success", "at", ["id"], ttl, table, hot_rows=hot_rows
    )
    assert got.columns == ["id", "at", "fingerprint", "status", "outcome", "written", "stored_at"]
    found = sorted(map(tuple, got.select("id", "outcome", "written", "stored_at").collect()), key=lambda r: r[0])
    assert found == brute(rows, ttl, stored)


def test_long_chain(spark):
    """A write in each second for a hot fingerprint: a chain of a few hundred links."""
    rows = [(i, T0 + timedelta(milliseconds=400 * i), "hot", "success") for i in range(600)]
    got = R.reuse_within_ttl(spark.createDataFrame(rows, SCHEMA), F.col("status") == "success", "at", ["id"], 1)
    assert sorted(map(tuple, got.select("id", "outcome", "written", "stored_at").collect())) == brute(rows, 1)
    assert got.where("written").count() == 200


def test_equal_requests_a_day_apart_are_two_misses(spark, rows):
    requests = spark.createDataFrame(
        [(1, T0, "f", "success"), (2, T0 + timedelta(days=1), "f", "success"), (3, T0 + timedelta(days=1, seconds=60), "f", "success")], SCHEMA
    )
    none = spark.createDataFrame([], "fingerprint string")
    assert rows(R.reuse_outcomes(requests, none, (), order=("at", "id"))) == [(1, 2, 2)]
    assert rows(R.reuse_outcomes(requests, none, (), order=("at", "id"), ttl_seconds=0)) == [(2, 1, 1)]
    empty = spark.createDataFrame([], SCHEMA)
    assert R.reuse_within_ttl(empty, F.col("status") == "success", "at", ["id"]).count() == 0


def test_answers_carry_flag_and_take_maps(spark, rows):
    requests = spark.createDataFrame(
        [(1, "f", {"a": "x"}), (2, "g", {"a": "y"}), (3, "g", {"b": "z"}), (4, None, None)], "id int, fingerprint string, vars map<string,string>"
    )
    fresh = spark.createDataFrame([("f", "kept", True)], "fingerprint string, body string, truncated boolean")
    asked = []

    def compute(missing):
        asked.append(missing)
        return missing.select("fingerprint", F.concat(F.lit("new"), "id").alias("body"), (F.col("id") > 3).alias("truncated"))

    answered, new = R.answer_requests(requests, fresh, compute, stored_with=["truncated"])
    got = sorted(map(tuple, answered.select("id", "body", "truncated", "outcome").collect()))
    assert got == [(1, "kept", True, "hit"), (2, "new2", False, "miss"), (3, "new2", False, "miss"), (4, "new4", True, "miss")]
    assert rows(new) == [("g", "new2", False), (None, "new4", True)] and len(asked) == 1
