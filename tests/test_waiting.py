import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkq.operators import waiting as W
from sparkq.streaming.waiting import await_stream, failure_streak_stream
from test_changes import write_parts

T0 = datetime(2024, 1, 1)
SCHEMA = "id int, key string, ts timestamp_ntz, kind string"


def event_rows(n=300, seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(3)}"
        out.append((i, key, T0 + timedelta(seconds=i // 2), rng.choice(["go", "done", "other", "other"])))
    return out


def brute(data, timeout):
    out = []
    for i, key, ts, kind in data:
        if kind != "go":
            continue
        hits = [(t, j) for j, k, t, c in data if k == key and c == "done" and ts <= t <= ts + timeout]
        out.append((i, min(hits)[1] if hits else None, "matched" if hits else "timeout"))
    return sorted(out, key=repr)


def wait(spark, data, **options):
    df = spark.createDataFrame(data, SCHEMA)
    return W.await_match(
        df.where("kind = 'go'"), df, ["key"], "id", "ts", "id", "ts", "kind = 'done'", **options
    )


@pytest.mark.parametrize("hot_rows", [10**9, 20])
def test_await_matches_brute_force(spark, rows, hot_rows):
    data = event_rows()
    got = wait(spark, data, timeout_ms=4000, hot_rows=hot_rows)
    assert rows(got.select("id", "matched_id", "outcome")) == brute(data, timedelta(seconds=4))


def test_bounds_are_inclusive_and_null_is_no_match(spark, rows):
    def at(seconds):
        return T0 + timedelta(seconds=seconds)

    data = [(1, "a", at(0), "go"), (2, "a", at(60), "done"), (3, "b", at(0), "go"), (4, "b", at(0), "done"),
            (5, "c", at(0), "go"), (6, "c", at(61), "done"), (7, "d", at(5), "go"), (8, "d", at(4), "done")]
    got = wait(spark, data)
    assert rows(got.select("id", "outcome", "wait_ms")) == [
        (1, "matched", 60000), (3, "matched", 0), (5, "timeout", 60000), (7, "timeout", 60000),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    never = W.await_match(df.where("kind='go'"), df, ["key"], "id", "ts", "id", "ts", "CAST(NULL AS boolean)")
    assert {r["outcome"] for r in never.collect()} == {"timeout"}


def state_at(data, key, at):
    seen = [(t, i, c) for i, k, t, c in data if k == key and t <= at]
    return max(seen) if seen else None


@pytest.mark.parametrize("hot_rows", [10**9, 50])
def test_state_at_ticks_matches_brute_force(spark, rows, hot_rows):
    data = event_rows(150)
    poll, timeout = 1500, 4000
    want = []
    for i, key, ts, kind in data:
        if kind != "go":
            continue
        hit = None
        for ms in [*range(0, timeout, poll), timeout]:
            state = state_at(data, key, ts + timedelta(milliseconds=ms))
            if state and state[2] == "done":
                hit = (state[1], ms)
                break
        want.append((i, hit[0] if hit else None, hit[1] if hit else timeout))
    got = wait(spark, data, poll_ms=poll, timeout_ms=timeout, quantise=True, hot_rows=hot_rows)
    assert rows(got.select("id", "matched_id", "wait_ms")) == sorted(want, key=repr)


def test_poll_counts(spark, rows):
    waits = spark.createDataFrame(
        [("a", "matched", 0), ("a", "matched", 1), ("a", "matched", 2000), ("b", "timeout", 60000)],
        "backend string, outcome string, wait_ms bigint",
    )
    got = W.poll_counts(waits).select("wait_ms", "polls", "spurious")
    assert rows(got) == [(0, 1, 0), (1, 2, 1), (2000, 3, 2), (60000, 61, 61)]
    assert rows(W.await_metrics(waits, ["backend"])) == [
        ("a", "matched", 3, 6, 3, 2001), ("b", "timeout", 1, 61, 61, 60000),
    ]


def test_await_limits():
    for poll, timeout in ((99, 1000), (1000, 0), (1000, 999)):
        with pytest.raises(ValueError):
            W.check_await(poll, timeout)


def test_await_stream_equals_batch(spark, rows, tmp_path):
    data = event_rows(120)
    data = [(i, None if key == "k0" else key, *rest) for i, key, *rest in data]
    closing = [(900 + i, "end", T0 + timedelta(hours=1), "other") for i in range(30)]
    stream = write_parts(spark, data + closing, SCHEMA, str(tmp_path / "in"), 4)
    query = await_stream(
        stream, F.col("kind") == "go", F.col("kind") == "done", ["key"], "id", "ts",
        str(tmp_path / "out"), str(tmp_path / "work"), delay_ms=2000, timeout_ms=4000,
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("id", "matched_id", "outcome")) == brute(data, timedelta(seconds=4))
    # What the watermark has closed is gone from the state.
    assert sum(s["numRowsTotal"] for s in query.lastProgress["stateOperators"]) < 40


STATUSES = ["success", "timeout", "transport_error", "timeout", "invalid_spec"]
CALLS = "seq int, backend string, status string"


def call_rows(n=300, seed=9):
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.6 else "cold", rng.choice(STATUSES)) for i in range(n)]


def streaks(data):
    streak, out = {}, []
    for seq, backend, status in data:
        failed = status in ("timeout", "transport_error")
        streak[backend] = streak.get(backend, 0) + 1 if failed else 0
        out.append((seq, streak[backend], streak[backend] == 3))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [10**9, 30])
def test_streaks_match_brute_force(spark, rows, hot_rows):
    data = call_rows()
    df = spark.createDataFrame(data, CALLS)
    got = W.failure_streaks(df, ["backend"], ["seq"], threshold=3, hot_rows=hot_rows)
    assert rows(got.select("seq", "streak", "tripped")) == streaks(data)


def test_streak_stream_equals_batch(spark, rows, tmp_path):
    data = call_rows(120)
    stream = write_parts(spark, data, CALLS, str(tmp_path / "in"), 3)
    query = failure_streak_stream(
        stream, "backend", ["seq"], str(tmp_path / "out"), str(tmp_path / "work"), threshold=3
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("seq", "streak", "tripped")) == streaks(data)


def test_a_missing_status_resets_the_streak(spark, rows, tmp_path):
    data = [(i, "b", s) for i, s in enumerate(["timeout", "timeout", None, "timeout", "timeout", "timeout", "success"])]
    want = [(0, 1, False), (1, 2, False), (2, 0, False), (3, 1, False), (4, 2, False), (5, 3, True), (6, 0, False)]
    df = spark.createDataFrame(data, CALLS)
    got = W.failure_streaks(df, ["backend"], ["seq"], threshold=3)
    assert sorted(map(tuple, got.select("seq", "streak", "tripped").collect())) == want
    stream = write_parts(spark, data, CALLS, str(tmp_path / "in"), 2)
    failure_streak_stream(
        stream, "backend", ["seq"], str(tmp_path / "out"), str(tmp_path / "work"), threshold=3
    ).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.select("seq", "streak", "tripped").collect())) == want


@pytest.mark.parametrize("quantise", [False, True])
def test_triggers_without_or_with_equal_ids(spark, rows, quantise):
    """Every trigger has an answer of its own, in both operators."""
    triggers = [(None, "k", T0), (1, "k", T0), (1, "k", T0 + timedelta(seconds=20)), (2, None, T0)]
    checks = [(10, "k", T0 + timedelta(seconds=2), "done"), (11, "k", T0 + timedelta(seconds=21), "done"), (12, None, T0, "done")]
    left = spark.createDataFrame(triggers, "id int, key string, ts timestamp_ntz")
    right = spark.createDataFrame(checks, SCHEMA)
    args = (left, right, ["key"], "id", "ts", "id", "ts")
    match = W.await_match(*args, "kind = 'done'", timeout_ms=5000, quantise=quantise)
    # At its ticks the later trigger sees the state that is left of the first match.
    want = sorted([(None, 10), (1, 10), (1, 10 if quantise else 11), (2, 12)], key=repr)
    assert rows(match.select("id", "matched_id")) == want
    if not quantise:
        both = W.await_condition(*args, "check.kind = 'done' AND check.ts >= trigger.ts", timeout_ms=5000)
        assert rows(both.select("id", "matched_id")) == want


def test_threshold_must_be_positive(spark):
    with pytest.raises(ValueError):
        W.failure_streaks(spark.createDataFrame([], CALLS), ["backend"], ["seq"], threshold=0)


def test_a_busy_service_passes_python_as_runs(spark, rows, tmp_path):
    """All calls are of one service; what meets its state is a few runs, without the calls' columns."""
    rng = random.Random(4)
    data = [(i, "one", rng.choice(STATUSES[:3]), f"payload {i}") for i in range(600)]
    stream = write_parts(spark, data, CALLS + ", payload string", str(tmp_path / "in"), 3)
    query = failure_streak_stream(
        stream, "backend", ["seq"], str(tmp_path / "out"), str(tmp_path / "work"), threshold=3
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("seq", "streak", "tripped")) == streaks([d[:3] for d in data])
    plan = query._jsq.explainInternal(False)
    python = [line for line in plan.splitlines() if "TransformWithStateInPySpark" in line or "MapInArrow" in line]
    assert len(python) == 2 and not any("payload" in line for line in python)
    assert "rangepartitioning" in plan
