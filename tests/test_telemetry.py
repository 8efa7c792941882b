import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sparkq.operators import telemetry as T
from sparkq.streaming.polling import poll_samples, sample
from sparkq.streaming.waiting import rollup_stream
from test_changes import write_parts

T0 = datetime(2024, 1, 1)
SCHEMA = "request_id int, backend string, driver string, status string, started_at timestamp_ntz, duration_ms bigint, n_rows bigint"


def call_rows(n=300, seed=1):
    rng = random.Random(seed)
    return [
        (
            i, f"b{i % 2}", "pg" if rng.random() < 0.7 else "my", rng.choice(["success", "timeout"]),
            T0 + timedelta(milliseconds=rng.randrange(0, 200) * 500), rng.choice([0, 500, 1500, 90_000]), i % 5,
        )
        for i in range(n)
    ]


def test_rollup(spark):
    df = spark.createDataFrame(call_rows(), SCHEMA)
    got = {(r["backend"], r["status"]): r for r in T.call_rollup(df, ["backend", "status"], quantiles=[0.5]).collect()}
    part = [r for r in call_rows() if r[1] == "b0" and r[3] == "timeout"]
    row = got["b0", "timeout"]
    assert row["calls"] == len(part) and row["duration_ms_sum"] == sum(r[5] for r in part)
    assert row["le_500"] == sum(r[5] <= 500 for r in part) and row["rows_max"] == max(r[6] for r in part)
    assert row["p50"] in {r[5] for r in part}


def test_status_classes(spark):
    want = {
        None: "success", "pool_timeout": "timeout", "timeout": "timeout", "connect": "transport_error",
        "driver": "transport_error", "prepare": "transport_error", "execute": "transport_error",
        "serialize": "transport_error", "invalid_spec": "invalid_spec", "profile_not_found": "invalid_spec",
    }
    df = spark.createDataFrame([(k,) for k in want], "kind string")
    assert {r[0]: r[1] for r in df.select("kind", T.classify_status("kind")).collect()} == want
    df = spark.createDataFrame([(c,) for c in ("26000", "42P18", "0A000", "1615", "23505", None)], "code string")
    assert [r[0] for r in df.select(T.is_stale("code")).collect()] == [True] * 4 + [False] * 2


def test_retries(spark, rows):
    df = spark.createDataFrame(
        [("b", "pg", "26000", 0), ("b", "pg", "26000", 1), ("b", "pg", None, 0), ("b", "pg", "1615", 0)],
        "backend string, driver string, code string, attempt int",
    )
    assert rows(T.prepare_retries(df)) == [("b", "pg", 2)]


def peak(data, driver):
    edges = []
    for r in data:
        if r[2] == driver:
            edges += [(r[4], 1), (r[4] + timedelta(milliseconds=r[5]), -1)]
    level, best, at = 0, -(10**9), None
    for instant in sorted({e[0] for e in edges}):
        level += sum(d for t, d in edges if t == instant)
        if level > best:
            best, at = level, instant
    return best, at


@pytest.mark.parametrize("slice_seconds", [1, 7, 3600])
def test_concurrency_matches_brute_force(spark, rows, slice_seconds):
    data = call_rows()
    got = T.concurrency(spark.createDataFrame(data, SCHEMA), slice_seconds=slice_seconds)
    assert rows(got) == [("my", *peak(data, "my")), ("pg", *peak(data, "pg"))]


def test_running_at(spark, rows):
    data = [(1, "b", "pg", "s", T0, 1000, 0), (2, "b", "pg", "s", T0, 5000, 0), (3, "b", "pg", "s", T0 + timedelta(seconds=9), 5000, 0)]
    at = F.lit("2024-01-01 00:00:01").cast("timestamp")
    got = T.running_at(spark.createDataFrame(data, SCHEMA), at).select("request_id", "age_ms")
    assert rows(got) == [(2, 1000)]


def test_cache_counts(spark, rows):
    df = spark.createDataFrame(
        [("b", "pg", "hit", False), ("b", "pg", "miss", True), ("b", "pg", "miss", False), ("b", "pg", None, None)],
        "backend string, driver string, cache string, cache_written boolean",
    )
    assert rows(T.cache_counts(df)) == [("b", "pg", 1, 2, 1)]


def test_heartbeats(spark, rows):
    df = spark.createDataFrame([("b", "pg", d) for d in (0, 99, 100, 350)], "backend string, driver string, duration_ms bigint")
    assert rows(T.heartbeats(df, 100)) == [("b", "pg", 4)]
    with pytest.raises(ValueError):
        T.heartbeats(df, 49)


def test_audit(spark, rows):
    df = spark.createDataFrame(
        [(1, "timeout", "u1"), (2, "transport_error", "u2"), (3, "success", "u3"), (4, "invalid_spec", "u4")],
        "request_id int, status string, uri string",
    )
    got = T.audit_failures(df, details=["request_id"], uri="uri")
    assert rows(got) == [(1, "query_timeout", "timeout", "u1"), (2, "query_failed", "transport_error", "u2")]


def test_rollup_stream_closes_windows(spark, rows, tmp_path):
    data = [
        (i, "b", "pg", "success", T0.replace(tzinfo=UTC) + timedelta(minutes=i), 10, 1) for i in range(130)
    ]
    stream = write_parts(spark, data, SCHEMA.replace("timestamp_ntz", "timestamp"), str(tmp_path / "in"), 3)
    query = (
        rollup_stream(stream, "started_at", "1 hour", "5 minutes", ["backend"]).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "work"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select(F.hour("window.start"), "calls")
    assert rows(got) == [(0, 60), (1, 60)]


def test_poll_sample(spark):
    df = spark.createDataFrame([(7, "x")], "n int, other string")
    assert sample(df, "w").select("watch", "cursor").first() == ("w", "7")
    assert sample(df.limit(0), "w").first()["cursor"] is None


def test_polling_keeps_going_after_an_error(spark, tmp_path):
    state = {"n": 0}

    def tracking():
        state["n"] += 1
        if state["n"] == 2:
            raise RuntimeError("connection lost")
        return spark.range(1).selectExpr("5 AS version")

    query = poll_samples(spark, "w", tracking, str(tmp_path / "out"), str(tmp_path / "work"), 100)
    try:
        for _ in range(60):
            query.awaitTermination(1)
            if state["n"] >= 4:
                break
    finally:
        query.stop()
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("poll_id").limit(3).collect()
    assert [r["cursor"] for r in got] == ["5", None, "5"]
    assert "connection lost" in got[1]["error"] and got[0]["error"] is None
    with pytest.raises(ValueError):
        poll_samples(spark, "w", tracking, "x", "y", 50)


def test_running_at_each_instant_matches_a_loop(spark):
    """Calls of very different lengths, some open, some empty, at many instants."""
    rng = random.Random(8)
    calls = [
        (i, T0 + timedelta(milliseconds=rng.randrange(10_000_000)), rng.choice([0, 1, 999, 60_000, 5_000_000, None]))
        for i in range(200)
    ] + [(900, None, 5)]
    instants = [T0 + timedelta(seconds=37 * i) for i in range(300)]
    got = T.running_at_each(
        spark.createDataFrame(calls, "id int, started_at timestamp_ntz, duration_ms bigint"),
        spark.createDataFrame([(t,) for t in [*instants, instants[0]]], "at timestamp_ntz"),
    )
    assert got.columns == ["at", "id", "started_at", "duration_ms", "age_ms"]
    want = {
        (t, i, (t - s) // timedelta(milliseconds=1))
        for t in instants
        for i, s, d in calls
        if s is not None and s <= t and (d is None or s + timedelta(milliseconds=d) > t)
    }
    rows = [(r["at"], r.id, r.age_ms) for r in got.collect()]
    assert len(rows) == len(want) and set(rows) == want
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_sketches_merge_within_the_stated_error(spark):
    import bisect

    rng = random.Random(3)
    rows = [(i % 48, int(rng.expovariate(1 / 500)), None if i % 3 else i) for i in range(40_000)] + [(99, None, None)]
    calls = spark.createDataFrame(rows, "hour int, duration_ms bigint, n_rows bigint").repartition(7)
    hourly = T.call_sketches(calls, ["hour"])
    assert hourly.columns == ["hour", "calls", "duration_ms_sketch", "n_rows_sketch"]
    daily = T.merge_sketches(hourly.withColumn("day", (F.col("hour") / 24).cast("int")), ["day"])
    quantiles = [0.01, 0.25, 0.5, 0.9, 0.99]
    got = T.sketch_quantiles(daily, quantiles).collect()
    for r in got:
        position = 1 if r.measure == "duration_ms" else 2
        values = sorted(x[position] for x in rows if x[0] // 24 == r.day and x[position] is not None)
        low, high = (f(values, r.value) / len(values) for f in (bisect.bisect_left, bisect.bisect_right))
        assert low - T.RANK_ERROR <= r["quantile"] <= high + T.RANK_ERROR, r
    assert len(got) == 2 * 2 * len(quantiles)
    assert {r.day: r.calls for r in daily.collect()} == {0: 20_008, 1: 19_992, 4: 1}
