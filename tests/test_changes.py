import random
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest

from sparkq.operators import changes as C
from sparkq.operators import reuse as R
from sparkq.plans import staging
from sparkq.streaming.changes import (
    apply_once_batches,
    apply_once_stream,
    change_stream,
    fan_out_stream,
    notification_source,
    notifications,
)

T0 = datetime(2024, 1, 1)


def sample_rows(n=400, seed=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        watch = "hot" if rng.random() < 0.6 else f"w{rng.randrange(4)}"
        cursor = rng.choice(["1", "1", "2", None])
        error = "boom" if rng.random() < 0.1 else None
        out.append((i, watch, T0 + timedelta(seconds=i // 3), cursor, error))
    return out


SCHEMA = "id int, watch string, ts timestamp_ntz, cursor string, error string"


def brute(rows):
    last, versions, events, stamps = {}, {}, [], []
    for i, watch, ts, cursor, error in sorted(rows, key=lambda r: (r[2], r[0])):
        if error:
            continue
        if last.get(watch) is not None and cursor != last[watch]:
            versions[watch] = versions.get(watch, 0) + 1
            events.append((i, last[watch], versions[watch]))
        last[watch] = cursor
        stamps.append((i, versions.get(watch, 0)))
    return sorted(events), sorted(stamps)


def test_one_one_two_is_one_event(spark, rows):
    df = spark.createDataFrame([(i, "w", T0, c, None) for i, c in enumerate(["1", "1", "2"])], SCHEMA)
    got = C.change_events(df, "watch", ["ts", "id"], "cursor").select("id", "previous")
    assert rows(got) == [(2, "1")]


def test_value_to_none_emits_and_none_to_value_is_silent(spark, rows):
    df = spark.createDataFrame([(i, "w", T0, c, None) for i, c in enumerate([None, "1", None, "2", "2"])], SCHEMA)
    assert rows(C.change_events(df, "watch", ["ts", "id"], "cursor").select("id")) == [(2,)]


@pytest.mark.parametrize("hot_rows", [10**9, 20])
def test_batch_matches_brute_force(spark, rows, hot_rows):
    data = sample_rows()
    df = spark.createDataFrame(data, SCHEMA)
    events, stamps = brute(data)
    got = C.change_events(df, "watch", ["ts", "id"], "cursor", "error", hot_rows)
    assert rows(got.select("id", "previous")) == sorted(((i, p) for i, p, _ in events), key=repr)
    got = C.version_stamps(df, "watch", ["ts", "id"], "cursor", "error", hot_rows)
    assert rows(got.select("id", "version")) == sorted(stamps, key=repr)


def staged_folders(spark):
    folder = Path(staging.shared_dir(spark).removeprefix("file:")) / "sparkq"
    return sorted(p.name for p in folder.iterdir()) if folder.exists() else []


def write_parts(spark, data, schema, path, parts):
    """One file per part, so that a file stream reads them as micro-batches."""
    size = -(-len(data) // parts)
    for p in range(parts):
        chunk = spark.createDataFrame(data[p * size:(p + 1) * size], schema)
        chunk.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(chunk.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch(spark, rows, tmp_path):
    data = sample_rows(120)
    events, _ = brute(data)
    stream = write_parts(spark, data, SCHEMA, str(tmp_path / "in"), 3)
    staged_before = staged_folders(spark)
    query = change_stream(
        stream, "watch", ["ts", "id"], "cursor", str(tmp_path / "out"), str(tmp_path / "work"), error="error"
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 3
    assert staged_folders(spark) == staged_before  # micro-batches stage nothing
    assert rows(got.select("id", "previous", "version")) == sorted(events, key=repr)


def test_change_stream_goes_on_after_a_restart(spark, rows, tmp_path):
    """Cursor and version are those of before the restart; state holds a row for each watch."""
    data = sample_rows(120)
    events, _ = brute(data)
    for part in (data[:50], data[50:]):
        stream = write_parts(spark, part, SCHEMA, str(tmp_path / "in"), 2)
        query = change_stream(
            stream, "watch", ["ts", "id"], "cursor", str(tmp_path / "out"), str(tmp_path / "work"), error="error"
        )
        query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got.select("id", "previous", "version")) == sorted(events, key=repr)
    state = query.lastProgress["stateOperators"][0]
    assert state["numRowsTotal"] == len({w for _, w, *_ in data})


def test_fan_out_follows_the_subscriptions(spark, rows, tmp_path):
    (tmp_path / "in").mkdir()
    lists = [[("a", "s1")], [("a", "s2"), ("b", "s3")]]
    for i, subs in enumerate(lists):
        (tmp_path / "in" / f"{i}.txt").write_text('{"user_id":"a"}\nall of you\n{"user_id":"b"}\n')
        query = fan_out_stream(
            notifications(notification_source(spark, str(tmp_path / "in"))),
            lambda subs=subs: spark.createDataFrame(subs, "user_id string, sub string"),
            str(tmp_path / "out"), str(tmp_path / "work"),
        )
        query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("batch_id", "audience", "user_id", "sub")
    assert rows(got) == sorted(
        [(0, "all", None, None), (0, "user", "a", "s1"), (1, "all", None, None), (1, "user", "a", "s2"), (1, "user", "b", "s3")],
        key=repr,
    )


@pytest.mark.parametrize("parts", [1, 4])
def test_first_request_of_a_key_wins_across_batches(spark, rows, tmp_path, parts):
    data = [(i, (i * 7) % 60, "s" if i % 5 else None, f"k{i % 11}") for i in range(60)]
    stream = write_parts(spark, data, "id int, seq int, idempotency_scope_hash string, idempotency_key string", str(tmp_path / "in"), parts)
    query = apply_once_batches(stream, ["seq"], str(tmp_path / "out"), str(tmp_path / "work"))
    query.awaitTermination()
    size, first = 60 // parts, {}
    for p in range(parts):
        batch = sorted(data[p * size : (p + 1) * size], key=lambda r: r[1])
        for i, _, scope, key in batch:
            first.setdefault((scope, key), (i, size * p))
        # Within a micro-batch the least order wins, and an earlier micro-batch before a later one.
    got = spark.read.parquet(str(tmp_path / "out")).select("id")
    assert rows(got) == sorted(((i,) for i, _ in first.values()), key=repr)


PAYLOADS = {
    "": (None, None),
    "row 42 changed": (None, None),
    '{"user_id":"u-42","table":"orders"}': ("u-42", None),
    '{"session_id":"sess-abc"}': (None, "sess-abc"),
    '{"user_id":42,"session_id":"s"}': (None, "s"),
    '["u-42"]': (None, None),
    '"u-42"': (None, None),
    '{"user_id":null}': (None, None),
    ' {"user_id":"spaced"}': ("spaced", None),
    '{"user\\u005fid":"escaped"}': ("escaped", None),
}


def test_notifications(spark):
    df = spark.createDataFrame([(p,) for p in PAYLOADS], "payload string")
    got = {r["payload"]: (r["user_id"], r["session_id"]) for r in C.parse_notifications(df).collect()}
    assert got == PAYLOADS


def test_notification_stream_from_text_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("\n".join(PAYLOADS))
    parsed = notifications(notification_source(spark, str(tmp_path / "in")))
    query = (
        parsed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "work")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["payload"]: (r["user_id"], r["session_id"]) for r in got} == PAYLOADS
    with pytest.raises(ValueError):
        notification_source(spark)


@pytest.mark.parametrize("small", [True, False])
def test_fan_out(spark, rows, monkeypatch, small):
    monkeypatch.setattr(C, "is_small", lambda *_: small)
    events = spark.createDataFrame([(1, "a"), (2, None), (3, "z")], "id int, user_id string")
    subs = spark.createDataFrame([("a", "s1"), ("a", "s2"), ("b", "s3")], "user_id string, sub string")
    out = C.fan_out(events, subs)
    assert rows(out.select("audience", "id", "sub")) == [("all", 2, None), ("user", 1, "s1"), ("user", 1, "s2")]
    assert rows(C.deliveries_for(out, "sub", "s1").select("id")) == [(1,), (2,)]
    assert rows(C.deliveries_for(out, "sub", "s3").select("id")) == [(2,)]


def test_interval_floor():
    assert C.check_interval() == 1000
    with pytest.raises(ValueError):
        C.check_interval(99)


def test_reuse(spark, rows):
    now = datetime(2024, 1, 1, 12, tzinfo=UTC)
    results = spark.createDataFrame(
        [("f1", now - timedelta(seconds=30)), ("f2", now - timedelta(seconds=90))],
        "fingerprint string, computed_at timestamp",
    )
    assert [r[0] for r in rows(R.fresh_results(results, now).select("fingerprint"))] == ["f1"]
    assert R.fresh_results(results, now, 0).count() == 2
    requests = spark.createDataFrame(
        [(1, "f1", "success"), (2, "f2", "success"), (3, "f2", "success"), (4, "f3", "timeout"), (5, "f3", "success")],
        "request_id int, fingerprint string, status string",
    )
    fresh = R.fresh_results(results, now)
    assert rows(R.missing_requests(requests, fresh)) == [("f2", 2), ("f3", 2)]
    got = R.reuse_outcomes(requests, fresh, labels=(), order=("request_id",))
    assert rows(got) == [(2, 3, 2)]
    for mode, procedure in (("affected_rows", False), ("stream", False), ("many", True)):
        with pytest.raises(ValueError):
            R.check_cacheable(mode, procedure)
    R.check_cacheable("scalar")


def test_idempotent_stream_across_batches(spark, rows, tmp_path):
    data = [(i, T0.replace(tzinfo=UTC) + timedelta(seconds=i), "s", f"k{i % 7}") for i in range(60)]
    schema = "id int, ts timestamp, idempotency_scope_hash string, idempotency_key string"
    stream = write_parts(spark, data, schema, str(tmp_path / "in"), 3)
    query = (
        apply_once_stream(stream, "ts", "1 hour").writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "work"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("idempotency_key")
    assert rows(got) == [(f"k{i}",) for i in range(7)]


def test_first_requests_pass_no_python(spark, rows, tmp_path):
    data = [(i, (i * 7) % 90, None if i % 4 == 0 else "s", f"k{i % 13}") for i in range(90)]
    schema = "id int, seq int, idempotency_scope_hash string, idempotency_key string"
    stream = write_parts(spark, data, schema, str(tmp_path / "in"), 3)
    query = apply_once_batches(stream, ["seq"], str(tmp_path / "out"), str(tmp_path / "work"))
    query.awaitTermination()
    first = {}
    for p in range(3):
        for i, _, scope, key in sorted(data[p * 30 : (p + 1) * 30], key=lambda r: r[1]):
            first.setdefault((scope, key), i)
    got = spark.read.parquet(str(tmp_path / "out")).select("id")
    assert rows(got) == sorted(((i,) for i in first.values()), key=repr)
    assert "Python" not in (plan := query._jsq.explainInternal(False)) and "PySpark" not in plan


@pytest.mark.parametrize("kind", ["double", "array<int>"])
def test_a_busy_watch_passes_python_as_runs(spark, rows, tmp_path, kind):
    """One watch fills several ranges and micro-batches; NaN is equal to NaN, as in a batch."""
    rng = random.Random(6)
    values = [1.0, 2.0, float("nan"), None] if kind == "double" else [[1], [1, 2], [], None]
    data = [(i, "one", T0 + timedelta(seconds=i // 3), rng.choice(values), None) for i in range(360)]
    schema = SCHEMA.replace("cursor string", f"cursor {kind}")
    stream = write_parts(spark, data, schema, str(tmp_path / "in"), 3)
    query = change_stream(
        stream, "watch", ["ts", "id"], "cursor", str(tmp_path / "out"), str(tmp_path / "work"), error="error"
    )
    query.awaitTermination()
    df = spark.createDataFrame(data, schema)
    events = C.change_events(df, "watch", ["ts", "id"], "cursor", "error").select("id", "previous")
    want = events.join(C.version_stamps(df, "watch", ["ts", "id"], "cursor", "error").select("id", "version"), "id")
    got = spark.read.parquet(str(tmp_path / "out")).select("id", "previous", "version")
    # By text, as NaN is not equal to itself.
    assert list(map(repr, rows(got))) == list(map(repr, rows(want)))
    python = [x for x in query._jsq.explainInternal(False).splitlines() if "TransformWithStateInPySpark" in x]
    assert python and not any("id#" in x.replace("__", "") for x in python)
