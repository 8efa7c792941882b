"""Inputs beyond what the generated tables hold: nulls, ties, duplicates, odd zones."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkq.functions.encode import naive_timestamp_text, zoned_timestamp_text
from sparkq.functions.fingerprints import canonical_json
from sparkq.functions.text import redact_credentials
from sparkq.operators import cost, telemetry
from sparkq.operators import paging as G
from sparkq.operators.changes import parse_notifications
from sparkq.operators.execute import execute
from sparkq.operators.params import QuerySpec
from sparkq.operators.waiting import await_condition, await_match
from sparkq.sources import jdbc

SPEC = G.StreamSpec("b", ("t", "id"), "secret")


def pages(df, spec, size):
    token, out = None, []
    for _ in range(20):
        page = G.stream_page(spec, df, token, size)
        rows = page.rows.collect()
        if not rows:
            return out
        out.append(rows)
        token = page.next_cursor
    raise AssertionError("paging does not end")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_keys_keep_microseconds(spark, kind):
    df = spark.sql(
        f"SELECT CAST(t AS {kind}) AS t, 1 AS id FROM VALUES ('2024-01-01 00:00:00.1231'),"
        " ('2024-01-01 00:00:00.1232'), ('2024-01-01 00:00:00.1233') AS v(t)"
    )
    assert [len(p) for p in pages(df, SPEC, 1)] == [1, 1, 1]


def test_null_keys_are_paged(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1), (3, None), (4, 2)], "t int, id int")
    got = [tuple(r) for p in pages(df, SPEC, 2) for r in p]
    assert got == [(None, 1), (None, 2), (3, None), (3, 1), (4, 2)]


def test_offset_paging_ends(spark):
    df = spark.range(5)
    first, cursor = G.offset_page(df, ["id"], None, 3)
    last, end = G.offset_page(df, ["id"], cursor, 3)
    assert ([r.id for r in first.collect()], cursor, [r.id for r in last.collect()], end) == ([0, 1, 2], "3", [3, 4], None)
    assert G.offset_page(df, ["id"], "5", 3)[1] is None


def test_a_response_is_one_snapshot(spark):
    spark.range(10).createOrReplaceTempView("ten")
    spec = QuerySpec("ten", "SELECT id, uuid() AS u FROM ten ORDER BY id", (), row_mode="stream", max_rows=4)
    answer = execute(spark, spec, stream=G.StreamSpec("ten", ("u",), "secret"))
    rows = answer.rows.collect()
    assert answer.truncated and [r.id for r in rows] == [0, 1, 2, 3]
    assert answer.rows.collect() == rows
    assert G.open_cursor(answer.stream, answer.rows, answer.next_cursor) == [rows[-1].u]
    whole = execute(spark, QuerySpec("ten", "SELECT id FROM ten", ()))
    assert whole.rows.count() == 10 and not whole.truncated


def test_checks_without_a_time(spark):
    triggers = spark.sql("SELECT 1 AS id, 'k' AS k, timestamp_ntz'2024-01-01 00:00:00' AS t UNION ALL SELECT 2, 'k', NULL")
    checks = spark.sql("SELECT 9 AS cid, 'k' AS k, timestamp_ntz'2024-01-01 00:00:05' AS t UNION ALL SELECT 8, 'k', NULL")
    for quantise in (False, True):
        got = await_match(triggers, checks, ["k"], "id", "t", "cid", "t", quantise=quantise)
        assert {r.id: (r.outcome, r.matched_id) for r in got.collect()} == {1: ("matched", 9), 2: ("timeout", None)}


@pytest.mark.parametrize("poll_ms, timeout_ms", [(100, 1000), (300, 1000), (700, 700)])
def test_ticks_by_brute_force(spark, poll_ms, timeout_ms):
    import random

    rng = random.Random(poll_ms)
    states = sorted({(rng.choice([None, "a", "b"]), rng.randrange(0, 6000), rng.random() < 0.3) for _ in range(150)}, key=repr)
    fired = [(i, rng.choice([None, "a", "b"]), rng.randrange(0, 6000)) for i in range(80)]
    at = "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, ms / 1000)"
    checks = spark.createDataFrame([(n, *s) for n, s in enumerate(states)], "cid long, k string, ms long, ok boolean")
    triggers = spark.createDataFrame(fired, "id long, k string, ms long")
    got = await_match(
        triggers.selectExpr("id", "k", f"{at} AS t"), checks.selectExpr("cid", "k", f"{at} AS t", "ok"),
        ["k"], "id", "t", "cid", "t", "ok", poll_ms, timeout_ms, quantise=True,
    )

    def expected(k, t):
        for wait in [*range(0, timeout_ms, poll_ms), timeout_ms]:
            before = [(ms, n, ok) for n, (key, ms, ok) in enumerate(states) if key == k and ms <= t + wait]
            if before and max(before)[2]:
                return ("matched", max(before)[1], wait)
        return ("timeout", None, timeout_ms)

    assert {r.id: (r.outcome, r.matched_id, r.wait_ms) for r in got.collect()} == {
        i: expected(k, t) for i, k, t in fired
    }


def test_conditions_over_both_sides(spark):
    triggers = spark.createDataFrame(
        [(1, "a", 0, 5), (2, "a", 0, 50), (3, None, 0, 1), (4, "b", None, 1)], "id long, k string, ms long, least int"
    )
    checks = spark.createDataFrame(
        [(1, "a", 400, 3), (2, "a", 600, 7), (3, "a", 1500, 99), (4, None, 1000, 2), (5, "b", None, 9)],
        "cid long, k string, ms long, v int",
    )
    at = "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, ms / 1000) AS t"
    got = await_condition(
        triggers.selectExpr("id", "k", at, "least"), checks.selectExpr("cid", "k", at, "v"),
        ["k"], "id", "t", "cid", "t", "check.v >= trigger.least", timeout_ms=1000,
    )
    assert {r.id: (r.matched_id, r.wait_ms) for r in got.collect()} == {
        1: (2, 600), 2: (None, 1000), 3: (4, 1000), 4: (None, 1000)
    }


def test_a_member_that_comes_twice(spark):
    rows = [('{"user_id":"u1","user_id":"u2"}',), ('{"user_id":7}',), ('{"user_id":"a","x":{"b":1,"b":2}}',)]
    got = parse_notifications(spark.createDataFrame(rows, "payload string")).collect()
    assert [r.user_id for r in got] == ["u2", None, "a"]


def test_running_calls_count(spark):
    calls = spark.sql(
        "SELECT 'd' AS driver, timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS started_at,"
        " CAST(IF(id = 3, 100, NULL) AS BIGINT) AS duration_ms FROM range(5)"
    )
    assert telemetry.concurrency(calls).first().peak == 4
    at = F.lit("2024-01-01 01:00:00").cast("timestamp_ntz")
    assert telemetry.running_at(calls, at).count() == 4


PRICE = "backend string, unit string, amount string, currency string"


@pytest.mark.parametrize(
    "rows, message",
    [
        ([("b", "per_foo", "2", "USD")], "unknown unit"),
        ([("b", "per_call", "2", "USD"), ("b", "per_row", "1", "USD")], "more than one price"),
        ([("b", "per_call", "-2", "USD")], "bad amount"),
    ],
)
def test_unusable_prices_are_refused(spark, rows, message):
    calls = spark.sql("SELECT 'b' AS backend, 'success' AS status, 1L AS n_rows, 1L AS payload_bytes")
    for operator in (cost.charges, cost.ledger):
        with pytest.raises(PySparkException, match=message):
            operator(calls, spark.createDataFrame(rows, PRICE)).collect()


def test_nested_numbers_keep_their_kind(spark):
    texts = ['{"a":1.0}', '{"a":1}', "[1.0]", "[1]", '["x, 1.0"]', '["x, 1.0E0"]', "1.0", "1"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(canonical_json("t")).collect()]
    assert len(set(got)) == len(texts)
    same = spark.createDataFrame([('{"b":2.50,"a":[1e0]}',), ('{ "a" : [1.0], "b":2.5 }',)], "t string")
    assert same.select(canonical_json("t")).distinct().count() == 1


def test_times_in_a_zone_with_gaps(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = spark.sql(
            "SELECT timestamp'2024-03-10 02:30:00+00:00' AS t, timestamp_ntz'2024-03-10 02:30:00' AS n"
        ).select(zoned_timestamp_text("t").alias("t"), naive_timestamp_text("n").alias("n")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.t == "2024-03-10T02:30:00+00:00" and row.n == "2024-03-10T02:30:00.000000"


def test_long_schemes_are_redacted(spark):
    texts = ["h" * 300 + "://u:pw@h/d", "a" * 100_000 + "://u:pw@h", "x" * 200_000, "see pg://u:p@h, now"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for anywhere in (False, True):
        got = [r[0] for r in df.select(redact_credentials("t", anywhere=anywhere)).collect()]
        assert not any(":pw@" in t or ":p@" in t for t in got) and got[2] == texts[2]


def test_credentials_leave_the_url():
    spec = jdbc.JdbcTable("postgres", "postgres://us%40er:p%3Aw@h:5432/d?x=1", table="t")
    options = jdbc.reader_options(spec)
    assert options["url"] == "jdbc:postgresql://h:5432/d?x=1"
    assert (options["user"], options["password"]) == ("us@er", "p:w")
    assert jdbc.url_credentials("jdbc:mysql://h/d") == {}
    assert jdbc.jdbc_url("sqlite", "sqlite://rel.db") == "jdbc:sqlite:rel.db"
    assert jdbc.jdbc_url("sqlite", "sqlite:///abs/x.db") == "jdbc:sqlite:/abs/x.db"
    assert jdbc.jdbc_url("sqlite", "sqlite::memory:") == "jdbc:sqlite::memory:"
