"""The strict JSON reader against Python's, which is strict but for the names of non-finite numbers."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparkq.functions.encode import inline_json
from sparkq.functions.jsontext import is_json, members
from sparkq.operators.changes import parse_notifications
from sparkq.operators.shape import row_count_hint


def refuse(name):
    raise ValueError(name)


def valid(text):
    try:
        json.loads(text, parse_constant=refuse)
        return True
    except ValueError:
        return False


TEXTS = [
    '{"user_id":"u1"} junk', "{'user_id':'u1'}", '{"user_id":"u1","x":NaN}', '{"user_id":"u1"}{"user_id":"u2"}',
    '{"a":1,"a":2}', '{"user_id":"u1","user_id":"u2"}', '{"a":{"b":1,"b":2},"user_id":"u"}', "[1]", "", "5", '"x"', "null",
    '{"a":1}],[', '{},{"user_id":"u1"}', '{"user_id":"u1"},', ' {"user_id":"u1"} ', '{"user_id":01}', '{"user_id":"a\tb"}',
    '{"a":1,}', "[1,2", "tru", '{"user_id":"u1"} // c', "[1,,2]", '"a" "b"', "-Infinity", "1 2", "1,2", '"', '"a', "{", "]", "[]", "{}",
    '{"__seal":"x"}', '{"user_id":"u"}\x00', " {}", "\\", '{"user_id":"ü🦜"}',
]


def test_validity(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = {r.t: r.ok for r in df.select("t", is_json("t").alias("ok")).collect()}
    assert got == {**{t: valid(t) for t in TEXTS}, None: None}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='{}[]",:1a \\', max_size=12), min_size=40, max_size=200))
def test_validity_of_any_text(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", is_json("t").alias("ok")).collect():
        assert r.ok == valid(r.t), r.t


def test_a_text_cannot_forge_the_end(spark):
    """Members of a second value never count, whatever is closed or opened before it."""
    parts = ['{"user_id":"x"}', "]", "[", ",", '"', "{", "}", '{"__seal":"y"}', '"__seal":', "null"]
    texts = [a + b + c for a in parts for b in parts for c in parts]
    df = spark.createDataFrame([(t,) for t in texts], "payload string")
    for r in parse_notifications(df).collect():
        want = json.loads(r.payload) if valid(r.payload) else None
        assert r.user_id == (want.get("user_id") if isinstance(want, dict) else None), r.payload


@pytest.mark.parametrize(
    "text, n_rows, inlined",
    [
        ('{"a":1,"a":2}', 1, {"a": 2}),
        ('{"rows_affected":3,"rows_affected":4}', 4, {"rows_affected": 4}),
        ('[1,{"b":2}]', 2, [1, {"b": 2}]),
        ('{"a":1} x', None, None),
        ('{"a":{"b":1,"b":2}}', 1, None),
        ('{"contents":[{"b":1,"b":2},2]}', 2, None),
        ('{"contents":"x"}', 1, {"contents": "x"}),
        ('{"rows_affected":"3","contents":null}', 1, {"rows_affected": "3", "contents": None}),
        (None, None, None),
    ],
)
def test_hints_and_inlining(spark, text, n_rows, inlined):
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(row_count_hint("t").alias("n"), F.to_json(F.struct(inline_json("t").alias("v"))).alias("j")).first()
    assert row.n == n_rows and json.loads(row.j).get("v") == inlined


def test_members_that_clash_inside(spark):
    df = spark.createDataFrame([('{"user_id":{"a":1,"a":2},"session_id":"s"}',)], "t string")
    row = df.select(members("t", ["user_id", "session_id"]).alias("m")).selectExpr("m.user_id IS NULL AS gone", "m.session_id::string AS s").first()
    assert (row.gone, row.s) == (True, "s")
