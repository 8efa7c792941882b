import base64
import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from sparkq.functions.cursors import cursor_value_text, decode_cursor, encode_cursor
from sparkq.operators import paging as G


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [(i // 3, i, f"n{i}") for i in range(20)], "day int, id bigint, name string"
    )


def mint(secret, payload):
    body = base64.urlsafe_b64encode(json.dumps(payload, separators=(",", ":")).encode()).rstrip(b"=")
    mac = hmac.new(hashlib.sha256(secret.encode()).digest(), body, hashlib.sha256).digest()
    return f"s.{body.decode()}.{base64.urlsafe_b64encode(mac).rstrip(b'=').decode()}"


def test_token_equals_a_plain_hmac(spark):
    df = spark.createDataFrame([(1, 'q"ö', 1.5, None)], "i int, s string, d double, n string")
    token = df.select(encode_cursor("orders", [F.col(c) for c in df.columns], "key")).first()[0]
    body, mac = token[2:].split(".")
    assert json.loads(base64.urlsafe_b64decode(body + "=" * (-len(body) % 4))) == {
        "v": 1, "b": "orders", "p": "", "k": [1, 'q"ö', 1.5, None],
    }
    expected = hmac.new(hashlib.sha256(b"key").digest(), body.encode(), hashlib.sha256).digest()
    assert mac == base64.urlsafe_b64encode(expected).rstrip(b"=").decode()


def test_decode_refuses_everything_else(spark):
    good = mint("key", {"v": 1, "b": "x", "p": "", "k": [7, "a", None]})
    tokens = {
        "good": good,
        "no profile": mint("key", {"v": 1, "b": "x", "k": []}),
        "other key": mint("other", {"v": 1, "b": "x", "p": "", "k": [7]}),
        "version": mint("key", {"v": 99, "b": "x", "p": "", "k": [7]}),
        "no binding": mint("key", {"v": 1, "p": "", "k": [7]}),
        "no keys": mint("key", {"v": 1, "b": "x", "p": ""}),
        "flipped": good[:5] + ("A" if good[5] != "A" else "B") + good[6:],
        "cut": good[:-1], "longer": good + "x", "empty": "", "word": "not-a-cursor",
        "no mac": "s.no-mac", "no body": "s..", "null": None, "dots": good + ".x",
    }
    df = spark.createDataFrame(list(tokens.items()), "name string, token string")
    got = {r["name"]: r["c"] for r in df.select("name", decode_cursor("token", "key").alias("c")).collect()}
    assert {n for n, c in got.items() if c is not None} == {"good", "no profile"}
    assert got["good"]["b"] == "x" and [k.toPython() for k in got["good"]["k"]] == [7, "a", None]
    assert got["no profile"]["p"] == ""


SPEC = G.StreamSpec("events", ("day", "id"), "secret")


def walk(df, spec, size):
    token, seen, pages = None, [], 0
    while True:
        page = G.stream_page(spec, df, token, size)
        got = [r["id"] for r in page.rows.collect()]
        if not got:
            assert page.next_cursor is None
            return seen, pages
        seen, pages, token = seen + got, pages + 1, page.next_cursor


def test_walking_all_pages(events):
    seen, pages = walk(events, SPEC, 6)
    assert seen == list(range(20)) and pages == 4


def test_short_page_still_has_a_cursor(events):
    page = G.stream_page(SPEC, events, None, 50)
    assert not page.truncated and page.next_cursor is not None
    assert G.next_cursor(SPEC, events.select("id")) is None
    assert G.next_cursor(SPEC, events.where("id < 0")) is None


def test_truncated_page(events):
    page = G.stream_page(SPEC, events, None, 10, max_rows=4)
    assert page.truncated and page.rows.count() == 4
    assert [r["id"] for r in G.stream_page(SPEC, events, page.next_cursor, 2).rows.collect()] == [4, 5]


def test_initial_values(events):
    spec = G.StreamSpec("events", ("id",), "secret", {"id": 16})
    assert [r["id"] for r in G.stream_page(spec, events, "", 10).rows.collect()] == [17, 18, 19]


def test_cursor_errors(events):
    with pytest.raises(G.CursorError, match="text token"):
        G.open_cursor(SPEC, events, 5)
    with pytest.raises(G.CursorError, match="altered"):
        G.open_cursor(SPEC, events, "s.a.b")
    with pytest.raises(G.CursorError, match="belongs to `other`"):
        G.open_cursor(SPEC, events, mint("secret", {"v": 1, "b": "other", "p": "", "k": [1, 2]}))
    with pytest.raises(G.CursorError, match="holds 1 key"):
        G.open_cursor(SPEC, events, mint("secret", {"v": 1, "b": "events", "p": "", "k": [1]}))
    # The profile is written but not compared.
    token = mint("secret", {"v": 1, "b": "events", "p": "blue", "k": [1, 2]})
    assert G.open_cursor(SPEC, events, token) == [1, 2]


def test_spec_errors():
    for columns, initial in (((), {}), (("a;b",), {}), (("a",), {"b": 1})):
        with pytest.raises(ValueError):
            G.StreamSpec("x", columns, "k", initial)


def test_keyset_page_is_a_pushed_filter_and_top_n(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_totalprice")
    page = G.keyset_page(orders, ["o_orderkey"], [50], 10)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "GreaterThan(o_orderkey,50)" in plan


def test_offset_cursor(events):
    first, cursor = G.offset_page(events, ["id"], None, 8)
    second, cursor2 = G.offset_page(events, ["id"], cursor, 8)
    third, _ = G.offset_page(events, ["id"], cursor2, 8)
    ids = [r["id"] for p in (first, second, third) for r in p.collect()]
    assert ids == list(range(20))
    for bad in ("-1", "x", "", "1.5", str(2**64)):
        with pytest.raises(G.CursorError):
            G.parse_offset(bad)


def test_manifest_equals_walking(spark):
    # A third of all rows share the leading key.
    df = spark.range(900).select(
        F.when(F.col("id") < 300, F.lit(5)).otherwise(F.col("id") % 40).cast("int").alias("day"), "id"
    )
    spec = G.StreamSpec("m", ("day", "id"), "secret")
    got = G.page_manifest(df, ["day", "id"], 70, spec).orderBy("page").collect()
    ordered = sorted(map(tuple, df.collect()))
    chunks = [ordered[i:i + 70] for i in range(0, len(ordered), 70)]
    assert [(r["page"], r["n_rows"]) for r in got] == [(i, len(c)) for i, c in enumerate(chunks)]
    assert [(r["first_day"], r["first_id"]) for r in got] == [c[0] for c in chunks]
    assert [(r["last_day"], r["last_id"]) for r in got] == [c[-1] for c in chunks]
    assert got[-1]["next_cursor"] is None
    after = G.open_cursor(spec, df, got[2]["next_cursor"])
    page = G.keyset_page(df, ["day", "id"], after, 70)
    assert [tuple(r) for r in page.collect()] == chunks[3]


LISTED = "id bigint, uri string, name string, description int, mime_type string"


def test_resource_page(spark):
    df = spark.createDataFrame(
        [(1, "r://1", "one", 1, None), (2, None, "two", 2, None), (3, "r://3", None, 3, "text/plain")], LISTED
    )
    page, cursor = G.resource_page(df, "id", None, 2)
    assert [tuple(r) for r in page.collect()] == [("r://1", "one", None, None)]
    assert cursor == "1"  # the last row with a uri
    page, cursor = G.resource_page(df, "id", 2, 2)
    assert [r["uri"] for r in page.collect()] == ["r://3"] and cursor is None
    for size in (0, 1001):
        with pytest.raises(ValueError):
            G.resource_page(df, "id", None, size)
    with pytest.raises(ValueError):
        G.resource_page(df, "id; drop", None, 2)


def test_listing_counts_skipped_rows(spark):
    df = spark.range(10).select(
        "id", F.when(F.col("id") != 1, F.concat(F.lit("r://"), F.col("id").cast("string"))).alias("uri")
    )
    pages = {r["uri"]: r["page"] for r in G.resource_listing(df, "id", 3).collect()}
    assert len(pages) == 9 and pages["r://2"] == 0 and pages["r://3"] == 1 and pages["r://9"] == 3


def test_cursor_value_text(spark):
    df = spark.createDataFrame([(5, "x", True, None)], "i int, s string, b boolean, n string")
    assert list(df.select(*[cursor_value_text(c) for c in df.columns]).first()) == ["5", "x", "true", ""]


@pytest.mark.parametrize("size", [1, 7, 40, 1000])
def test_all_pages_equal_paging_to_the_end(spark, size):
    data = spark.createDataFrame([(None if i % 4 == 0 else i % 3, i) for i in range(40)], "k int, u int").repartition(5)
    spec = G.StreamSpec("b", ("k", "u"), "secret")
    token, number, want = None, 0, []
    while size > 1:
        page = G.stream_page(spec, data, token, size)
        token = page.next_cursor
        if token is None:
            break
        want += [(number, r.k, r.u, token) for r in page.rows.collect()]
        number += 1
    got = sorted(map(tuple, G.all_pages(data, spec, size).collect()), key=repr)
    if size == 1:
        assert len({r[0] for r in got}) == len({r[3] for r in got}) == 40
    else:
        assert got == sorted(want, key=repr)
    with pytest.raises(ValueError):
        G.all_pages(data, spec, 0)
