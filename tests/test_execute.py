import json

import pytest
from pyspark.errors import PySparkException

from sparkq.operators.execute import ListQuery, execute, list_page
from sparkq.operators.paging import CursorError, StreamSpec
from sparkq.operators.params import MissingParameter, QuerySpec


@pytest.fixture
def items(spark):
    rows = [(i, f"r://{i}" if i % 4 else None, f"n{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "id int, uri string, name string")
    df.createOrReplaceTempView("x_items")
    return df


def spec(sql, mode, **options):
    return QuerySpec(name="q", sql=sql, row_mode=mode, **options)


def test_row_modes(spark, items):
    every = "SELECT id, name FROM x_items ORDER BY id"
    many = execute(spark, spec(every, "many", max_rows=3))
    assert [r["id"] for r in many.rows.collect()] == [0, 1, 2] and many.truncated
    assert json.loads(many.json().first()["row"]) == {"id": 0, "name": "n0"}
    assert not execute(spark, spec(every, "many", max_rows=10)).truncated
    assert execute(spark, spec(every, "single")).rows.collect()[0]["id"] == 0
    assert execute(spark, spec("SELECT count(*) AS n FROM x_items", "scalar")).rows.first()[0] == 10
    assert execute(spark, spec("SELECT id FROM x_items WHERE id > 99", "single")).rows.collect() == []
    contents = "SELECT uri, name AS text FROM x_items WHERE id {} 0"
    assert execute(spark, spec(contents.format(">") + " AND uri IS NOT NULL", "resource_contents")).rows.count() == 7
    with pytest.raises(PySparkException, match="resource_contents"):
        execute(spark, spec(contents.format("="), "resource_contents")).rows.collect()
    for mode in ("affected_rows", "result_sets"):
        with pytest.raises(ValueError):
            execute(spark, spec(every, mode))


STREAM = StreamSpec("items", ("id",), "secret")
DOWN = "SELECT id FROM x_items WHERE id < coalesce(:_after_id, 100) ORDER BY id DESC LIMIT 4"


def test_stream_follows_the_statements_own_order(spark, items):
    token, seen = None, []
    while True:
        page = execute(spark, spec(DOWN, "stream"), stream=STREAM, cursor=token)
        got = [r["id"] for r in page.rows.collect()]
        if not got:
            break
        seen, token = seen + got, page.next_cursor
    assert seen == list(range(9, -1, -1)) and page.next_cursor is None


def test_stream_initial_and_errors(spark, items):
    up = spec("SELECT id FROM x_items WHERE id > :_after_id ORDER BY id LIMIT 2", "stream")
    started = StreamSpec("items", ("id",), "secret", {"id": 5})
    assert [r["id"] for r in execute(spark, up, stream=started).rows.collect()] == [6, 7]
    # Without initial values the marker is null and compares to nothing.
    assert execute(spark, up, stream=STREAM).rows.collect() == []
    # Key positions come from the cursor, whatever the caller sends.
    assert [r["id"] for r in execute(spark, up, {"_after_id": 0}, stream=started).rows.collect()] == [6, 7]
    with pytest.raises(CursorError):
        execute(spark, up, stream=STREAM, cursor="s.x.y")
    with pytest.raises(CursorError):
        execute(spark, up, stream=STREAM, cursor=5)
    with pytest.raises(ValueError):
        execute(spark, up)
    other = StreamSpec("other", ("id",), "secret")
    token = execute(spark, up, stream=started).next_cursor
    with pytest.raises(CursorError, match="belongs to"):
        execute(spark, up, stream=other, cursor=token)
    hidden = spec("SELECT name FROM x_items WHERE id > :_after_id", "stream")
    assert execute(spark, hidden, stream=started).next_cursor is None


KEYSET = """SELECT id, uri, name FROM x_items WHERE :cursor IS NULL OR id > CAST(:cursor AS INT)
            ORDER BY id LIMIT :page_size"""


def test_keyset_listing(spark, items):
    listing = ListQuery(KEYSET, cursor_column="id", page_size=4)
    pages, cursor = [], None
    while True:
        rows, cursor = list_page(spark, listing, cursor)
        pages.append([r["name"] for r in rows.collect()])
        if cursor is None:
            break
    assert pages == [["n1", "n2", "n3"], ["n5", "n6", "n7"], ["n9"]]


def test_offset_listing_runs_on(spark, items):
    listing = ListQuery(
        "SELECT uri, name FROM x_items ORDER BY id LIMIT :page_size OFFSET :cursor", mode="offset", page_size=4
    )
    rows, cursor = list_page(spark, listing)
    assert cursor == "4"
    rows, cursor = list_page(spark, listing, cursor)
    assert cursor == "8" and [r["name"] for r in rows.collect()] == ["n5", "n6", "n7"]
    rows, cursor = list_page(spark, listing, cursor)
    assert cursor is None and [r["name"] for r in rows.collect()] == ["n9"]
    with pytest.raises(CursorError):
        list_page(spark, listing, "-1")


def test_listing_rules(spark, items):
    for options in ({"page_size": 0}, {"page_size": 1001}, {"cursor_column": "a b"}, {"cursor_column": None}, {"mode": "x"}):
        with pytest.raises(ValueError):
            ListQuery(KEYSET, **{"cursor_column": "id", **options})
    with pytest.raises(MissingParameter):
        list_page(spark, ListQuery("SELECT uri FROM x_items WHERE id = :other", cursor_column="id"))
