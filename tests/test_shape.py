import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparkq.operators import shape


@pytest.fixture
def three(spark):
    return spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, name string")


def test_single_many_scalar(three):
    assert shape.single(three, ["id"]).collect()[0]["id"] == 1
    assert shape.single(three.where("id > 9")).collect() == []
    assert [r["id"] for r in shape.many(three, 2, ["id"]).collect()] == [1, 2]
    assert shape.scalar(three.orderBy("id")).columns == ["id"]
    assert shape.scalar_value(three.orderBy("id")) == 1
    assert shape.scalar_value(three.where("id > 9")) is None
    # The first selected column, not the first in the alphabet.
    assert shape.scalar_value(three.orderBy("id").select("name", "id")) == "a"


def test_truncation_looks_one_past_the_cap(three):
    assert shape.is_truncated(three, 2)
    assert not shape.is_truncated(three, 3)


def test_affected_rows(spark):
    assert shape.affected_rows(spark, 7).first()[0] == 7
    assert shape.affected_rows(spark, None).first()[0] == 0


def test_first_per_key(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, n int, v string")
    assert rows(shape.first_per_key(df, ["k"], ["n"])) == [("a", 1, "y"), ("b", 5, None)]


CONTENTS = "id int, uri string, text string, blob string, mime_type string"


def test_resource_contents(spark):
    df = spark.createDataFrame(
        [
            (0, "r://readme", "# hi", None, "text/markdown"),
            (1, "r://logo", None, "AAAA", None),
            (2, None, "x", None, None),
            (3, "r://both", "x", "AAAA", None),
            (4, "r://neither", None, None, None),
        ],
        CONTENTS,
    )
    got = [r["error"] for r in shape.resource_contents(df, "id").orderBy("uri").collect()]
    assert sum(e is None for e in got) == 2
    assert any("[2] missing required 'uri'" in e for e in got if e)
    assert any("[3] has both" in e for e in got if e)
    assert any("[4] must have either" in e for e in got if e)
    good = shape.resource_contents(df.where("id < 2"), "id", strict=True)
    assert good.count() == 2
    with pytest.raises(PySparkException, match="resource_contents"):
        shape.resource_contents(df, "id", strict=True).select("text").collect()


def test_uri_that_is_not_text_is_missing(spark):
    df = spark.createDataFrame([(5, "t")], "uri int, text string")
    assert "missing" in shape.resource_contents(df).first()["error"]


def numbered(spark, n, start=0):
    return spark.range(start, start + n).select(F.col("id").alias("k"))


def test_result_sets_share_the_budget_in_order(spark):
    sets = [(numbered(spark, 4), ["k"]), (numbered(spark, 0), ["k"]), (numbered(spark, 5, 100), ["k"]), (numbered(spark, 3, 200), ["k"])]
    got = shape.result_sets(sets, 6)
    assert got.kept == (4, 2, 0)  # the empty set is dropped, the last keeps its slot
    assert got.truncated
    assert sorted(map(tuple, got.rows().select("set_no", "k").collect())) == [
        (0, 0), (0, 1), (0, 2), (0, 3), (1, 100), (1, 101),
    ]
    whole = shape.result_sets(sets, 12)
    assert whole.kept == (4, 5, 3) and not whole.truncated


def test_long_cut_uses_the_row_index(spark, monkeypatch):
    monkeypatch.setattr(shape, "LIMIT_ROWS", 10)
    got = shape.result_sets([(numbered(spark, 500), ["k"])], 321)
    assert sorted(r["k"] for r in got.rows().collect()) == list(range(321))


def test_row_count_hint(spark):
    cases = {
        "[1,2]": 2, "[]": 0, '{"rows_affected":5}': 5, '{"contents":[1]}': 1, '{"contents":[]}': 0,
        '{"a":1}': 1, "null": None, "5": None, '"x"': None, "": None, "x": None,
        '{"rows_affected":"x"}': 1, '{"rows_affected":"x","contents":[1,2]}': 2,
        '{"rows_affected":-1}': None, '{"contents":7}': 1,
    }
    df = spark.createDataFrame([(k,) for k in cases], "p string")
    got = {r[0]: r[1] for r in df.select("p", shape.row_count_hint("p")).collect()}
    assert got == cases
