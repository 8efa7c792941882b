import json
import math
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Observation

from sparkq.functions import encode as E
from sparkq.functions.fingerprints import canonical_json, request_fingerprint


@pytest.fixture
def one(spark):
    long_bytes = bytes(range(200))
    return spark.createDataFrame(
        [
            (
                True, 5, 7, 1.5, math.nan, -math.inf, Decimal("12345678901234567890.10"),
                datetime(2024, 1, 2, 3, 4, 5, 6000), datetime(2024, 1, 2, 3, 4, 5), date(2024, 2, 3),
                long_bytes, (14, 3, 14706000000), [1.0, math.inf], '{"b":[1,{"c":null}],"a":"x"}', None,
            )
        ],
        """flag boolean, small smallint, big bigint, f double, nan double, inf float, price decimal(38,2),
           naive timestamp_ntz, zoned timestamp, day date, bytes binary,
           span struct<months:int,days:int,micros:bigint>, list array<double>, doc string, gone string""",
    )


def as_json(df, profile):
    return json.loads(E.row_to_json(df, profile, json_columns=["doc"]).first()["row"])


def test_postgres_row(one):
    row = as_json(one, "postgres")
    assert row["flag"] is True and row["small"] == 5 and row["big"] == 7 and row["f"] == 1.5
    assert row["nan"] is None and row["inf"] is None
    assert row["price"] == "12345678901234567890.10"
    assert row["naive"] == "2024-01-02T03:04:05.006000"
    assert row["zoned"] == "2024-01-02T03:04:05+00:00"
    assert row["day"] == "2024-02-03"
    import base64

    assert row["bytes"] == {"base64": base64.b64encode(bytes(range(200))).decode()}
    assert row["span"] == "P1Y2M3DT4H5M6S"
    assert row["list"] == [1.0, None]
    assert row["doc"] == {"a": "x", "b": [1, {"c": None}]}
    assert "gone" in row and row["gone"] is None
    assert list(row) == one.columns


def test_other_profiles(one):
    mysql = as_json(one, "mysql")
    assert mysql["zoned"] == "2024-01-02T03:04:05.000000" and mysql["flag"] is True
    sqlite = as_json(one.drop("price"), "sqlite")
    assert sqlite["flag"] == 1 and isinstance(sqlite["doc"], str)
    with pytest.raises(ValueError):
        E.encoded(one, "oracle")


def test_zoned_fraction_digits_and_session_zone(spark):
    df = spark.sql(
        """SELECT timestamp_micros(1704164645000000) AS a, timestamp_micros(1704164645120000) AS b,
                  timestamp_micros(1704164645000001) AS c, CAST(NULL AS timestamp) AS n"""
    )
    exprs = [E.zoned_timestamp_text(c).alias(c) for c in df.columns]
    want = ["2024-01-02T03:04:05+00:00", "2024-01-02T03:04:05.120+00:00", "2024-01-02T03:04:05.000001+00:00", None]
    assert list(df.select(*exprs).first()) == want
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert list(df.select(*exprs).first()) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_undecodable_cells_are_null_and_counted(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "never"), (None, "2024-01-02")], "n string, d string")
    lost = Observation()
    out = E.decode_or_null(df, {"n": "int", "d": "date"}, lost)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [(1, date(2024, 1, 1)), (None, None), (None, date(2024, 1, 2))], key=repr
    )
    assert lost.get == {"failed_n": 1, "failed_d": 1}


def test_derived_values_at_the_json_edge(spark):
    df = spark.sql("SELECT map(1, 'x') AS m, CAST('ab' AS binary) AS b, array(1, 2) AS a, 5 AS i")
    got = df.select(*[E.derived_value_text(df[f.name], f.dataType).alias(f.name) for f in df.schema]).first()
    assert list(got) == ['{"1":"x"}', "YWI=", "[1,2]", "5"]


FIELDS = "backend string, sql string, params array<struct<name:string,value:string>>, vars map<string,string>, version bigint"
BASE = ("b", "SELECT 1", [("a", '{"x":1,"y":[1,2]}'), ("b", "1")], {"k": "v", "l": "w"}, 0)


def prints(spark, *requests):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(requests)], "i int, " + FIELDS)
    out = df.select("i", request_fingerprint("backend", "sql", "params", "vars", "version").alias("f"))
    return [r["f"] for r in out.orderBy("i").collect()]


def test_equal_requests_have_equal_fingerprints(spark):
    other_order = ("b", "SELECT 1", [("a", '{"y":[1,2], "x":1}'), ("b", "1")], {"l": "w", "k": "v"}, 0)
    assert len(set(prints(spark, BASE, other_order, BASE))) == 1


def test_any_difference_changes_the_fingerprint(spark):
    variants = [
        ("c", *BASE[1:]),
        ("b", "SELECT 2", *BASE[2:]),
        ("b", "SELECT 1", [("a", '{"x":1,"y":[2,1]}'), ("b", "1")], *BASE[3:]),
        ("b", "SELECT 1", [("b", "1"), ("a", '{"x":1,"y":[1,2]}')], *BASE[3:]),
        ("b", "SELECT 1", [("a", '{"x":1,"y":[1,2]}'), ("b", '"1"')], *BASE[3:]),
        ("b", "SELECT 1", [("a", '{"x":1,"y":[1,2]}'), ("b", "1.0")], *BASE[3:]),
        ("b", "SELECT 1", [("a", '{"x":1,"y":[1,2]}'), ("b", "null")], *BASE[3:]),
        (*BASE[:3], {"k": "w", "l": "v"}, 0),
        (*BASE[:3], {}, 0),
        (*BASE[:4], 1),
        ("bSELECT", " 1", *BASE[2:]),
    ]
    got = prints(spark, BASE, *variants)
    assert len(set(got)) == len(got)


def test_canonical_json(spark):
    df = spark.createDataFrame([('{"b":1,"a":2}',), ("1",), ("1.0",), ("1e3",), ("plain",), (None,)], "v string")
    assert [r[0] for r in df.select(canonical_json("v")).collect()] == [
        '{"a":2,"b":1}', "1", "1.0", "1000.0", '"plain"', "null",
    ]
