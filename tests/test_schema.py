from sparkq.functions import schema as D

PARAMS = ["tenant", "limit"]


def test_input_schema():
    got = D.input_schema(PARAMS, ["uuid", "int8"])
    assert got == {
        "type": "object", "additionalProperties": False, "required": PARAMS,
        "properties": {"tenant": {"type": "string", "format": "uuid"}, "limit": {"type": "integer"}},
    }
    assert list(got["properties"]) == PARAMS
    assert D.input_schema(PARAMS, ["uuid"]) is None
    assert D.input_schema([], [])["required"] == []


def test_fragments():
    assert D.fragment_for_name("INT2") == {"type": "integer", "minimum": -32768, "maximum": 32767}
    assert D.fragment_for_name("Numeric") == {"type": "string", "format": "decimal"}
    assert D.fragment_for_name("bytea")["contentEncoding"] == "base64"
    assert D.fragment_for_name("jsonb") == {} and D.fragment_for_name("tsvector") == {}


COLUMNS = [("id", "int8", False), ("note", "text", True), ("raw", "json", None), ("age", "int4", None)]


def test_output_schema_per_mode():
    row = D.output_schema(COLUMNS, "single")
    assert row["required"] == ["id"]
    assert row["properties"]["id"] == {"type": "integer"}
    assert row["properties"]["note"] == {"type": ["string", "null"]}
    assert row["properties"]["raw"] == {}
    assert row["properties"]["age"] == {"type": ["integer", "null"]}
    assert D.output_schema(COLUMNS, "many") == {"type": "array", "items": row}
    stream = D.output_schema(COLUMNS, "stream")
    assert stream["required"] == ["rows", "next_cursor", "truncated"]
    assert stream["properties"]["rows"]["items"] == row
    assert D.output_schema(COLUMNS, "scalar") == {"type": "integer"}
    assert D.output_schema(COLUMNS, "affected_rows")["required"] == ["rows_affected"]
    for mode in ("resource_contents", "result_sets"):
        assert D.output_schema(COLUMNS, mode) is None
    assert D.output_schema([], "many") is None


def test_measured_nullability(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, None)], "id bigint, note string, f double")
    got = D.derive_output_schema(df, "single")
    assert got["required"] == ["id"]
    assert got["properties"]["note"]["type"] == ["string", "null"]
    assert got["properties"]["f"]["type"] == ["number", "null"]
    # Nothing is proven by an empty result, but its columns are known.
    empty = D.derive_output_schema(df.limit(0), "single")
    assert empty["required"] == [] and list(empty["properties"]) == ["id", "note", "f"]


def test_null_profile(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, note string")
    assert rows(D.null_profile(df)) == [(0, "id", "int8", 2, 0), (1, "note", "text", 2, 1)]


def test_params_schema(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS b, named_struct('months', 1, 'days', 2, 'micros', 3L) AS i")
    assert D.params_schema(df)["properties"]["i"] == {"type": "string", "format": "duration"}
