"""JSON Schema fragments from Spark types and from measured nullability."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkq.functions.encode import INTERVAL_FIELDS

# Database type name -> JSON Schema fragment.
FRAGMENTS: dict[str, dict] = {
    "bool": {"type": "boolean"},
    "int2": {"type": "integer", "minimum": -32768, "maximum": 32767},
    "smallint": {"type": "integer", "minimum": -32768, "maximum": 32767},
    "int4": {"type": "integer"},
    "integer": {"type": "integer"},
    "int": {"type": "integer"},
    "int8": {"type": "integer"},
    "bigint": {"type": "integer"},
    "float4": {"type": "number"},
    "real": {"type": "number"},
    "float8": {"type": "number"},
    "double precision": {"type": "number"},
    "double": {"type": "number"},
    "numeric": {"type": "string", "format": "decimal"},
    "decimal": {"type": "string", "format": "decimal"},
    "text": {"type": "string"},
    "varchar": {"type": "string"},
    "char": {"type": "string"},
    "bpchar": {"type": "string"},
    "name": {"type": "string"},
    "citext": {"type": "string"},
    "date": {"type": "string", "format": "date"},
    "time": {"type": "string", "format": "time"},
    "timetz": {"type": "string", "format": "time"},
    "timestamp": {"type": "string", "format": "date-time"},
    "timestamptz": {"type": "string", "format": "date-time"},
    "interval": {"type": "string", "format": "duration"},
    "uuid": {"type": "string", "format": "uuid"},
    "bytea": {"type": "string", "contentEncoding": "base64"},
}

# What stands around a row, or its first value, in each row mode.
ROW, VALUE = "<row>", "<value>"
WRAPPERS: dict[str, object] = {
    "single": ROW,
    "many": {"type": "array", "items": ROW},
    "scalar": VALUE,
    "affected_rows": {
        "type": "object",
        "properties": {"rows_affected": {"type": "integer", "minimum": 0}},
        "required": ["rows_affected"],
    },
    "stream": {
        "type": "object",
        "additionalProperties": False,
        "required": ["rows", "next_cursor", "truncated"],
        "properties": {
            "rows": {"type": "array", "items": ROW},
            "next_cursor": {"type": ["string", "null"]},
            "truncated": {"type": "boolean"},
        },
    },
}
NO_SCHEMA_MODES = ("resource_contents", "result_sets")


def fragment_for_name(type_name: str) -> dict:
    """Fragment for a database type name in any case; unknown names are open."""
    return dict(FRAGMENTS.get(type_name.lower(), {}))


def type_name(data_type: T.DataType) -> str:
    """The database type name that a Spark type corresponds to."""
    if isinstance(data_type, T.StructType) and data_type.names == INTERVAL_FIELDS:
        return "interval"
    names = {
        T.BooleanType: "bool",
        T.ByteType: "int2",
        T.ShortType: "int2",
        T.IntegerType: "int4",
        T.LongType: "int8",
        T.FloatType: "float4",
        T.DoubleType: "float8",
        T.DecimalType: "numeric",
        T.DateType: "date",
        T.TimestampType: "timestamptz",
        T.TimestampNTZType: "timestamp",
        T.BinaryType: "bytea",
        T.VariantType: "json",
    }
    if isinstance(data_type, T.StringType):
        return "text"
    return names.get(type(data_type), "unknown")


def input_schema(names: list[str], type_names: list[str]) -> dict | None:
    """Object schema for parameters, all required; None when lengths differ."""
    if len(names) != len(type_names):
        return None
    return {
        "type": "object",
        "additionalProperties": False,
        "required": list(names),
        "properties": {n: fragment_for_name(t) for n, t in zip(names, type_names)},
    }


def params_schema(params: DataFrame) -> dict:
    """Input schema of a parameter table."""
    fields = params.schema.fields
    return input_schema([f.name for f in fields], [type_name(f.dataType) for f in fields])


def nullable(fragment: dict, known_nullable: bool | None) -> dict:
    """Allow null unless the column is proven to hold none."""
    if known_nullable is False or not isinstance(fragment.get("type"), str):
        return fragment
    return {**fragment, "type": [fragment["type"], "null"]}


def output_schema(
    columns: list[tuple[str, str, bool | None]], row_mode: str = "many"
) -> dict | None:
    """Schema of a result with ``(name, type name, nullable or None)`` columns."""
    if not columns or row_mode in NO_SCHEMA_MODES:
        return None
    if row_mode not in WRAPPERS:
        raise ValueError(f"unknown row mode {row_mode!r}")
    fragments = {n: nullable(fragment_for_name(t), maybe) for n, t, maybe in columns}
    row = {
        "type": "object",
        "additionalProperties": False,
        "required": [n for n, _, maybe in columns if maybe is False],
        "properties": fragments,
    }
    return _filled(WRAPPERS[row_mode], {ROW: row, VALUE: fragments[columns[0][0]]})


def _filled(shape: object, holes: dict[str, dict]) -> object:
    if isinstance(shape, str):
        return holes.get(shape, shape)
    if isinstance(shape, dict):
        return {k: _filled(v, holes) for k, v in shape.items()}
    return [_filled(v, holes) for v in shape] if isinstance(shape, list) else shape


def output_schemas(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, row_mode, schema)``: the output schema of every table in every row
    mode as JSON text, null where a mode has none. Nullability is measured over the data,
    one aggregation a table."""
    rows = []
    for name, df in tables.items():
        measured = {r["position"]: r["n_null"] > 0 or r["n_rows"] == 0 for r in null_profile(df).collect()}
        columns = [(f.name, type_name(f.dataType), measured[i]) for i, f in enumerate(df.schema)]
        for mode in (*WRAPPERS, *NO_SCHEMA_MODES):
            found = output_schema(columns, mode)
            rows.append((name, mode, None if found is None else json.dumps(found)))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, row_mode string, schema string")


def null_profile(df: DataFrame) -> DataFrame:
    """``(position, column, type_name, n_rows, n_null)``: one aggregation for all columns."""
    counted = df.agg(
        F.count("*").alias("__n"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__c{i}") for i, c in enumerate(df.columns)],
    )
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(type_name(f.dataType)).alias("type_name"),
            F.col("__n").alias("n_rows"),
            F.col(f"__c{i}").alias("n_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counted.select(F.inline(F.array(*rows)))


def derive_output_schema(df: DataFrame, row_mode: str = "many") -> dict | None:
    """Output schema whose "required" list is measured over the data."""
    measured = {r["position"]: r["n_null"] > 0 or r["n_rows"] == 0 for r in null_profile(df).collect()}
    columns = [
        (f.name, type_name(f.dataType), measured[i]) for i, f in enumerate(df.schema)
    ]
    return output_schema(columns, row_mode)


def schema_table(tables: dict[str, DataFrame]) -> DataFrame:
    """Null profiles of several tables, tagged with the table name."""
    parts = [
        null_profile(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def schema_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, param, type, fragment)``: one row per column of every table.

    ``type`` is the database type name, ``fragment`` the JSON Schema text; it allows
    null where the data hold a null, or no row at all.
    """
    parts = []
    for name, df in tables.items():
        fragments = [fragment_for_name(type_name(f.dataType)) for f in df.schema]

        def texts(known_nullable: bool, fragments=fragments):
            return F.array(*[F.lit(json.dumps(nullable(f, known_nullable))) for f in fragments])

        holds_null = (F.col("n_null") > 0) | (F.col("n_rows") == 0)
        text = F.when(holds_null, F.get(texts(True), F.col("position"))).otherwise(
            F.get(texts(False), F.col("position"))
        )
        parts.append(
            null_profile(df).select(
                F.lit(name).alias("table_name"),
                F.col("column").alias("param"),
                F.col("type_name").alias("type"),
                text.alias("fragment"),
            )
        )
    return reduce(DataFrame.unionByName, parts)
