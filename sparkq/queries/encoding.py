"""Type-faithful encoding and schema derivation."""

from pyspark.sql import functions as F

from sparkq.functions.encode import (
    binary_struct,
    decode_or_null,
    derived_value_text,
    encoded,
    finite_or_null,
    naive_timestamp_text,
    row_to_json,
    zoned_timestamp_text,
)
from sparkq.functions.intervals import interval_iso8601
from sparkq.functions.schema import output_schemas, schema_rows, schema_table
from sparkq.queries.registry import query
from sparkq.sources.views import read


@query(
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts, user_id, event_type, value,
              CAST(json_extract(props, '$.k') AS BIGINT) AS k
       FROM events"""
)
def row_json_events(spark, sf_dir):
    rows = encoded(read(spark, sf_dir, "events"), "postgres", json_columns=["props"])
    return rows.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.variant_get("props", "$.k", "bigint").alias("k"),
    )


@query(
    """SELECT o_orderkey, concat('{"o_orderkey":', o_orderkey, ',"o_custkey":', o_custkey,
              ',"o_orderstatus":"', o_orderstatus, '","o_orderdate":"',
              strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f'), '","price":"',
              CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR), '","note":null}') AS row
       FROM orders"""
)
def row_json_text_orders(spark, sf_dir):
    """JSON text: exact decimals as strings, nulls written out."""
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
        F.col("o_totalprice").cast("decimal(15,2)").alias("price"),
        F.lit(None).cast("string").alias("note"),
    )
    return row_to_json(orders, keep=["o_orderkey"])


VALUES = """SELECT event_id, ts, event_type,
                   date_trunc('second', ts) AS second,
                   CASE CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 10
                     WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
                     WHEN 2 THEN CAST('-Infinity' AS DOUBLE) ELSE value END AS measure,
                   CAST(value AS DECIMAL(12,3)) AS price
            FROM {events}"""


@query(
    f"""WITH v AS ({VALUES.format(events="events")})
       SELECT event_id, CAST(price AS VARCHAR) AS price,
              strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS naive,
              strftime(second, '%Y-%m-%dT%H:%M:%S+00:00') AS zoned,
              to_base64(encode(event_type)) AS base64,
              CASE WHEN isfinite(measure) THEN measure END AS measure
       FROM v"""
)
def encode_families_events(spark, sf_dir):
    values = spark.sql(VALUES, events=read(spark, sf_dir, "events"))
    return values.select(
        "event_id",
        F.col("price").cast("string").alias("price"),
        naive_timestamp_text("ts").alias("naive"),
        zoned_timestamp_text(F.col("second").cast("timestamp")).alias("zoned"),
        binary_struct(F.encode("event_type", "UTF-8"))["base64"].alias("base64"),
        finite_or_null("measure").alias("measure"),
    )


CELLS = """SELECT event_id,
                  CASE WHEN event_id % 7 = 0 THEN concat('x', value) ELSE CAST(value AS STRING) END AS amount,
                  CASE WHEN event_id % 11 = 0 THEN event_type ELSE CAST(ts AS STRING) END AS seen
           FROM {events}"""


@query(
    """SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS amount,
              CASE WHEN event_id % 11 <> 0 THEN ts END AS seen FROM events"""
)
def undecodable_to_null(spark, sf_dir):
    cells = spark.sql(CELLS, events=read(spark, sf_dir, "events"))
    return decode_or_null(cells, {"amount": "double", "seen": "timestamp_ntz"})


FIELDS = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  (year(l_shipdate) - year(o_orderdate)) * 12 + month(l_shipdate) - month(o_orderdate) AS months,
  day(l_shipdate) - day(o_orderdate) AS days,
  CAST(floor(l_extendedprice * 100) AS BIGINT) * 10001 *
    (CASE l_linenumber % 4 WHEN 0 THEN 0 WHEN 1 THEN -1 ELSE l_linenumber END) AS micros
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey"""


@query(
    f"""WITH f AS ({FIELDS.format(lineitem="lineitem", orders="orders")}),
       a AS (SELECT *, abs(months) AS m, abs(days) AS d, abs(micros) // 1000000 AS s,
                    abs(micros) % 1000000 AS u FROM f)
       SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN months = 0 AND days = 0 AND micros = 0 THEN 'PT0S' ELSE concat(
           CASE WHEN months <= 0 AND days <= 0 AND micros <= 0 THEN '-' ELSE '' END, 'P',
           CASE WHEN m // 12 <> 0 THEN concat(m // 12, 'Y') ELSE '' END,
           CASE WHEN m % 12 <> 0 THEN concat(m % 12, 'M') ELSE '' END,
           CASE WHEN d <> 0 THEN concat(d, 'D') ELSE '' END,
           CASE WHEN micros <> 0 THEN concat('T',
             CASE WHEN s // 3600 <> 0 THEN concat(s // 3600, 'H') ELSE '' END,
             CASE WHEN (s // 60) % 60 <> 0 THEN concat((s // 60) % 60, 'M') ELSE '' END,
             CASE WHEN u <> 0 THEN concat(s % 60, '.', rtrim(lpad(CAST(u AS VARCHAR), 6, '0'), '0'), 'S')
                  WHEN s % 60 <> 0 THEN concat(s % 60, 'S') ELSE '' END) ELSE '' END) END AS iso
       FROM a"""
)
def interval_iso_lineitem(spark, sf_dir):
    fields = spark.sql(
        FIELDS, lineitem=read(spark, sf_dir, "lineitem"), orders=read(spark, sf_dir, "orders")
    )
    return fields.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        interval_iso8601("months", "days", "micros").alias("iso"),
    )


def _profile_oracle(table: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {i} AS position, '{c}' AS \"column\", '{t}' AS type_name, "
        f"count(*) AS n_rows, count(*) - count({c}) AS n_null FROM {table}"
        for i, (c, t) in enumerate(columns)
    )


@query(
    " UNION ALL ".join(
        [
            _profile_oracle(
                "customer",
                [("c_custkey", "int8"), ("c_name", "text"), ("c_nationkey", "int4"),
                 ("c_acctbal", "float8"), ("c_mktsegment", "text")],
            ),
            _profile_oracle(
                "events",
                [("event_id", "int8"), ("ts", "timestamp"), ("user_id", "int8"),
                 ("event_type", "text"), ("value", "float8"), ("props", "text")],
            ),
            _profile_oracle("labels", [("doc_id", "int8"), ("quality", "int4"), ("toxic", "int4")]),
        ]
    )
)
def null_profile_schema(spark, sf_dir):
    return schema_table({t: read(spark, sf_dir, t) for t in ("customer", "events", "labels")})


def _fragment_oracle(table, columns):
    return " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS param, '{t}' AS type,
                   CASE WHEN count(*) > 0 AND count(*) = count({c}) THEN '{plain}' ELSE '{open_}' END AS fragment
            FROM {table}"""
        for c, t, plain, open_ in columns
    )


_WHOLE = ('{"type": "integer"}', '{"type": ["integer", "null"]}')
_TEXT = ('{"type": "string"}', '{"type": ["string", "null"]}')
_REAL = ('{"type": "number"}', '{"type": ["number", "null"]}')
_TIME = (
    '{"type": "string", "format": "date-time"}',
    '{"type": ["string", "null"], "format": "date-time"}',
)


@query(
    " UNION ALL ".join(
        [
            _fragment_oracle(
                "orders",
                [("o_orderkey", "int8", *_WHOLE), ("o_custkey", "int8", *_WHOLE), ("o_orderstatus", "text", *_TEXT),
                 ("o_totalprice", "float8", *_REAL), ("o_orderdate", "timestamp", *_TIME),
                 ("o_orderpriority", "text", *_TEXT)],
            ),
            _fragment_oracle("pages", [("page_id", "int8", *_WHOLE), ("url", "text", *_TEXT), ("html", "text", *_TEXT)]),
            _fragment_oracle("labels", [("doc_id", "int8", *_WHOLE), ("quality", "int4", *_WHOLE), ("toxic", "int4", *_WHOLE)]),
        ]
    )
)
def schema_fragments(spark, sf_dir):
    """Input schemas as rows, with nullability measured over the data."""
    return schema_rows({t: read(spark, sf_dir, t) for t in ("orders", "pages", "labels")})


PROFILED = """SELECT event_id, ts, event_type = 'click' AS clicked, floor(value) / 4.0 AS quarter,
                     CAST(floor(value) AS DECIMAL(12,2)) AS price FROM {events}"""


def _profiled(spark, sf_dir, profile):
    rows = spark.sql(PROFILED, events=read(spark, sf_dir, "events")).select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "clicked",
        F.col("quarter").cast("double").alias("quarter"), "price",
    )
    return row_to_json(rows, profile, keep=["event_id"])


@query(
    f"""WITH v AS ({PROFILED.format(events="events")})
       SELECT event_id, concat('{{"event_id":', event_id, ',"ts":"', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'),
              '","clicked":', CAST(clicked AS VARCHAR), ',"quarter":', CAST(CAST(quarter AS DOUBLE) AS VARCHAR),
              ',"price":"', CAST(price AS VARCHAR), '"}}') AS row FROM v"""
)
def row_json_mysql(spark, sf_dir):
    """The profile whose timestamps have no zone."""
    return _profiled(spark, sf_dir, "mysql")


@query(
    f"""WITH v AS ({PROFILED.format(events="events")})
       SELECT event_id, concat('{{"event_id":', event_id, ',"clicked":', CAST(clicked AS INTEGER),
              ',"quarter":', CAST(CAST(quarter AS DOUBLE) AS VARCHAR),
              ',"price":', CAST(CAST(price AS DOUBLE) AS VARCHAR), '}}') AS row FROM v"""
)
def row_json_sqlite(spark, sf_dir):
    """The profile without booleans and exact decimals."""
    events = spark.sql(PROFILED, events=read(spark, sf_dir, "events")).drop("ts")
    rows = events.withColumn("quarter", F.col("quarter").cast("double"))
    return row_to_json(rows, "sqlite", keep=["event_id"])


_ROW = (
    '{"type": "object", "additionalProperties": false, "required": [%s], "properties": '
    '{"k": {"type": "integer"}, "v": {"type": %s}}}'
)
_OUTPUT = f"""SELECT t, n_null, CASE WHEN n_null = 0 THEN '{_ROW % ('"k", "v"', '"number"')}'
                              ELSE '{_ROW % ('"k"', '["number", "null"]')}' END AS r FROM profile"""


@query(
    f"""WITH profile AS (
         SELECT 'customer' AS t, count(*) FILTER (c_acctbal < 0) AS n_null FROM customer
         UNION ALL SELECT 'orders', 0),
       shapes AS ({_OUTPUT})
       SELECT t AS table_name, 'single' AS row_mode, r AS schema FROM shapes
       UNION ALL SELECT t, 'many', concat('{{"type": "array", "items": ', r, '}}') FROM shapes
       UNION ALL SELECT t, 'scalar', '{{"type": "integer"}}' FROM shapes
       UNION ALL SELECT t, 'affected_rows', concat('{{"type": "object", "properties": {{"rows_affected": ',
         '{{"type": "integer", "minimum": 0}}}}, "required": ["rows_affected"]}}') FROM shapes
       UNION ALL SELECT t, 'stream', concat('{{"type": "object", "additionalProperties": false, "required": ',
         '["rows", "next_cursor", "truncated"], "properties": {{"rows": {{"type": "array", "items": ', r,
         '}}, "next_cursor": {{"type": ["string", "null"]}}, "truncated": {{"type": "boolean"}}}}}}') FROM shapes
       UNION ALL SELECT t, m, NULL FROM shapes, (VALUES ('resource_contents'), ('result_sets')) AS none(m)"""
)
def output_schema_modes(spark, sf_dir):
    """Output schemas in all row modes; negative balances count as null."""
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("v")
    return output_schemas(
        {
            "customer": read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), balance),
            "orders": read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v")),
        }
    )


@query(
    """SELECT event_id, CAST(event_id * 2 AS VARCHAR) AS whole, to_base64(encode(event_type)) AS bytes,
              concat('{"', event_id, '":', user_id, ',"', event_id + 1, '":null}') AS keyed,
              concat('["', event_type, '",null]') AS listed, NULL AS missing
       FROM events"""
)
def derived_value_texts(spark, sf_dir):
    """Derived values at the edge to JSON: bytes, maps of whole numbers, lists, null."""
    derived = read(spark, sf_dir, "events").select(
        "event_id",
        (F.col("event_id") * 2).alias("whole"),
        F.col("event_type").cast("binary").alias("bytes"),
        F.create_map("event_id", "user_id", F.col("event_id") + 1, F.lit(None).cast("bigint")).alias("keyed"),
        F.array("event_type", F.lit(None)).alias("listed"),
        F.lit(None).cast("string").alias("missing"),
    )
    return derived.select(
        "event_id",
        *[derived_value_text(F.col(f.name), f.dataType).alias(f.name) for f in derived.schema.fields[1:]],
    )
