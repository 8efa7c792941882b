"""Rows as JSON that keeps types: exact decimals, fixed timestamps, no NaN.

``encoded`` builds one projection from the schema of a DataFrame; ``row_to_json``
turns that projection into text. Nothing here needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkq.functions.common import as_column, base64_text
from sparkq.functions.intervals import interval_iso8601
from sparkq.functions.jsontext import parse

PROFILES = ("postgres", "mysql", "sqlite")
INTERVAL_FIELDS = ["months", "days", "micros"]
JSON_OPTIONS = {"ignoreNullFields": "false"}


def _written(c: Column, **options: str) -> Column:
    """A date-time as JSON writes it, without the quotes.

    ``date_format`` would take a wall clock through the session's zone, which may lack
    that hour.
    """
    text = F.to_json(F.array(c), options)
    return F.when(c.isNotNull(), F.substring(text, F.lit(3), F.length(text) - 4))


def naive_timestamp_text(c: Column | str) -> Column:
    """``2024-01-02T03:04:05.000006``: always six fraction digits, no zone."""
    return _written(
        as_column(c).cast("timestamp_ntz"), timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    )


def zoned_timestamp_text(c: Column | str) -> Column:
    """RFC 3339 in UTC with ``+00:00``; fraction digits 0, 3 or 6 as needed."""
    c = as_column(c)
    micros = F.unix_micros(c) % 1_000_000

    def digits(pattern: str) -> Column:
        return _written(c, timestampFormat="yyyy-MM-dd'T'HH:mm:ss" + pattern, timeZone="UTC")

    return F.concat(
        F.when(micros == 0, digits(""))
        .when(micros % 1000 == 0, digits(".SSS"))
        .otherwise(digits(".SSSSSS")),
        F.lit("+00:00"),
    )


def binary_struct(c: Column | str) -> Column:
    """``{"base64": "..."}``; null stays null."""
    c = as_column(c)
    return F.when(c.isNotNull(), F.struct(base64_text(c).alias("base64")))


def finite_or_null(c: Column | str) -> Column:
    """Null for NaN and the infinities, which JSON cannot hold."""
    c = as_column(c).cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def inline_json(c: Column | str) -> Column:
    """Parse JSON text so that it nests instead of being quoted again; null where it is
    no JSON. The last one of a repeated member counts."""
    return parse(c)


def _is_interval(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StructType) and data_type.names == INTERVAL_FIELDS


def encode_column(c: Column, data_type: T.DataType, profile: str = "postgres") -> Column:
    """The JSON-ready form of one column."""
    if profile not in PROFILES:
        raise ValueError(f"profile must be one of {PROFILES}, not {profile!r}")
    if isinstance(data_type, T.BooleanType):
        # A dynamically typed engine probes integers first.
        return c.cast("bigint") if profile == "sqlite" else c
    if isinstance(data_type, T.IntegralType):
        return c.cast("bigint")
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return finite_or_null(c)
    if isinstance(data_type, T.DecimalType):
        return c.cast("double") if profile == "sqlite" else c.cast("string")
    if isinstance(data_type, T.TimestampType):
        return naive_timestamp_text(c) if profile == "mysql" else zoned_timestamp_text(c)
    if isinstance(data_type, T.TimestampNTZType):
        return naive_timestamp_text(c)
    if isinstance(data_type, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(data_type, T.BinaryType):
        return binary_struct(c)
    if _is_interval(data_type):
        return F.when(c.isNotNull(), interval_iso8601(c["months"], c["days"], c["micros"]))
    if isinstance(data_type, T.ArrayType):
        return F.transform(c, lambda x: encode_column(x, data_type.elementType, profile))
    if isinstance(data_type, T.MapType):
        return F.transform_values(c, lambda _, v: encode_column(v, data_type.valueType, profile))
    if isinstance(data_type, T.StructType):
        fields = [
            encode_column(c[f.name], f.dataType, profile).alias(f.name) for f in data_type
        ]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.CharType | T.VarcharType | T.StringType | T.VariantType):
        return c
    return c.cast("string")


def encoded(df: DataFrame, profile: str = "postgres", json_columns: Iterable[str] = ()) -> DataFrame:
    """One projection with every column in its JSON-ready form.

    ``json_columns`` hold JSON text and are nested (a dynamically typed engine
    keeps them as text).
    """
    json_columns = set(json_columns)
    return df.select(
        *[
            (
                inline_json(f.name)
                if f.name in json_columns and profile != "sqlite"
                else encode_column(df[f.name], f.dataType, profile)
            ).alias(f.name)
            for f in df.schema
        ]
    )


def row_to_json(
    df: DataFrame,
    profile: str = "postgres",
    json_columns: Iterable[str] = (),
    keep: Iterable[str] = (),
    out: str = "row",
) -> DataFrame:
    """One JSON object per row, nulls written out; ``keep`` columns pass through."""
    body = encoded(df, profile, json_columns)
    names = {name: f"__keep_{name}" for name in keep}
    carried = df.select(*[F.col(k).alias(v) for k, v in names.items()], F.struct("*").alias("__r"))
    fields = [
        (
            inline_json(F.col("__r")[f.name])
            if f.name in set(json_columns) and profile != "sqlite"
            else encode_column(F.col("__r")[f.name], f.dataType, profile)
        ).alias(f.name)
        for f in df.schema
    ]
    if not names:
        return body.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias(out))
    return carried.select(
        *[F.col(v).alias(k) for k, v in names.items()],
        F.to_json(F.struct(*fields), JSON_OPTIONS).alias(out),
    )


def decode_or_null(
    df: DataFrame, types: dict[str, str], observation: Observation | None = None
) -> DataFrame:
    """Cast text columns to ``types``; what does not decode becomes null.

    With an observation, ``failed_<column>`` counts the cells lost that way.
    """
    decoded = {name: F.col(name).try_cast(kind) for name, kind in types.items()}
    if observation is not None:
        lost = [
            F.count_if(F.col(name).isNotNull() & value.isNull()).alias(f"failed_{name}")
            for name, value in decoded.items()
        ]
        df = df.observe(observation, *lost)
    return df.select(
        *[decoded.get(name, F.col(name)).alias(name) for name in df.columns]
    )


def derived_value_text(c: Column, data_type: T.DataType) -> Column:
    """A derived value at the JSON edge, where map keys and bytes are text."""
    if isinstance(data_type, T.BinaryType):
        return base64_text(c)
    if isinstance(data_type, T.MapType):
        return F.to_json(
            F.map_from_arrays(
                F.transform(F.map_keys(c), lambda k: k.cast("string")), F.map_values(c)
            ),
            JSON_OPTIONS,
        )
    if isinstance(data_type, (T.ArrayType, T.StructType, T.VariantType)):
        return F.to_json(c, JSON_OPTIONS)
    return c.cast("string")
