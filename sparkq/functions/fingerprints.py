"""Request fingerprints: equal inputs give equal keys, any change a new key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkq.functions.common import as_column, bound, json_value


_JSON_STRING = r'"(?:[^"\\]|\\.)*+"'
_JSON_FRACTION = r"(-?[0-9]+\.[0-9]+)(?![0-9.eE])"


def _kinds_kept(c: Column) -> Column:
    """JSON text whose fractions have an exponent, so that they parse as floating point
    and ``1.0`` does not become ``1``. Text inside strings is left as it is."""
    outside = F.transform(
        F.split(c, _JSON_STRING, -1), lambda t: F.regexp_replace(t, _JSON_FRACTION, "$1E0")
    )
    strings = F.regexp_extract_all(c, F.lit(_JSON_STRING), 0)
    parts = F.zip_with(outside, strings, lambda t, s: F.concat(t, F.coalesce(s, F.lit(""))))
    return F.when(c.rlike(_JSON_FRACTION), F.array_join(parts, "")).otherwise(c)


def canonical_json(c: Column | str) -> Column:
    """JSON text with sorted object keys; array order is kept.

    Numbers keep their kind, nested or not, so ``1`` and ``1.0`` stay different.
    Text that is not JSON is taken as a JSON string.
    """
    c = as_column(c)
    bare_whole = c.rlike(r"^-?(0|[1-9][0-9]{0,17})\z")
    bare_text = c.rlike(r'^"[^"\\\x00-\x1F]*"\z')
    bare_float = c.rlike(r"^\s*-?[0-9]+(\.[0-9]+([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)\s*\z")
    parsed = F.to_json(F.try_parse_json(_kinds_kept(c)))
    return (
        F.when(c.isNull(), F.lit("null"))
        .when(bare_whole | bare_text, c)
        .when(bare_float, F.trim(c).try_cast("double").cast("string"))
        .otherwise(F.coalesce(parsed, json_value(c)))
    )


def _framed(text: Column) -> Column:
    """Length and text, so that neighbouring fields cannot run into each other."""
    return bound(text, lambda t: F.concat(F.length(t).cast("string"), F.lit(":"), t))


def request_fingerprint(
    backend: Column | str,
    sql: Column | str,
    params: Column | str,
    session_vars: Column | str,
    version: Column | str,
) -> Column:
    """SHA-256 over backend, statement, parameters, session variables, version.

    ``params`` is ``array<struct<name,value>>`` in declared order with JSON text
    values; ``session_vars`` is ``map<string,string>`` in any order.
    """
    pairs = F.transform(
        as_column(params),
        lambda p: F.concat(_framed(p["name"]), _framed(canonical_json(p["value"]))),
    )
    variables = F.transform(
        F.array_sort(F.map_entries(as_column(session_vars))),
        lambda e: F.concat(_framed(e["key"]), _framed(e["value"])),
    )
    fields = [
        as_column(backend),
        as_column(sql),
        F.coalesce(F.concat_ws("", pairs), F.lit("")),
        F.coalesce(F.concat_ws("", variables), F.lit("")),
        as_column(version).cast("string"),
    ]
    return F.sha2(F.concat(F.lit("sql"), *[_framed(f) for f in fields]), 256)
