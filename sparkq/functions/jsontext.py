"""Strict reading of JSON text.

Spark's JSON functions read the first value of a text and leave what stands behind it,
take single quotes and NaN, or refuse an object with a repeated member. Here a text is
JSON when it is one value and nothing more; of a repeated member the last one counts.

A text is put into an array in front of its own digest. The array can only be read as
two elements, the second of which is the digest, if the text is exactly one value: to
close the array early or to add elements, a text would have to hold its own digest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkq.functions.common import as_column, bound

STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _digest(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def is_json(c: Column | str) -> Column:
    """Whether a text is one JSON value; null for null."""
    text = as_column(c)

    def check(seal: Column) -> Column:
        sealed = F.concat(F.lit("["), text, F.lit(',"'), seal, F.lit('"]'))
        return bound(
            F.from_json(sealed, "array<string>", STRICT),
            lambda read: F.coalesce((F.size(read) == 2) & (F.get(read, F.lit(1)) == seal), F.lit(False)),
        )

    return F.when(text.isNotNull(), bound(_digest(text), check))


def members(c: Column | str, names: Sequence[str] | Mapping[str, str]) -> Column:
    """A struct with members of a JSON object, null where one is missing or not of its
    type; null for a text that is not an object. Names come with their types, or are
    variants. A variant that holds an object with repeated members is missing."""
    text = as_column(c)
    kinds = names if isinstance(names, Mapping) else dict.fromkeys(names, "variant")
    fields = ", ".join(f"`{n}` {kind}" for n, kind in kinds.items())

    def read(seal: Column) -> Column:
        sealed = F.concat(F.lit("["), text, F.lit(',{"__seal":"'), seal, F.lit('"}]'))
        return bound(
            F.from_json(sealed, f"array<struct<__seal string, {fields}>>", STRICT),
            lambda both: F.when(
                (F.size(both) == 2) & (F.get(both, F.lit(1))["__seal"] == seal), F.get(both, F.lit(0))
            ),
        )

    found = F.when(text.rlike(r"^[ \t\r\n]*\{"), bound(_digest(text), read))
    return bound(found, lambda r: F.when(r.isNotNull(), F.struct(*[r[n].alias(n) for n in names])))


def _last_members(text: Column) -> Column:
    """An object whose repeated members are reduced to the last ones."""

    def reduced(read: Column) -> Column:
        names = F.map_keys(read)
        last = F.filter(
            F.map_entries(read), lambda e, i: F.array_position(F.reverse(names), e["key"]) == F.size(names) - i
        )
        return F.to_variant_object(F.map_from_entries(last))

    return bound(F.from_json(text, "map<string, variant>", STRICT), reduced)


def parse(c: Column | str) -> Column:
    """The variant of a JSON text; null where it is none.

    Repeated members of the outermost object are reduced to the last one. For objects
    further inside, Spark keeps the last one if ``spark.sql.variant.allowDuplicateKeys``
    is set; else such a text gives null.
    """
    text = as_column(c)
    return F.when(is_json(text), F.coalesce(F.try_parse_json(text), _last_members(text)))
