"""Signed page cursors as column expressions.

A token is ``s.<base64url(json)>.<base64url(mac)>`` without padding. The MAC is
HMAC-SHA-256 over the base64 text, spelled with ``sha2`` so that whole token
columns are signed and checked on executors. The 32-byte key is the SHA-256 of
the shared secret.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkq.functions.common import as_column, bound, json_value

VERSION = 1
_BLOCK = 64


def _pads(secret: str | bytes) -> tuple[bytes, bytes]:
    raw = secret.encode() if isinstance(secret, str) else secret
    key = hashlib.sha256(raw).digest().ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def base64url(binary: Column) -> Column:
    """Base64 with the URL alphabet and no padding."""
    # Characters without a counterpart (padding, line breaks) are dropped.
    return F.translate(F.base64(binary), "+/=\r\n", "-_")


def hmac_sha256(message: Column, secret: str | bytes) -> Column:
    """Binary MAC of a text column under the key derived from ``secret``."""
    inner, outer = _pads(secret)
    first = F.unhex(F.sha2(F.concat(F.lit(inner), F.encode(message, "UTF-8")), 256))
    return F.unhex(F.sha2(F.concat(F.lit(outer), first), 256))


def encode_cursor(
    binding: Column | str, keyset: Sequence[Column], secret: str | bytes, profile: str = ""
) -> Column:
    """The token that resumes after a row with key values ``keyset``.

    ``binding`` is a column, or the binding's name as text.
    """
    name = F.lit(binding) if isinstance(binding, str) else binding
    payload = F.concat(
        F.lit(f'{{"v":{VERSION},"b":'),
        json_value(name),
        F.lit(',"p":'),
        json_value(F.lit(profile)),
        F.lit(',"k":['),
        F.concat_ws(",", *[json_value(k) for k in keyset]),
        F.lit("]}"),
    )
    body = base64url(F.encode(payload, "UTF-8"))
    return F.concat(F.lit("s."), body, F.lit("."), base64url(hmac_sha256(body, secret)))


def decode_cursor(token: Column | str, secret: str | bytes) -> Column:
    """``struct<v,b,p,k:array<variant>>``; null for anything not signed by us."""

    def checked(pieces: Column) -> Column:
        body, mac = F.get(pieces, F.lit(1)), F.get(pieces, F.lit(2))
        shaped = (F.size(pieces) == 3) & (F.get(pieces, F.lit(0)) == "s")
        genuine = shaped & (mac == base64url(hmac_sha256(body, secret)))
        pad = F.repeat(F.lit("="), (4 - F.length(body) % 4) % 4)
        raw = F.try_to_binary(F.concat(F.translate(body, "-_", "+/"), pad), F.lit("base64"))
        payload = F.from_json(
            F.decode(raw, "UTF-8"), "v int, b string, p string, k array<variant>"
        )
        return F.when(genuine, bound(payload, opened))

    def opened(payload: Column) -> Column:
        good = (payload["v"] == VERSION) & payload["b"].isNotNull() & payload["k"].isNotNull()
        fields = F.struct(
            payload["v"].alias("v"),
            payload["b"].alias("b"),
            F.coalesce(payload["p"], F.lit("")).alias("p"),
            payload["k"].alias("k"),
        )
        return F.when(good, fields)

    return bound(F.split(as_column(token), r"\."), checked)


def cursor_value_text(c: Column | str) -> Column:
    """A cursor column as text for a listing: null is the empty string."""
    c = as_column(c)
    return F.coalesce(c.cast("string"), F.lit(""))
