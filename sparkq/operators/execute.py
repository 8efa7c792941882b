"""A named query from arguments to its response shape, page by page where asked."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkq.functions.common import require_identifier
from sparkq.functions.cursors import cursor_value_text, decode_cursor, encode_cursor
from sparkq.functions.encode import row_to_json
from sparkq.operators.paging import (
    MAX_PAGE_SIZE,
    CursorError,
    StreamSpec,
    check_cursor,
    parse_offset,
    resource_columns,
)
from sparkq.operators.params import QuerySpec, run_query
from sparkq.operators.shape import resource_contents, scalar, single
from sparkq.plans.staging import POSITION, settle


@dataclass(frozen=True)
class Response:
    """Rows of a response with its flag and cursor.

    A capped response, and one of a stream, is run once when first read: the rows up
    to one past the cap are written, and rows, ``truncated`` and ``next_cursor`` are
    read off them. Without a cap the rows stay lazy.
    """

    spec: QuerySpec
    all_rows: DataFrame
    stream: StreamSpec | None = None

    @cached_property
    def page(self) -> DataFrame:
        cap = self.spec.max_rows
        return settle(self.all_rows, None if cap is None else cap + 1)

    @cached_property
    def _capped(self) -> DataFrame:
        cap = self.spec.max_rows
        return self.page if cap is None else self.page.where(F.col(POSITION) < cap)

    @cached_property
    def rows(self) -> DataFrame:
        mode = self.spec.row_mode
        if mode == "single":
            return single(self.all_rows)
        if mode == "scalar":
            return scalar(self.all_rows)
        rows = self.all_rows
        if self.stream is not None or self.spec.max_rows is not None:
            rows = self._capped.orderBy(POSITION).drop(POSITION)
        return resource_contents(rows, strict=True) if mode == "resource_contents" else rows

    @cached_property
    def truncated(self) -> bool:
        return self.spec.max_rows is not None and self.page.count() > self.spec.max_rows

    @cached_property
    def next_cursor(self) -> str | None:
        """Token behind the last row in the statement's own order; None when empty."""
        if self.stream is None or any(c not in self.all_rows.columns for c in self.stream.cursor_columns):
            return None
        key = [F.col(c) for c in self.stream.cursor_columns]
        token = encode_cursor(self.stream.binding, key, self.stream.signing_key)
        last = self._capped.orderBy(F.desc(POSITION)).limit(1).select(token.alias("t")).first()
        return last["t"] if last else None

    def json(self, profile: str = "postgres") -> DataFrame:
        """One JSON object per row."""
        return row_to_json(self.rows, profile)


def execute(
    spark: SparkSession,
    spec: QuerySpec,
    args: Mapping[str, Any] | None = None,
    *,
    stream: StreamSpec | None = None,
    cursor: str | None = None,
    idempotency: tuple[str, str] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> Response:
    """Run a read query and shape its rows as ``spec.row_mode`` says.

    In stream mode the statement reads ``:_after_<column>`` markers: the values
    of the cursor, else of ``stream.initial``, else null.
    """
    if spec.row_mode in ("affected_rows", "result_sets"):
        raise ValueError(f"{spec.row_mode}: use the write sinks, a transaction group or result_sets")
    after = None
    if spec.row_mode == "stream":
        if stream is None:
            raise ValueError("stream mode needs a StreamSpec")
        after = after_values(spark, stream, cursor)
    rows = run_query(spark, spec, args, after=after, idempotency=idempotency, views=views)
    return Response(spec, rows, stream if spec.row_mode == "stream" else None)


def after_values(spark: SparkSession, stream: StreamSpec, cursor: Any) -> dict[str, Any]:
    """Values of the ``_after_<column>`` markers for the next page."""
    if cursor is not None and not isinstance(cursor, str):
        raise CursorError("the cursor must be a text token (or null)")
    if not cursor:
        return {c: stream.initial.get(c) for c in stream.cursor_columns}
    token = decode_cursor(F.lit(cursor), stream.signing_key)
    decoded = spark.range(1).select(token.alias("c")).select("c.b", "c.k").first()
    check_cursor(stream, decoded["b"], len(decoded["k"] or ()))
    values = [None if v is None else v.toPython() for v in decoded["k"]]
    return dict(zip(stream.cursor_columns, values))


@dataclass(frozen=True)
class ListQuery:
    """A listing statement over ``:cursor`` and ``:page_size``."""

    sql: str
    mode: str = "keyset"
    cursor_column: str | None = None
    page_size: int = 100

    def __post_init__(self) -> None:
        if self.mode not in ("keyset", "offset"):
            raise ValueError(f"unknown listing mode {self.mode!r}")
        if not 1 <= self.page_size <= MAX_PAGE_SIZE:
            raise ValueError(f"page_size must lie between 1 and {MAX_PAGE_SIZE}, not {self.page_size}")
        if self.mode == "keyset":
            if not self.cursor_column:
                raise ValueError("a keyset listing needs a cursor column")
            require_identifier(self.cursor_column)


def list_page(
    spark: SparkSession, listing: ListQuery, cursor: str | None = None
) -> tuple[DataFrame, str | None]:
    """One page of resources and the cursor of the next; None after a short page.

    Keyset: the cursor column of the last row that has a ``uri``. Offset: the
    rows listed so far.
    """
    offset = parse_offset(cursor) if listing.mode == "offset" else None
    spec = QuerySpec(name="listing", sql=listing.sql, params=("cursor", "page_size"))
    bound = {"cursor": cursor if offset is None else offset, "page_size": listing.page_size}
    page = settle(run_query(spark, spec, bound))
    usable = page.where(F.col("uri").isNotNull())
    rows = usable.orderBy(POSITION).select(*resource_columns(page))
    n = page.count()
    if n < listing.page_size:
        return rows, None
    if offset is not None:
        return rows, str(offset + n)
    last = usable.orderBy(F.desc(POSITION)).limit(1)
    row = last.select(cursor_value_text(listing.cursor_column).alias("c")).first()
    return rows, row["c"] if row else None
