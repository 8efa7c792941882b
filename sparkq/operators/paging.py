"""Pages of a table: one page at a time by key, or all pages in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkq.functions.common import div, require_column_name, require_identifier
from sparkq.functions.cursors import cursor_value_text, decode_cursor, encode_cursor
from sparkq.plans.ordered import row_index
from sparkq.plans.sizing import broadcast_if_small
from sparkq.plans.staging import POSITION, settle

MAX_PAGE_SIZE = 1000


class CursorError(ValueError):
    """A cursor that this listing did not hand out."""


@dataclass(frozen=True)
class StreamSpec:
    """Keyset paging of one binding.

    ``initial`` gives key values before the first page; without them the first
    page has no lower bound.
    """

    binding: str
    cursor_columns: tuple[str, ...]
    signing_key: str
    initial: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.cursor_columns:
            raise ValueError("cursor_columns must not be empty")
        for name in self.cursor_columns:
            require_column_name(name)
        unknown = [k for k in self.initial if k not in self.cursor_columns]
        if unknown:
            raise ValueError(f"initial names that are not cursor columns: {unknown}")


def after_predicate(columns: Sequence[str], values: Sequence[Any]) -> Column:
    """Rows strictly after ``values`` in the order of ``columns``.

    Written as plain comparisons so that it can be pushed into the scan. The
    leading column is also bounded on its own, which lets files be skipped. Nulls
    come first, as in an ascending sort.
    """

    def same(column: str, value: Any) -> Column:
        return F.col(column).isNull() if value is None else F.col(column) == F.lit(value)

    def behind(column: str, value: Any) -> Column:
        return F.col(column).isNotNull() if value is None else F.col(column) > F.lit(value)

    alternatives = []
    for i, column in enumerate(columns):
        equal = [same(c, v) for c, v in zip(columns[:i], values[:i])]
        alternatives.append(reduce(lambda a, b: a & b, [*equal, behind(column, values[i])]))
    later = reduce(lambda a, b: a | b, alternatives)
    if len(columns) == 1 or values[0] is None:
        return later
    return (F.col(columns[0]) >= F.lit(values[0])) & later


def keyset_page(
    df: DataFrame, columns: Sequence[str], after: Sequence[Any] | None, page_size: int
) -> DataFrame:
    """The next ``page_size`` rows after the key ``after`` (None: from the start).

    Runs as a filtered scan and a top-n per task, without a full sort.
    """
    for name in columns:
        require_column_name(name)
    if after is not None:
        if len(after) != len(columns):
            raise CursorError(f"{len(after)} key values for {len(columns)} cursor columns")
        df = df.where(after_predicate(columns, after))
    return df.orderBy(*columns).limit(page_size)


def check_cursor(spec: StreamSpec, binding: str | None, n_keys: int) -> None:
    """Refuse a decoded cursor that is not one of this stream's."""
    if binding is None:
        raise CursorError("this cursor is malformed, altered or signed with another key")
    if binding != spec.binding:
        raise CursorError(f"this cursor belongs to `{binding}`, not to `{spec.binding}`")
    if n_keys != len(spec.cursor_columns):
        raise CursorError(
            f"this cursor holds {n_keys} key values where {len(spec.cursor_columns)} are needed"
        )


def open_cursor(spec: StreamSpec, df: DataFrame, token: Any) -> list[Any] | None:
    """Key values to resume after: from the token, else from ``initial``.

    Values come back in the types of the cursor columns.
    """
    if token is not None and not isinstance(token, str):
        raise CursorError("the cursor must be a text token (or null)")
    if not token:
        # As in the token case, missing initial values leave the page unbounded.
        values = [spec.initial.get(c) for c in spec.cursor_columns]
        return None if any(v is None for v in values) else values
    one = df.sparkSession.range(1).select(decode_cursor(F.lit(token), spec.signing_key).alias("c"))
    kinds = dict(df.dtypes)
    decoded = one.select(
        "c.b",
        F.size("c.k").alias("n"),
        *[
            F.variant_get(F.get("c.k", F.lit(i)), "$", "string").cast(kinds[c]).alias(f"k{i}")
            for i, c in enumerate(spec.cursor_columns)
        ],
    ).first()
    check_cursor(spec, decoded["b"], decoded["n"])
    return [decoded[f"k{i}"] for i in range(len(spec.cursor_columns))]


def next_cursor(spec: StreamSpec, page: DataFrame) -> str | None:
    """Token after the last row of ``page``.

    None when the page is empty or lacks a cursor column. A short page still
    gets a token; only an empty one ends the stream.
    """
    if any(c not in page.columns for c in spec.cursor_columns):
        return None
    key = F.struct(*[F.col(c) for c in spec.cursor_columns])
    last = page.agg(F.max(key).alias("k")).where("k IS NOT NULL")
    token = encode_cursor(
        spec.binding, [F.col("k")[c] for c in spec.cursor_columns], spec.signing_key
    )
    row = last.select(token.alias("t")).first()
    return None if row is None else row["t"]


@dataclass(frozen=True)
class StreamPage:
    rows: DataFrame
    truncated: bool
    next_cursor: str | None


def stream_page(
    spec: StreamSpec, df: DataFrame, token: str | None, page_size: int, max_rows: int | None = None
) -> StreamPage:
    """One page in stream shape: rows, truncation flag, token of the next page."""
    after = open_cursor(spec, df, token)
    cap = page_size if max_rows is None else min(max_rows, page_size)
    # The page is run once; rows, flag and token are read off what was written.
    page = settle(keyset_page(df, spec.cursor_columns, after, page_size), cap + 1)
    rows = page.where(F.col(POSITION) < cap).orderBy(POSITION).drop(POSITION)
    return StreamPage(rows, page.count() > cap, next_cursor(spec, rows))


def parse_offset(cursor: str | None) -> int:
    """A text cursor of offset mode; the first page is 0."""
    if cursor is None:
        return 0
    if not (cursor.isascii() and cursor.isdigit()) or int(cursor) >= 2**64:
        raise CursorError(f"an offset cursor is a whole number from 0, not {cursor!r}")
    return int(cursor)


def offset_page(
    df: DataFrame, order: Sequence[str], cursor: str | None, page_size: int
) -> tuple[DataFrame, str | None]:
    """One page by running offset, and the cursor of the next page: the rows listed so
    far, or None after a short page.

    Reads and sorts everything before the page; for small listings only. Large
    ones use ``keyset_page`` or ``page_manifest``.
    """
    start = parse_offset(cursor)
    page = settle(df.orderBy(*order).offset(start), page_size)
    n = page.count()
    return page.orderBy(POSITION).drop(POSITION), str(start + n) if n >= page_size else None


def page_manifest(
    df: DataFrame, columns: Sequence[str], page_size: int, spec: StreamSpec | None = None
) -> DataFrame:
    """All pages of a table in one job: ``page, n_rows, first_<c>, last_<c>``.

    Only key columns travel. Keys must be unique. With a ``spec`` there is also
    ``next_cursor``, null on the last page.
    """
    for name in columns:
        require_column_name(name)
    indexed = row_index(df.select(*columns), columns, "__idx")
    key = F.struct(*[F.col(c) for c in columns])
    # A page spans one or two ranges, so the partial aggregation removes nearly
    # everything before the shuffle.
    pages = indexed.groupBy(div(F.col("__idx"), page_size).alias("page")).agg(
        F.count("*").alias("n_rows"), F.min(key).alias("__a"), F.max(key).alias("__z")
    )
    out = [
        F.col("page"),
        F.col("n_rows"),
        *[F.col("__a")[c].alias(f"first_{c}") for c in columns],
        *[F.col("__z")[c].alias(f"last_{c}") for c in columns],
    ]
    if spec is not None:
        last = indexed.agg(F.max(div(F.col("__idx"), page_size)))
        pages = pages.withColumn("__last", last.scalar())
        token = encode_cursor(
            spec.binding, [F.col("__z")[c] for c in spec.cursor_columns], spec.signing_key
        )
        out.append(F.when(F.col("page") < F.col("__last"), token).alias("next_cursor"))
    return pages.select(*out)


def all_pages(df: DataFrame, spec: StreamSpec, page_size: int) -> DataFrame:
    """Every row with its ``page`` and the ``next_cursor`` of that page: what paging to
    the end returns, in one job.

    Rows are numbered in key order over range partitions, so a page of any size is spread
    like any other rows; of a page only its last key meets in one place. Keys must be
    unique; nulls in them come first. The last page has a cursor as well, as an empty
    page ends a stream.
    """
    if page_size < 1:
        raise ValueError(f"page_size must be at least 1, not {page_size}")
    placed = row_index(df, spec.cursor_columns, "__idx").withColumn("__page", div(F.col("__idx"), page_size))
    key = F.struct(*[F.col(c) for c in spec.cursor_columns])
    # Partial aggregation leaves a row for each page and range.
    last = placed.groupBy(F.col("__page").alias("__of")).agg(F.max(key).alias("__z"))
    token = encode_cursor(spec.binding, [F.col("__z")[c] for c in spec.cursor_columns], spec.signing_key)
    tokens = broadcast_if_small(last.select("__of", token.alias("__token")))
    return placed.join(tokens, F.col("__page") == F.col("__of")).select(
        F.col("__page").alias("page"), *df.columns, F.col("__token").alias("next_cursor")
    )


def resource_columns(df: DataFrame) -> list[Column]:
    """``uri, name, description, mime_type`` of a listing; what is not text is null."""
    kinds = dict(df.dtypes)
    return [
        (F.col(c) if kinds.get(c) == "string" else F.lit(None).cast("string")).alias(c)
        for c in ("uri", "name", "description", "mime_type")
    ]


def _check_page_size(page_size: int) -> None:
    if not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must lie between 1 and {MAX_PAGE_SIZE}, not {page_size}")


def resource_page(
    df: DataFrame, cursor_column: str, after: Any = None, page_size: int = 100
) -> tuple[DataFrame, str | None]:
    """One page of a resource listing and its next cursor.

    Rows without a ``uri`` are left out but count for the page. The cursor is
    null when the page is short, else that of the last row with a ``uri``.
    """
    _check_page_size(page_size)
    require_identifier(cursor_column)
    page = settle(keyset_page(df, [cursor_column], None if after is None else [after], page_size))
    usable = F.col("uri").isNotNull()
    stats = page.agg(
        F.count("*").alias("n"), F.max(F.when(usable, F.col(cursor_column))).alias("last")
    ).select("n", "last", cursor_value_text("last").alias("token")).first()
    full = stats["n"] >= page_size and stats["last"] is not None
    rows = page.where(usable).orderBy(POSITION).select(*resource_columns(page))
    return rows, stats["token"] if full else None


def resource_listing(df: DataFrame, cursor_column: str, page_size: int = 100) -> DataFrame:
    """The whole listing with its page numbers: what paging to the end returns."""
    _check_page_size(page_size)
    require_identifier(cursor_column)
    # Only what the listing shows is sorted and written.
    shown = df.select(*resource_columns(df), F.col(cursor_column).alias("__cursor"))
    return (
        row_index(shown, ["__cursor"], "__idx")
        .where(F.col("uri").isNotNull())
        .select(
            div(F.col("__idx"), page_size).alias("page"),
            *[F.col(c) for c in ("uri", "name", "description", "mime_type")],
            cursor_value_text("__cursor").alias("cursor"),
        )
    )
