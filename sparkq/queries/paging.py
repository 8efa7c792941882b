"""Pages, manifests, signed cursors and listings."""

import hashlib

from pyspark.sql import functions as F

from sparkq.functions.cursors import decode_cursor, encode_cursor
from sparkq.operators.execute import ListQuery, execute, list_page
from sparkq.operators.paging import (
    StreamSpec,
    all_pages,
    keyset_page,
    offset_page,
    page_manifest,
    resource_listing,
)
from sparkq.operators.params import QuerySpec
from sparkq.queries.registry import query
from sparkq.sources.views import read, register_views

SECRET = "paging-demo"
_KEY = hashlib.sha256(SECRET.encode()).digest().ljust(64, b"\0")
_INNER = bytes(b ^ 0x36 for b in _KEY).hex()
_OUTER = bytes(b ^ 0x5C for b in _KEY).hex()


def _b64url(expr: str) -> str:
    return f"rtrim(translate(to_base64({expr}), '+/', '-_'), '=')"


_BODY = _b64url(
    """encode(concat('{"v":1,"b":"orders","p":"","k":["', strftime(o_orderdate, '%Y-%m-%d'),
       '",', o_orderkey, ']}'))"""
)
SIGNED_CTE = f"""bodies AS (SELECT o_orderkey, o_orderdate, {_BODY} AS body FROM orders),
  signed AS (SELECT o_orderkey, o_orderdate, concat('s.', body, '.', {_b64url(
      f"unhex(sha256(unhex('{_OUTER}') || unhex(sha256(unhex('{_INNER}') || encode(body)))))"
  )}) AS token FROM bodies)"""


@query(
    """SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
       WHERE o_orderdate > TIMESTAMP '1997-05-28'
          OR (o_orderdate = TIMESTAMP '1997-05-28' AND o_orderkey > 500)
       ORDER BY o_orderdate, o_orderkey LIMIT 200"""
)
def keyset_page_orders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    start = F.lit("1997-05-28").cast("timestamp_ntz")
    return keyset_page(orders, ["o_orderdate", "o_orderkey"], [start, 500], 200)


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 100 OFFSET 100")
def offset_page_parts(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    _, second = offset_page(parts, ["p_partkey"], None, 100)
    return offset_page(parts, ["p_partkey"], second, 100)[0]


_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@query(
    f"""WITH numbered AS (SELECT {', '.join(_KEYS)},
                                 row_number() OVER (ORDER BY {', '.join(_KEYS)}) - 1 AS idx FROM lineitem),
       placed AS (SELECT *, idx // 1000 AS page FROM numbered)
       SELECT page, count(*) AS n_rows,
              {', '.join(f"arg_min({k}, idx) AS first_{k}, arg_max({k}, idx) AS last_{k}" for k in _KEYS)}
       FROM placed GROUP BY page"""
)
def page_manifest_lineitem(spark, sf_dir):
    return page_manifest(read(spark, sf_dir, "lineitem"), _KEYS, 1000)


def _signed_orders(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    keyset = [F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey")]
    return orders.withColumn("token", encode_cursor("orders", keyset, SECRET))


@query(f"WITH {SIGNED_CTE} SELECT o_orderkey, token FROM signed")
def signed_cursors_orders(spark, sf_dir):
    return _signed_orders(spark, sf_dir).select("o_orderkey", "token")


@query(
    """SELECT o_orderkey, o_orderkey % 3 = 0 AS genuine,
              CASE WHEN o_orderkey % 3 = 0 THEN 'orders' END AS binding,
              CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS k_date,
              CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS k_order
       FROM orders"""
)
def verified_cursors_orders(spark, sf_dir):
    """Two of three tokens are altered: in the text signed, or cut short."""
    token = F.col("token")
    kind = F.col("o_orderkey") % 3
    handed_in = (
        F.when(kind == 0, token)
        .when(kind == 1, F.concat(F.lit("s.A"), F.substring(token, F.lit(4), F.length(token))))
        .otherwise(F.substring(token, F.lit(1), F.length(token) - 3))
    )
    decoded = _signed_orders(spark, sf_dir).withColumn("c", decode_cursor(handed_in, SECRET))
    return decoded.select(
        "o_orderkey",
        F.col("c").isNotNull().alias("genuine"),
        F.col("c.b").alias("binding"),
        F.try_variant_get(F.get("c.k", F.lit(0)), "$", "string").alias("k_date"),
        F.try_variant_get(F.get("c.k", F.lit(1)), "$", "bigint").alias("k_order"),
    )


LISTING = """SELECT page_id, CASE WHEN page_id % 10 = 9 THEN NULL ELSE url END AS uri,
                    concat('page ', page_id) AS name, length(html) AS description,
                    'text/html' AS mime_type FROM {pages}"""


@query(
    f"""WITH l AS ({LISTING.format(pages="pages")}),
       numbered AS (SELECT *, row_number() OVER (ORDER BY page_id) - 1 AS idx FROM l)
       SELECT idx // 100 AS page, uri, name, CAST(NULL AS VARCHAR) AS description, mime_type,
              CAST(page_id AS VARCHAR) AS cursor
       FROM numbered WHERE uri IS NOT NULL"""
)
def resource_listing_pages(spark, sf_dir):
    """A number in ``description`` is not text and reads as null."""
    return resource_listing(spark.sql(LISTING, pages=read(spark, sf_dir, "pages")), "page_id", 100)


ORDER_STREAM = QuerySpec(
    name="orders",
    sql="""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
           WHERE o_orderkey > :_after_o_orderkey AND o_orderstatus = :status
           ORDER BY o_orderkey LIMIT 250""",
    params=("status",),
    row_mode="stream",
)


@query(
    """SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'O'
       ORDER BY o_orderkey LIMIT 250 OFFSET 250"""
)
def stream_second_page(spark, sf_dir):
    """A stream statement resumed with the signed cursor of its first page."""
    register_views(spark, sf_dir, ["orders"])
    stream = StreamSpec("orders", ("o_orderkey",), SECRET, {"o_orderkey": -1})
    first = execute(spark, ORDER_STREAM, {"status": "O"}, stream=stream)
    second = execute(spark, ORDER_STREAM, {"status": "O"}, stream=stream, cursor=first.next_cursor)
    return second.rows


@query(
    """SELECT concat('customer://', c_custkey) AS uri, c_name AS name, CAST(NULL AS VARCHAR) AS description,
              CAST(NULL AS VARCHAR) AS mime_type
       FROM customer ORDER BY c_custkey LIMIT 40 OFFSET 40"""
)
def listing_second_page(spark, sf_dir):
    """A listing statement resumed with the cursor of its first page."""
    register_views(spark, sf_dir, ["customer"])
    listing = ListQuery(
        """SELECT c_custkey, concat('customer://', c_custkey) AS uri, c_name AS name FROM customer
           WHERE :cursor IS NULL OR c_custkey > CAST(:cursor AS BIGINT)
           ORDER BY c_custkey LIMIT :page_size""",
        cursor_column="c_custkey",
        page_size=40,
    )
    _, cursor = list_page(spark, listing)
    return list_page(spark, listing, cursor)[0]


def _paged(name, nullable):
    key = "CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id END" if nullable else "ts"

    @query(
        f"""WITH e AS (SELECT {key} AS k, event_id FROM events),
           placed AS (SELECT *, row_number() OVER (ORDER BY k NULLS FIRST, event_id) - 1 AS i,
                             count(*) OVER () // 3 + 1 AS size FROM e)
           SELECT CAST(i // size AS INTEGER) AS page, k, event_id, FALSE AS truncated,
                  max(event_id) FILTER (i % size = size - 1 OR i = (SELECT count(*) - 1 FROM e))
                    OVER (PARTITION BY i // size) AS next_event_id
           FROM placed""",
        name=name,
    )
    def run(spark, sf_dir):
        """The events page by page to the end, with the key that each page's token holds."""
        events = spark.sql(f"SELECT {key} AS k, event_id FROM {{e}}", e=read(spark, sf_dir, "events"))
        spec = StreamSpec("events", ("k", "event_id"), SECRET)
        pages = all_pages(events, spec, events.count() // 3 + 1)
        decoded = decode_cursor(F.col("next_cursor"), SECRET)
        return pages.select(
            F.col("page").cast("int").alias("page"), "k", "event_id", F.lit(False).alias("truncated"),
            F.variant_get(F.get(decoded["k"], F.lit(1)), "$", "bigint").alias("next_event_id"),
        )

    return run


_paged("paged_events", nullable=False)
_paged("paged_events_nullable", nullable=True)
