"""Conformance of relational classes: statements through ``run_query``.

Money is summed as decimals, so that sums do not depend on the order of rows.
"""

from sparkq.queries.registry import sql_query

sql_query(
    "q01_filter",
    "orders",
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
       WHERE o_orderpriority = :priority AND o_totalprice >= :min_price""",
    {"priority": "1-URGENT", "min_price": 100000},
)
sql_query(
    "q02_join_revenue",
    "customer orders lineitem",
    """SELECT c_mktsegment, o_orderpriority, count(*) AS n_lines,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) *
                       (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DOUBLE) AS revenue
       FROM customer JOIN orders ON c_custkey = o_custkey
                     JOIN lineitem ON l_orderkey = o_orderkey
       WHERE c_mktsegment = :segment
       GROUP BY c_mktsegment, o_orderpriority""",
    {"segment": "BUILDING"},
)
sql_query(
    "q03_semi_join",
    "customer orders",
    """SELECT c_custkey, c_name FROM customer
       WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > :min)""",
    {"min": 400000},
)
sql_query(
    "q03_anti_join",
    "customer orders",
    """SELECT c_custkey, c_name FROM customer
       WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > :min)""",
    {"min": 400000},
)
sql_query(
    "q04_range_join",
    "part",
    """SELECT band, count(*) AS n_parts, CAST(sum(CAST(p_retailprice AS DECIMAL(15,2))) AS DOUBLE) AS total
       FROM part JOIN (VALUES (1, NULL, :cut1), (2, :cut1, :cut2), (3, :cut2, NULL)) AS b(band, lo, hi)
         ON (lo IS NULL OR p_retailprice >= lo) AND (hi IS NULL OR p_retailprice < hi)
       GROUP BY band""",
    {"cut1": 950, "cut2": 1000},
)
sql_query(
    "q05_pricing_summary",
    "lineitem",
    """SELECT l_returnflag, l_linestatus,
              CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS sum_qty,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS sum_base,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(15,2)) *
                       (1 - CAST(l_discount AS DECIMAL(15,2)))) AS DOUBLE) AS sum_disc,
              count(*) AS n_lines, count(DISTINCT l_suppkey) AS n_suppliers
       FROM lineitem WHERE l_shipdate <= CAST(:d AS TIMESTAMP)
       GROUP BY l_returnflag, l_linestatus""",
    {"d": "2000-09-02"},
)
sql_query(
    "q06_grouping_sets",
    "lineitem",
    """SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
              CAST(sum(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS sum_qty
       FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())""",
)
sql_query(
    "q06_rollup",
    "customer nation",
    """SELECT n_name, c_mktsegment, count(*) AS n_customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       GROUP BY ROLLUP (n_name, c_mktsegment)""",
)
sql_query(
    "q06_cube",
    "orders",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n_orders
       FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
sql_query(
    "q07_window_ranking",
    "orders",
    """SELECT o_custkey, o_orderkey, o_totalprice, CAST(rn AS INT) AS rn FROM (
         SELECT o_custkey, o_orderkey, o_totalprice,
                row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
         FROM orders) AS t
       WHERE rn <= :top""",
    {"top": 3},
)
sql_query(
    "q07_window_frame",
    "orders",
    """SELECT o_custkey, o_orderkey,
              CAST(sum(CAST(o_totalprice AS DECIMAL(15,2))) OVER w AS DOUBLE) AS moving_sum,
              lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS previous
       FROM orders
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
                    ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)
sql_query(
    "q08_top_orders",
    "orders",
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT :n""",
    {"n": 25},
)
sql_query(
    "q09_set_operations",
    "customer supplier nation",
    """SELECT 'both' AS side, nationkey FROM
         (SELECT c_nationkey AS nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier) AS a
       UNION ALL
       SELECT 'customers only' AS side, nationkey FROM
         (SELECT c_nationkey AS nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier) AS b
       UNION ALL
       SELECT 'any' AS side, nationkey FROM
         (SELECT c_nationkey AS nationkey FROM customer UNION SELECT s_nationkey FROM supplier) AS c""",
)
sql_query(
    "q10_correlated_subquery",
    "lineitem part",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity
       FROM lineitem JOIN part ON p_partkey = l_partkey
       WHERE l_quantity < :share * (SELECT avg(i.l_quantity) FROM lineitem i WHERE i.l_partkey = p_partkey)
         AND p_partkey IN (SELECT l_partkey FROM lineitem GROUP BY l_partkey HAVING count(*) > :lines)""",
    {"share": 0.2, "lines": 5},
)
sql_query(
    "q11_recursive_turns",
    "conversations",
    # Each conversation from its first turn on, as far as its turns follow one another:
    # a running sum walks them all at once.
    """SELECT conv_id, turn, chars FROM
         (SELECT conv_id, turn, sum(CAST(length(text) AS BIGINT)) OVER w AS chars,
                 row_number() OVER w - 1 AS place
          FROM conversations WHERE turn >= 0 WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) AS t
       WHERE turn = place""",
    oracle="""WITH RECURSIVE walk(conv_id, turn, chars) AS (
         SELECT conv_id, turn, CAST(length(text) AS BIGINT) FROM conversations WHERE turn = 0
         UNION ALL
         SELECT c.conv_id, c.turn, walk.chars + CAST(length(c.text) AS BIGINT)
         FROM walk JOIN conversations c ON c.conv_id = walk.conv_id AND c.turn = walk.turn + 1)
       SELECT conv_id, turn, chars FROM walk""",
)
sql_query(
    "q11_recursive_regions",
    "region nation customer",
    # The recursion runs over the hierarchy (a few rows); customers join its result.
    """WITH RECURSIVE edges AS (
         SELECT concat('r', r_regionkey) AS node, CAST(NULL AS STRING) AS parent FROM region
         UNION ALL SELECT concat('n', n_nationkey), concat('r', n_regionkey) FROM nation),
       tree(node, root, depth) AS (
         SELECT node, node, 0 FROM edges WHERE parent IS NULL
         UNION ALL SELECT e.node, tree.root, tree.depth + 1 FROM tree JOIN edges e ON e.parent = tree.node),
       held AS (SELECT concat('n', c_nationkey) AS node, count(*) AS n FROM customer GROUP BY c_nationkey)
       SELECT root, depth, count(*) AS n_nodes, CAST(coalesce(sum(held.n), 0) AS BIGINT) AS n_customers
       FROM tree LEFT JOIN held ON held.node = tree.node GROUP BY root, depth""",
)
sql_query(
    "q12_string_functions",
    "documents",
    """SELECT doc_id, upper(lang) AS lang_upper, CAST(length(text) AS INT) AS n_text,
              CAST(length(replace(text, ' ', '')) AS INT) AS n_dense,
              concat(source, ':', lang) AS tag, lpad(CAST(doc_id AS VARCHAR(20)), 8, '0') AS padded,
              CAST(position(:needle IN text) AS INT) AS at
       FROM documents""",
    {"needle": "ion"},
)
sql_query(
    "q12_date_functions",
    "orders",
    """SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, count(*) AS n_orders,
              min(o_orderdate) AS first_at,
              CAST(max(date_trunc('month', o_orderdate)) AS TIMESTAMP_NTZ) AS month_start
       FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""",
    oracle="""SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, count(*) AS n_orders,
              min(o_orderdate) AS first_at,
              CAST(max(date_trunc('month', o_orderdate)) AS TIMESTAMP) AS month_start
       FROM orders GROUP BY year(o_orderdate), month(o_orderdate)""",
)
sql_query(
    "q12_math_functions",
    "lineitem",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
              round(sqrt(l_extendedprice), 3) AS root, abs(l_discount - l_tax) > :gap AS apart,
              CAST(floor(l_extendedprice / 1000) AS BIGINT) AS thousands, l_partkey % 7 AS bucket
       FROM lineitem""",
    {"gap": 0.04},
)
sql_query(
    "q12_array_functions",
    "embeddings",
    """SELECT vec_id, label, size(embedding) AS dims, array_max(embedding) AS top,
              element_at(embedding, 1) AS head,
              aggregate(transform(embedding, x -> CASE WHEN x > 0 THEN 1 ELSE 0 END), 0, (a, x) -> a + x) AS positive
       FROM embeddings""",
    oracle="""SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims, list_max(embedding) AS top,
              embedding[1] AS head,
              CAST(len(list_filter(embedding, lambda x: x > 0)) AS INTEGER) AS positive
       FROM embeddings""",
)
sql_query(
    "q12_map_functions",
    "orders",
    """SELECT o_custkey, size(m) AS n_statuses, element_at(m, :status) AS n_of_status FROM (
         SELECT o_custkey, map_from_entries(collect_list(struct(o_orderstatus, n))) AS m FROM (
           SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus) AS a
         GROUP BY o_custkey) AS b""",
    {"status": "F"},
    oracle="""SELECT o_custkey, CAST(count(DISTINCT o_orderstatus) AS INTEGER) AS n_statuses,
              nullif(count(*) FILTER (o_orderstatus = 'F'), 0) AS n_of_status
       FROM orders GROUP BY o_custkey""",
)
sql_query(
    "q12_json_functions",
    "events",
    """SELECT event_type, CAST(get_json_object(props, '$.k') AS INT) AS k, count(*) AS n
       FROM events GROUP BY 1, 2""",
    oracle="""SELECT event_type, CAST(json_extract_string(props, '$.k') AS INT) AS k, count(*) AS n
       FROM events GROUP BY 1, 2""",
)
