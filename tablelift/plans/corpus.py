"""Query texts that are exported as they are: one text for Spark and for the check."""

QUERY_TEXTS = {
    "query_join": """
        SELECT o.o_orderkey, c.c_name, n.n_name, r.r_name, o.o_totalprice
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
        WHERE o.o_orderstatus = 'F'
    """,
    "query_left_anti": """
        SELECT c.c_custkey, c.c_name FROM customer c
        WHERE NOT EXISTS (
            SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 400000
        )
    """,
    "query_semi_join": """
        SELECT p.p_partkey, p.p_name FROM part p
        WHERE p.p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')
    """,
    "query_agg": """
        SELECT l_returnflag, l_linestatus, count(*) AS line_count,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_quantity,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS sum_cents,
               count(DISTINCT l_suppkey) AS supplier_count,
               min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_returnflag, l_linestatus HAVING count(*) > 1
    """,
    "query_rollup": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS order_count,
               CAST(grouping(o_orderpriority) AS INT) AS is_subtotal
        FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
    """,
    "query_cube": """
        SELECT c_mktsegment, coalesce(c_nationkey, -1) AS nation_key, count(*) AS customer_count
        FROM customer GROUP BY CUBE (c_mktsegment, c_nationkey)
    """,
    "query_window": """
        SELECT event_id, user_id,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS visit,
               lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type,
               count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS last_ten
        FROM events
    """,
    "query_topk": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
    """,
    "query_setops": """
        (SELECT c_nationkey AS nation_key FROM customer
         INTERSECT SELECT s_nationkey FROM supplier)
        UNION ALL
        (SELECT n_nationkey FROM nation EXCEPT SELECT s_nationkey FROM supplier)
    """,
    "query_scalar": """
        SELECT p_partkey, upper(p_name) AS shouted, length(p_type) AS type_length,
               substring(p_brand, 7) AS brand_number, concat(p_type, '/', p_brand) AS label,
               CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END
                   AS size_class,
               coalesce(nullif(p_size, 1), 0) AS size_or_zero,
               CAST(floor(p_retailprice) AS BIGINT) AS whole_price
        FROM part
    """,
    "query_dates": """
        SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS order_year,
               CAST(month(o_orderdate) AS INT) AS order_month,
               CAST(o_orderdate AS DATE) AS order_day,
               date_trunc('month', CAST(o_orderdate AS DATE)) = date_trunc('month',
                   CAST(o_orderdate AS DATE) + INTERVAL '7' DAY) AS same_month
        FROM orders
    """,
    "query_subquery": """
        WITH spend AS (
            SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
            FROM orders GROUP BY o_custkey
        )
        SELECT o_custkey, cents FROM spend
        WHERE cents > (SELECT avg(cents) FROM spend)
    """,
}

# JSON access is spelled differently.
JSON_TEXT = """
    SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k FROM events
"""
JSON_CHECK = """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
"""
