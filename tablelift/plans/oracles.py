"""The same results as plain SQL over the given tables."""

from __future__ import annotations

from tablelift.plans.corpus import JSON_CHECK, QUERY_TEXTS
from tablelift.plans.queries import TABLE_NAMES

TABLE_COLUMNS = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": (
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate"
    ),
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def _counted(names: list[str]) -> str:
    return _union(
        [
            f"SELECT 'dbo' AS table_schema, '{n}' AS table_name, count(*) AS row_count FROM {n}"
            for n in names
        ]
    )


def _fan_out(names: list[str], database: str = "") -> str:
    return _union(
        [
            f"SELECT 'table:{database}dbo/{n}' AS task_id, count(*) AS rows_reported, "
            f"count(*) AS rows_found FROM {n}"
            for n in names
        ]
    )


# The declared type that a column's type in the files goes by in the catalog.
DECLARED_TYPE = """CASE typeof(any_value({})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
    WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'nvarchar' WHEN 'TIMESTAMP' THEN 'datetime2'
    WHEN 'FLOAT[]' THEN 'array<float>' END"""


def _columns() -> str:
    return _union(
        [
            f"SELECT '{name}' AS table_name, {i} AS ordinal_position, '{c}' AS column_name, "
            f"'YES' AS is_nullable, count({c}) AS values_before, "
            f"{DECLARED_TYPE.format(c)} AS data_type FROM {name}"
            for name, columns in TABLE_COLUMNS.items()
            for i, c in enumerate(columns.split(), start=1)
        ]
    )


def _slices(key: str, label: str, conditions: list[str]) -> str:
    return _union(
        [
            f"SELECT '{label}p{i:08d}' AS slice_id, count(*) AS row_count, min({key}) AS min_key, "
            f"max({key}) AS max_key FROM orders WHERE {condition}"
            for i, condition in enumerate(conditions)
        ]
    )


def _template_slices() -> str:
    bounds = "(SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders) b"
    edge = "b.lo + (b.hi - b.lo + 1) * {i} // 4"
    return _union(
        [
            f"SELECT 'query/p{i:08d}' AS slice_id, count(*) AS row_count, "
            f"min(o_orderkey) AS min_key, max(o_orderkey) AS max_key FROM orders, {bounds} "
            f"WHERE o_orderkey >= {edge.format(i=i)} AND o_orderkey < {edge.format(i=i + 1)}"
            for i in range(4)
        ]
    )


def _dry_run(names: list[str]) -> str:
    return _union(
        [
            f"SELECT 'table:dbo/{n}' AS task_id, 'table' AS kind, "
            f"'select * from `dbo`.`{n}`' AS sql, "
            f"'/lake/default/dbo/{n}/part-{{file_index}}' AS target_prefix, "
            f"count(*) AS source_rows FROM {n}"
            for n in names
        ]
    )


def _rows_of(names: list[str]) -> str:
    return " + ".join(f"(SELECT count(*) FROM {n})" for n in names)


def _loss(columns: dict[str, str]) -> str:
    return _union(
        [
            f"SELECT '{c}' AS column_name, count({c}) AS values_before, "
            f"count(*) FILTER (WHERE {c} IS NOT NULL AND TRY_CAST({c} AS {kind}) IS NULL) AS lost "
            "FROM orders"
            for c, kind in columns.items()
        ]
    )


def _made(name: str) -> str:
    return (
        "SELECT count(*) AS row_count, count(*) AS key_count, true AS shares_hold, "
        f"true AS ranges_hold FROM {name}"
    )


KEY_JSON = (
    "'{\"job_id\":\"job\",\"database\":null,\"schema\":\"dbo\",\"table\":\"' || %s || "
    "'\",\"query_name\":null,\"partition_id\":\"' || %s || '\",\"file_index\":' || %s || '}'"
)
ORDER_LOG = f"""
    SELECT sha256({KEY_JSON % ("'orders'", "'p' || o_custkey", "'0'")}) AS stable_id,
           'p' || o_custkey AS partition_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'planned' WHEN '2-HIGH' THEN 'running'
                WHEN '3-MEDIUM' THEN 'uploaded' WHEN '4-NOT SPECIFIED' THEN 'committed'
                WHEN '5-LOW' THEN 'failed' END AS status,
           o_orderstatus AS error,
           CAST(round(o_totalprice * 100) AS BIGINT) AS row_count,
           CAST(year(o_orderdate) AS INT) AS attempt,
           o_orderkey AS seq
    FROM orders
"""
LAST_OF_LOG = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stable_id ORDER BY seq DESC) AS age
                   FROM ({ORDER_LOG}))
    WHERE age = 1
"""
LEGAL = (
    "(previous_status IS NULL AND status = 'planned') OR coalesce(previous_status || '>' || status "
    "IN ('planned>running', 'running>uploaded', 'uploaded>committed', 'running>failed', "
    "'failed>running'), false)"
)
RANGE_STEP = "TIMESTAMP '1992-01-01' + INTERVAL {} HOUR"


def oracle_texts() -> dict[str, str]:
    edges = [RANGE_STEP.format(17_532 * i) for i in range(5)]
    ranges = [
        f"o_orderdate >= {edges[i]} AND o_orderdate {'<=' if i == 3 else '<'} {edges[i + 1]}"
        for i in range(4)
    ]
    counted = sorted(TABLE_NAMES)
    globbed = [n for n in counted if n[0] in "cdefghijklmno" or n in ("part", "pages")]
    globbed = [n for n in globbed if not n.endswith("s") and n != "nation"]
    in_database = [n for n in counted if not n.startswith(("embed", "l"))]
    texts = {
        "table_scan": "SELECT * FROM lineitem",
        "table_where": "SELECT * FROM orders WHERE o_totalprice > 1000",
        "column_projection": "SELECT c_mktsegment, c_custkey, c_name FROM customer WHERE c_acctbal > 0",
        "query_json": JSON_CHECK,
        "catalog_tables": _counted(counted),
        "catalog_columns": _columns(),
        "glob_filter": _counted(globbed),
        "schema_fanout": _fan_out(counted),
        "database_fanout": _fan_out(in_database),
        "slice_predicates": _slices(
            "o_totalprice",
            "",
            [
                "o_totalprice < 50000",
                "o_totalprice >= 50000 AND o_totalprice < 200000",
                "o_totalprice >= 200000",
            ],
        ),
        "slice_range": _slices("o_orderdate", "dbo/orders/", [*ranges, "o_orderdate IS NULL"]),
        "slice_template": _template_slices(),
        "slice_coverage": "SELECT 1 AS slices_hit, count(*) AS row_count FROM lineitem",
        "schema_from_catalog": """
            SELECT CAST(l_orderkey AS DOUBLE) AS l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey,
                   CAST(l_suppkey AS DOUBLE) AS l_suppkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber,
                   CAST(CAST(l_quantity AS DECIMAL(15,2)) AS DOUBLE) AS l_quantity,
                   CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS DOUBLE) AS l_extendedprice,
                   CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS l_discount, l_tax,
                   l_returnflag, l_linestatus, l_shipdate
            FROM lineitem
        """,
        "conform_columns": """
            SELECT CAST(TRY_CAST(o_orderkey AS INT) AS DOUBLE) AS o_orderkey,
                   CAST(TRY_CAST(o_custkey AS SMALLINT) AS DOUBLE) AS o_custkey, o_orderstatus,
                   CAST(TRY_CAST(o_totalprice AS DECIMAL(7,2)) AS DOUBLE) AS o_totalprice,
                   CAST(o_orderdate AS DATE) AS o_orderdate,
                   CAST(TRY_CAST(o_orderpriority AS INT) AS DOUBLE) AS o_orderpriority
            FROM orders
        """,
        "column_order": "SELECT p_retailprice, p_size, p_type, p_brand, p_name, p_partkey FROM part",
        "text_fallback": """
            SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
                   CAST(c_acctbal > 0 AS VARCHAR) AS in_credit, c_name
            FROM customer
        """,
        "cast_loss_report": _loss(
            {
                "o_orderkey": "INT",
                "o_custkey": "SMALLINT",
                "o_orderstatus": "VARCHAR",
                "o_totalprice": "DECIMAL(7,2)",
                "o_orderdate": "DATE",
                "o_orderpriority": "INT",
            }
        ),
        "csv_roundtrip": "SELECT * FROM documents",
        "tsv_roundtrip": "SELECT * FROM pages",
        "json_roundtrip": "SELECT * FROM conversations",
        "gzip_roundtrip": "SELECT * FROM events",
        "zstd_csv_roundtrip": "SELECT * FROM documents",
        "zstd_json_roundtrip": "SELECT * FROM lineitem",
        "zstd_parquet_roundtrip": "SELECT * FROM orders",
        "nested_text_roundtrip": """
            SELECT vec_id, label, CAST(len(embedding) AS INT) AS dimensions,
                   CAST(embedding[1] AS DOUBLE) AS first_value, CAST(label AS VARCHAR) AS raw_text
            FROM embeddings
        """,
        "split_rows": """
            SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS files_over_limit,
                   CAST(0 AS BIGINT) AS odd_names FROM lineitem
        """,
        "split_size": """
            SELECT true AS sizes_hold, true AS was_split, count(*) AS row_count FROM documents
        """,
        "empty_export": """
            SELECT count(*) AS file_count, count(*) AS row_count FROM lineitem WHERE l_quantity < 0
        """,
        "overwrite_export": """
            SELECT count(*) AS row_count, max(o_orderstatus) AS highest_status,
                   true AS files_match, true AS bytes_match
            FROM orders WHERE o_orderstatus = 'F'
        """,
        "append_export": "SELECT * FROM orders",
        "dry_run_plan": _dry_run([n for n in counted if n != "embeddings"]),
        "dry_run_summary": f"""
            SELECT CAST({len(counted)} AS BIGINT) AS planned_tasks, CAST(0 AS BIGINT) AS completed_tasks,
                   CAST(0 AS BIGINT) AS skipped_tasks, CAST(0 AS BIGINT) AS bytes_written,
                   {_rows_of(counted)} AS source_rows
        """,
        "export_summary": f"""
            SELECT CAST(3 AS BIGINT) AS completed_tasks, CAST(1 AS BIGINT) AS failed_tasks,
                   CAST(0 AS BIGINT) AS skipped_tasks,
                   {_rows_of(["orders", "customer", "part"])} AS rows_exported,
                   true AS has_bytes, CAST(1 AS BIGINT) AS error_count, true AS names_task
        """,
        "manifest_latest": f"SELECT stable_id, partition_id, status, row_count, seq FROM ({LAST_OF_LOG})",
        "manifest_lookup": f"""
            SELECT partition_id, status, seq FROM ({LAST_OF_LOG})
            WHERE partition_id IN (SELECT 'p' || c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
        """,
        "manifest_transitions": f"""
            SELECT previous_status, status, count(*) AS move_count, max(seq) AS last_seq
            FROM (SELECT *, lag(status) OVER (PARTITION BY stable_id ORDER BY seq) AS previous_status
                  FROM ({ORDER_LOG}))
            WHERE NOT ({LEGAL}) GROUP BY previous_status, status
        """,
        "manifest_open_work": f"""
            SELECT 'p' || c_custkey AS partition_id, coalesce(l.attempt, 0) + 1 AS attempt,
                   l.status AS last_status, l.error AS last_error
            FROM customer LEFT JOIN ({LAST_OF_LOG}) l ON l.partition_id = 'p' || c_custkey
            WHERE l.status IS NULL OR l.status <> 'committed'
        """,
        "stable_ids": "SELECT l_orderkey, sha256("
        + KEY_JSON % ("'lineitem'", "l_returnflag || '/' || l_linestatus", "l_orderkey")
        + ") AS stable_id FROM lineitem",
        "resume_export": "SELECT * FROM orders",
        "resume_attempts": _union(
            [
                f"SELECT 'p{i:08d}' AS partition_id, 'committed' AS status, {attempt} AS attempt, "
                "count(*) AS row_count, CAST(0 AS BIGINT) AS illegal_moves "
                f"FROM orders WHERE o_orderstatus = '{state}'"
                for i, (state, attempt) in enumerate((("F", 1), ("O", 2), ("P", 1)))
            ]
        ),
        "pinned_snapshot": "SELECT * FROM orders",
        "incremental_export": """
            SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS increment,
                   count(*) AS row_count, min(ts) AS first_ts, max(ts) AS last_ts
            FROM events GROUP BY 1
        """,
        "stream_incremental": """
            SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS row_count,
                   count(DISTINCT event_id) AS event_count
            FROM events GROUP BY 1, 2
        """,
        "late_row_report": """
            SELECT * FROM events
            WHERE event_type = 'purchase' AND ts <= TIMESTAMP '2024-01-20 00:00:00'
        """,
        "catalog_conform": "SELECT * FROM orders",
        "job_row_limit": _union([
            f"SELECT '{run}' AS run, count(*) AS row_count, true AS many_files, 0 AS over_limit FROM lineitem"
            for run in ("job", "config")
        ]),
        "append_empty": "SELECT * FROM orders WHERE o_totalprice >= 0",
        "slice_zoned": "SELECT 1 AS slices_hit, count(*) AS row_count FROM events",
        "slice_uncovered": """
            WITH hits AS (
                SELECT (o_orderkey % 3 = 0) AS p0, (o_orderkey % 3 = 1 OR o_orderkey % 9 = 0) AS p1 FROM orders
            )
            SELECT 'p00000000' AS slice_id, 'completed' AS status, count(*) FILTER (p0) AS rows,
                   NULL AS error FROM hits
            UNION ALL SELECT 'p00000001', 'completed', count(*) FILTER (p1), NULL FROM hits
            UNION ALL SELECT NULL, 'failed', 0, count(*) FILTER (NOT p0 AND NOT p1) || ' rows are in no slice, '
                   || count(*) FILTER (p0 AND p1) || ' in several' FROM hits
        """,
        "job_high_watermark": """
            SELECT count(*) AS first_run, 0 AS second_run, count(*) AS rows_found,
                   count(DISTINCT o_orderkey) AS keys_found FROM orders
        """,
        "resume_one_bad_slice": """
            SELECT 'completed' AS status, 7 AS slices, count(*) FILTER (o_orderkey % 8 < 7) AS row_count FROM orders
            UNION ALL SELECT 'failed', 1, 0
        """,
        "template_targets": _union([
            f"SELECT '{name}/single/chunk-N.parquet' AS file_pattern, count(*) AS row_count FROM {name}"
            for name in ("orders", "part")
        ]),
        "config_sliced_table": """
            SELECT count(DISTINCT o_orderkey) AS keys_found, count(*) AS rows_found, count(*) AS rows_reported
            FROM orders
        """,
        "gen_customers": _made("orders"),
        "gen_products": _made("orders"),
        "gen_orders": _made("orders"),
        "gen_order_items": _made("lineitem"),
        "gen_events": _made("events"),
        "gen_measurements": _made("lineitem"),
        "gen_transactions": _made("orders"),
        "gen_employees": _made("orders"),
        "gen_counts": _union(
            [
                f"SELECT '{made}' AS tbl, count(*) AS row_count FROM {source}"
                for made, source in (
                    ("dbo.customers", "customer"),
                    ("dbo.products", "part"),
                    ("dbo.orders", "orders"),
                    ("dbo.order_items", "lineitem"),
                    ("dbo.events", "events"),
                    ("dbo.measurements", "documents"),
                    ("sales.transactions", "conversations"),
                    ("hr.employees", "supplier"),
                )
            ]
        ),
    }
    return {**texts, **QUERY_TEXTS}
