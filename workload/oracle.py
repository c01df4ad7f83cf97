"""DuckDB SQL with the expected result of each query."""

from __future__ import annotations

LINE_LABEL = """CASE l_linenumber WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third'
    WHEN 4 THEN 'fourth' WHEN 6 THEN 'sixth' END"""

RETURN_LABEL = "CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' END"

EVENT_LABEL = """CASE event_type WHEN 'view' THEN 'browse' WHEN 'click' THEN 'browse'
    WHEN 'purchase' THEN 'buy' END"""

# Escaped whitespace (the tab) is no whitespace in the JSON text, so it survives stripping.
TRANSACTIONS = """
    SELECT 'tx' || o_orderkey AS transaction_id,
           o_custkey AS buyer_buyer_id,
           replace(o_orderpriority, ' ', '') AS buyer_city,
           'Buyerno' || o_custkey AS buyer_name,
           'desk' || chr(9) || o_orderstatus AS seller_platform,
           o_orderkey + o_custkey AS seller_seller_id,
           o_totalprice AS transaction_details_amount,
           'USD' AS transaction_details_currency,
           o_orderstatus AS transaction_details_merchant,
           strftime(o_orderdate, '%Y-%m-%d%H:%M:%S') AS transaction_details_transaction_time
    FROM orders
    WHERE o_orderpriority <> '3-MEDIUM' AND o_orderstatus IS DISTINCT FROM 'P'
"""

SHIPMENTS = """
    SELECT l.*, s.s_nationkey AS from_nationkey, c.c_nationkey AS to_nationkey
    FROM lineitem l
    LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
    LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""

PLACES = """
    SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
"""

ENRICHED = f"""
    WITH shipments AS ({SHIPMENTS}), places AS ({PLACES})
    SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
           l_linestatus, l_shipdate, from_nationkey, to_nationkey,
           {LINE_LABEL} AS line_label,
           {RETURN_LABEL} AS return_label,
           CAST(l_shipdate AS date) AS cobdate,
           a.n_name AS from_nation, a.r_name AS from_region,
           b.n_name AS to_nation, b.r_name AS to_region
    FROM shipments
    LEFT JOIN places a ON from_nationkey = a.n_nationkey
    LEFT JOIN places b ON to_nationkey = b.n_nationkey
"""

DATED_EVENTS = "SELECT *, CAST(ts AS date) AS cobdate FROM events"

# Java's \s, written out because RE2's \s has no vertical tab.
STRIP = r"regexp_replace(text, '[ \t\n\x0B\f\r]+', '', 'g')"

ORACLE: dict[str, str] = {
    "scan_parquet": "SELECT * FROM lineitem",
    "scan_parquet_evolving": """
        SELECT * REPLACE (CASE WHEN l_returnflag <> 'R' THEN l_tax END AS l_tax) FROM lineitem
    """,
    "scan_csv": "SELECT * FROM customer",
    "scan_csv_rejects": """
        SELECT CASE WHEN c_nationkey IN (3, 7) THEN NULL ELSE c_custkey END AS c_custkey,
               CASE WHEN c_nationkey IN (3, 7) THEN NULL ELSE c_nationkey END AS c_nationkey,
               CASE c_nationkey WHEN 3 THEN 'no ' || c_custkey || ',' || c_nationkey
                                WHEN 7 THEN c_custkey || ',' || c_nationkey || ',more' END AS line
        FROM customer
    """,
    "table_count_sql": "SELECT count(*) AS n FROM orders",
    "table_scan_current_namespace": "SELECT * FROM customer",
    "table_lifecycle": f"""
        SELECT *, 'ledger' AS listed_tables, 1 AS listed_namespaces FROM ({TRANSACTIONS})
    """,
    "partitioned_replace": DATED_EVENTS,
    "replace_row_count": "SELECT count(*) AS n_table, count(*) AS n_written FROM events",
    "partition_reload": DATED_EVENTS,
    "partition_prune": f"SELECT * FROM ({DATED_EVENTS}) WHERE cobdate >= DATE '2024-01-11'",
    "enrich_int_code": f"SELECT l_orderkey, l_linenumber, {LINE_LABEL} AS line_label FROM lineitem",
    "enrich_many_codes": """
        SELECT l_orderkey, l_linenumber, CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS date)) AS integer) AS day,
               CASE WHEN day IS NULL THEN 'no date' WHEN day BETWEEN 0 AND 3999 AND day % 2 = 0 THEN 'day ' || day
                    ELSE 'odd day' END AS day_label
        FROM lineitem
    """,
    "enrich_string_code": f"""
        SELECT l_orderkey, l_returnflag, {RETURN_LABEL} AS return_label,
               coalesce({RETURN_LABEL}, 'unknown') AS return_label_or_default
        FROM lineitem
    """,
    "to_date": "SELECT event_id, CAST(ts AS date) AS cobdate FROM events",
    "drop_columns": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders",
    "left_join_dim": """
        SELECT d.doc_id, lang, source, quality, toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
    "left_join_unique": """
        SELECT d.doc_id, lang, source, quality, toxic
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
    "left_join_newest": """
        WITH newest AS (
            SELECT user_id, ts, event_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k
            FROM events
        )
        SELECT s_suppkey, s_name, ts AS last_ts, event_id AS last_event
        FROM supplier LEFT JOIN newest ON s_suppkey = user_id AND k = 1
    """,
    "role_playing_dim": f"""
        WITH shipments AS ({SHIPMENTS}), places AS ({PLACES})
        SELECT l_orderkey, l_linenumber, from_nationkey, to_nationkey,
               a.n_name AS from_nation, a.r_name AS from_region,
               b.n_name AS to_nation, b.r_name AS to_region
        FROM shipments
        LEFT JOIN places a ON from_nationkey = a.n_nationkey
        LEFT JOIN places b ON to_nationkey = b.n_nationkey
    """,
    "count_rows": "SELECT count(*) AS n FROM lineitem",
    "filter_not_null": f"""
        SELECT event_id, {EVENT_LABEL} AS label FROM events WHERE {EVENT_LABEL} IS NOT NULL
    """,
    "strip_whitespace": f"SELECT doc_id, {STRIP} AS stripped FROM documents",
    "cast_binary": "SELECT doc_id, text FROM documents",
    "struct_star": "SELECT event_id, CAST(props ->> '$.k' AS bigint) AS k FROM events",
    "from_json_flat": """
        SELECT event_id, event_type, CAST(props ->> '$.k' AS bigint) AS k FROM events
    """,
    "from_json_nested": TRANSACTIONS,
    "flatten_structs": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus <> 'O' THEN c_name END AS buyer_c_name,
               CASE WHEN o_orderstatus <> 'O' THEN c_acctbal END AS buyer_c_acctbal,
               CASE WHEN o_orderstatus <> 'O' THEN n_name END AS buyer_home_nation,
               CASE WHEN o_orderstatus <> 'O' THEN n_regionkey END AS buyer_home_region,
               o_totalprice AS terms_o_totalprice,
               o_orderpriority AS terms_urgency_o_orderpriority,
               o_orderstatus
        FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey
    """,
    "explode_outer": """
        WITH found AS (
            SELECT d.doc_id, quality,
                   CASE WHEN quality IS NOT NULL
                        THEN regexp_extract_all(text, '[0-9]+') END AS numbers
            FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        )
        SELECT doc_id, quality, unnest(numbers) AS number FROM found
        UNION ALL
        SELECT doc_id, quality, NULL FROM found WHERE numbers IS NULL OR len(numbers) = 0
    """,
    "explode_all": """
        WITH lines AS (
            SELECT conv_id, turn, role, unnest(string_split(text, chr(10))) AS line
            FROM conversations
        ), words AS (
            SELECT conv_id, turn, role, unnest(string_split(line, ' ')) AS word FROM lines
        )
        SELECT conv_id, turn AS message_turn, word AS message_word,
               'role' AS tag_kind, role AS tag_value
        FROM words
        UNION ALL
        SELECT conv_id, turn, word, 'turn', CAST(turn AS varchar) FROM words
    """,
    "explode_vectors": "SELECT vec_id, unnest(embedding) AS embedding, label FROM embeddings",
    "enrichment": ENRICHED,
    "batch_enrichment": ENRICHED,
    "batch_enrichment_events": f"""
        SELECT event_id, ts, user_id, value, CAST(props ->> '$.k' AS bigint) AS k,
               {EVENT_LABEL} AS event_label, CAST(ts AS date) AS cobdate,
               a.s_name AS user_name, a.s_nationkey AS user_nationkey,
               b.s_name AS partner_name, b.s_nationkey AS partner_nationkey
        FROM events
        LEFT JOIN supplier a ON user_id = a.s_suppkey
        LEFT JOIN supplier b ON CAST(props ->> '$.k' AS bigint) = b.s_suppkey
    """,
    "stream_append": "SELECT * FROM events",
    "stream_interval": "SELECT * FROM events",
    "stream_restart": TRANSACTIONS,
    "stream_archived": TRANSACTIONS,
    "stream_transactions": TRANSACTIONS,
    "stream_two_writers": "SELECT * FROM events",
    "stream_rejects": """
        WITH sent AS (
            SELECT *, o_orderpriority <> '3-MEDIUM' AND o_orderstatus IS DISTINCT FROM 'P' AS usable FROM orders
        )
        SELECT CASE WHEN usable THEN 'tx' || o_orderkey END AS transaction_id, o_custkey AS buyer_id,
               o_orderkey + o_custkey AS seller_id, NOT usable AS rejected
        FROM sent
    """,
}
