"""The same answers in SQL, straight from the tables."""

from __future__ import annotations

FLAT_ORDERS = """
SELECT o_orderkey AS _id, o_custkey AS cust_key, o_orderstatus AS order_status,
       o_totalprice AS total_price, o_orderpriority AS order_priority, epoch_ms(o_orderdate) AS order_ms
FROM orders"""

LATEST = """
SELECT user_id, event_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'error'"""

NAME = "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'error' THEN 'REMOVE' ELSE 'MODIFY' END"
START = "TIMESTAMP '2024-01-15 00:00:00'"

SNAKE = "lower(substr({0}, 1, 1) || regexp_replace(substr({0}, 2), '([A-Z])', '_\\1', 'g'))"

ORACLE: dict[str, str] = {
    "migrate_orders": FLAT_ORDERS,
    "migrate_orders_typed": FLAT_ORDERS.replace("FROM orders", ", '' AS misfits FROM orders"),
    "migrate_documents": """
SELECT doc_id AS _id, lang, length(text) AS chars, md5(text) AS text_md5 FROM documents""",
    "embedding_items": """
SELECT vec_id AS _id, label, CAST(len(embedding) AS BIGINT) AS dims, CAST(embedding[1] AS DOUBLE) AS first
FROM embeddings""",
    "decode_guard": """
SELECT o_orderkey AS id,
       CASE WHEN o_orderkey % 7 = 0 THEN 'quarantine' ELSE 'good' END AS status,
       CASE WHEN o_orderkey % 7 = 0 THEN 'v' END AS field,
       CASE WHEN o_orderkey % 7 = 0 THEN 'value cannot be decoded' END AS reason,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS leaf,
       CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 6 END AS levels
FROM orders""",
    "typed_nested": """
SELECT o_orderkey AS _id, '[' || x || ',' || x || ']' AS order_lines,
       '{"first_one":' || x || ',"z_last":' || x || '}' AS by_name, '' AS misfits
FROM (SELECT o_orderkey, '{"cust_key":' || o_custkey || ',"some_tags":[{"order_priority":"' || o_orderpriority || '"}]}' AS x FROM orders)""",
    "project_deep": """
SELECT o_orderkey AS _id, 'good' AS status, CAST(2 AS BIGINT) AS fields, o_custkey AS leaf, o_orderkey % 7 AS levels FROM orders""",
    "decode_both_ways": """
SELECT o_orderkey AS _id, place,
       CASE o_orderkey % 8 WHEN 0 THEN 'BIGINT' WHEN 4 THEN 'STRING' WHEN 6 THEN 'STRING' ELSE 'DOUBLE' END AS kind,
       ['-7', '150.0', '"NaN"', '"-Infinity"', '"1e400"', '9.223372036854776E19', '" 5 "', '16.0'][o_orderkey % 8 + 1] AS value
FROM orders, (SELECT unnest(['alone', 'beside', 'inside']) AS place)""",
    "round_trip_deep": """
SELECT o_orderkey AS _id, 'good' AS status, o_custkey AS number, o_orderpriority AS text, CAST(3 AS BIGINT) AS elements,
       o_orderkey % 7 AS levels FROM orders""",
    "poison_items": """
SELECT CASE WHEN k = 0 THEN 'good' ELSE 'quarantine' END AS status,
       CASE WHEN k IN (4, 5) THEN '*' WHEN k > 0 THEN 'bad' END AS field,
       CASE WHEN k IN (4, 5) THEN 'malformed record' WHEN k > 0 THEN 'value cannot be decoded' END AS reason,
       count(*) AS records, count(*) FILTER (k > 0) AS with_raw
FROM (SELECT o_orderkey % 8 AS k FROM orders) GROUP BY ALL""",
    "snake_case": f"""
SELECT p_partkey, {SNAKE.format('n')} AS name FROM (
  SELECT p_partkey, p_type || '_' || p_brand ||
         array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS n
  FROM part)""",
    "camel_case": """
SELECT p_partkey, lower(p_type) || array_to_string(list_transform(
         string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), '') AS name
FROM part""",
    "number_parse": """
SELECT o_orderkey,
       CASE o_orderkey % 5 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' ELSE 'DOUBLE' END AS kind,
       CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS DOUBLE) WHEN 1 THEN NULL
            WHEN 2 THEN CAST(o_custkey || 'e2' AS DOUBLE)
            WHEN 3 THEN CAST('9223372036854775808' || o_custkey AS DOUBLE) ELSE o_totalprice END AS value,
       CASE WHEN o_orderkey % 5 = 1 THEN ' ' || o_custkey || ' ' END AS text
FROM orders""",
    "decimal_transform": """
SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS acctbal FROM customer""",
    "to_datetime": """
SELECT o_orderkey, epoch_ms(o_orderdate) + CASE o_orderkey % 7
         WHEN 0 THEN 3723000 WHEN 1 THEN 3723500 - 7200000 WHEN 2 THEN 3723000
         WHEN 3 THEN 0 WHEN 4 THEN 0 END AS ms
FROM orders""",
    "to_object": """
SELECT event_id, CAST(props->>'$.k' AS DOUBLE) AS k, 'OBJECT<k: DOUBLE>' AS shape FROM events""",
    "to_array": """
SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n,
       CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey AS DOUBLE) END AS number,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS text
FROM orders""",
    "binary_values": """
SELECT p_partkey AS _id, to_base64(CAST(p_name AS BLOB)) AS blob, 'base64' AS mode FROM part
UNION ALL SELECT p_partkey, p_name, 'utf8' FROM part""",
    "filter_project": """
SELECT o_orderkey AS _id, o_orderstatus AS status, CAST(3 AS BIGINT) AS fields
FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000""",
    "scan_counts": """
SELECT count(*) AS scanned_count, count(*) FILTER (o_orderstatus = 'F') AS item_count FROM orders""",
    "composite_key": """
SELECT count(*) AS documents, count(DISTINCT conv_id) AS distinct_keys,
       count(*) - count(DISTINCT conv_id) AS replaced, 'conv_id' AS key_fields FROM conversations
UNION ALL
SELECT count(*), count(DISTINCT (conv_id, turn)), count(*) - count(DISTINCT (conv_id, turn)), 'conv_id,turn'
FROM conversations""",
    "key_collisions": """
SELECT count(*) AS documents, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS replaced FROM lineitem""",
    "keyless_insert": """
SELECT CAST(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, count(*) AS documents
FROM customer GROUP BY ALL""",
    "set_nested": """
SELECT o_orderkey AS _id, o_orderpriority AS priority, o_totalprice AS total_price, true AS clash FROM orders""",
    "round_trip": FLAT_ORDERS,
    "export_items": FLAT_ORDERS,
    "naming_collision": """
SELECT o_orderkey AS _id, o_orderkey * 2 AS a_b, CAST(2 AS BIGINT) AS fields FROM orders""",
    "nulls_kept": """
SELECT c_custkey AS _id,
       CASE WHEN c_acctbal < 0 THEN 'VOID' WHEN c_acctbal = floor(c_acctbal) THEN 'BIGINT' ELSE 'DOUBLE' END AS kind,
       true AS absent, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS positive
FROM customer""",
    "quarantine_split": """
SELECT CASE WHEN reason IS NULL THEN 'good' ELSE 'quarantine' END AS status,
       CASE reason WHEN 'malformed record' THEN '*' WHEN 'transform failed' THEN 'order_date' END AS field,
       reason, count(*) AS records, count(reason) AS with_raw, count(*) - count(reason) AS with_doc
FROM (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'malformed record'
                  WHEN o_orderkey % 11 = 0 THEN 'transform failed' END AS reason FROM orders)
GROUP BY reason""",
    "state_difference": """
SELECT side, count(*) AS documents FROM orders, (VALUES ('left'), ('right')) AS s(side)
WHERE o_custkey % 3 = 0 AND o_custkey <> 0 GROUP BY side""",
    "change_records": f"""
SELECT event_id, {NAME} AS event_name, 'us-west-2' AS aws_region, 'shard-' || user_id % 4 AS shard_id,
       length(props) AS size_bytes, 'NEW_IMAGE' AS view_type, epoch_us(ts) AS ts_us,
       CAST(1 AS BIGINT) AS keys, CASE WHEN event_type <> 'error' THEN CAST(5 AS BIGINT) END AS fields
FROM events""",
    "time_filter": f"SELECT event_id, {NAME} AS event_name FROM events WHERE ts >= {START}",
    "time_filter_counts": f"""
SELECT count(*) FILTER (event_id % 9 <> 0 AND ts >= {START}) AS kept,
       count(*) FILTER (event_id % 9 <> 0 AND ts < {START}) AS older,
       count(*) FILTER (event_id % 9 = 0) AS untimed FROM events""",
    "sequence_filter": """
SELECT 'shard-' || user_id % 4 AS shard_id, count(*) AS records, min(event_id) AS first_seq
FROM events WHERE event_id >= 777 GROUP BY 1""",
    "event_route": """
SELECT CASE WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS op,
       CAST(NULL AS VARCHAR) AS problem, count(*) AS records FROM events GROUP BY 1""",
    "strict_route": """
SELECT op, CASE WHEN reason IS NULL THEN 'good' ELSE 'quarantine' END AS status, reason, count(*) AS records
FROM (SELECT CASE WHEN event_id % 5 = 0 OR event_id % 7 = 0 THEN NULL
                  WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPSERT' END AS op,
             CASE WHEN event_id % 5 = 0 AND event_type = 'error' THEN 'keys missing'
                  WHEN event_id % 5 = 0 THEN 'new image missing'
                  WHEN event_id % 7 = 0 THEN 'unknown event' END AS reason FROM events)
GROUP BY ALL""",
    "delete_keys": """
SELECT 'n:' || user_id AS key, count(*) AS deletes FROM events WHERE event_type = 'error' GROUP BY 1""",
    "apply_latest": LATEST,
    "poison_changes": """
SELECT CASE event_type WHEN 'error' THEN 'DELETE' ELSE 'UPSERT' END AS op,
       CASE WHEN event_id % 11 = 0 THEN 'quarantine' ELSE 'good' END AS status,
       CASE WHEN event_id % 11 = 0 THEN 'sequence number missing or not a number' END AS reason,
       count(*) AS records, count_if(event_id % 11 <> 0 AND event_id % 13 = 0)::BIGINT AS untimed
FROM events GROUP BY ALL""",
    "unmapped_apply": f"""
SELECT 'k:{{"user_id":' || user_id || '}}' AS key, user_id, event_id, event_type, value FROM ({LATEST})""",
    "high_water": """
SELECT 'shard-' || user_id % 4 AS shard_id, epoch_us(max(ts)) AS high_water_us FROM events GROUP BY 1""",
    "shard_list": """
SELECT 'shard-' || user_id % 4 AS shard_id, lpad(CAST(min(event_id) AS VARCHAR), 40, '0') AS start_seq_key,
       lpad(CAST(max(event_id) AS VARCHAR), 40, '0') AS end_seq_key, count(*) AS records
FROM events GROUP BY 1""",
    "bulk_counts": f"""
WITH old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
                            FROM events WHERE ts < {START}) WHERE rn = 1 AND event_type <> 'error'),
     net AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
                            FROM events WHERE ts >= {START}) WHERE rn = 1)
SELECT CAST(0 AS BIGINT) AS inserted,
       count(*) FILTER (net.event_type <> 'error' AND old.user_id IS NULL) AS upserted,
       count(*) FILTER (net.event_type <> 'error' AND old.event_id <> net.event_id) AS modified,
       count(*) FILTER (net.event_type <> 'error' AND old.event_id = net.event_id) AS unchanged,
       count(*) FILTER (net.event_type = 'error' AND old.user_id IS NOT NULL) AS deleted,
       count(*) FILTER (net.event_type = 'error' AND old.user_id IS NULL) AS not_found
FROM net LEFT JOIN old USING (user_id)""",
    "migrate_job": FLAT_ORDERS,
    "resume_segments": FLAT_ORDERS,
    "scan_segments": """
SELECT 'segments' AS "table", count(*) AS processed, CAST(4 AS BIGINT) AS segments_done FROM orders""",
    "pair_status": """
SELECT 'status' AS pair, 'migrate' AS mode, count(*) AS processed,
       count(*) FILTER (o_orderkey % 13 = 0 OR o_orderkey % 11 = 0) AS quarantined, count(*) AS items,
       count(*) FILTER (o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0) AS documents,
       CAST(100 AS DOUBLE) AS percent, false AS stream_enabled
FROM orders""",
    "many_pairs": """
SELECT 'orders' AS pair, count(*) AS processed, count(*) AS documents, CAST(NULL AS VARCHAR) AS source_error, false AS failed FROM orders
UNION ALL SELECT 'customers', count(*), count(*), NULL, false FROM customer
UNION ALL SELECT 'lost', 0, 0, 'not found', true""",
    "dry_run": """
SELECT 'dry' AS pair, 'source' AS "check", true AS ok,
       count(*) FILTER (o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0) || ' documents, ' ||
       count(*) FILTER (o_orderkey % 13 = 0 OR o_orderkey % 11 = 0) || ' quarantined' AS detail
FROM orders
UNION ALL SELECT 'dry', 'target', true, 'new'""",
    "table_quarantine": """
SELECT CASE WHEN o_orderkey % 13 = 0 THEN '*' ELSE 'order_date' END AS field,
       CASE WHEN o_orderkey % 13 = 0 THEN 'malformed record' ELSE 'transform failed' END AS reason,
       count(*) AS records
FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 GROUP BY ALL""",
    "compacted_table": LATEST,
    "two_pairs_one_target": """
SELECT o_orderkey AS _id, o_custkey AS cust_key, coalesce(c_mktsegment, o_orderstatus) AS order_status,
       o_totalprice AS total_price, o_orderpriority AS order_priority, epoch_ms(o_orderdate) AS order_ms
FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal < 0""",
    "migrate_after_live": f"""
SELECT user_id, event_id, event_type, value, props FROM ({LATEST}) WHERE user_id NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT c_custkey, NULL, 'restored', c_acctbal, c_name FROM customer""",
    "table_lookup": f"""
SELECT user_id, event_id, event_type, value, props FROM ({LATEST}) WHERE user_id IN (SELECT c_custkey FROM customer)""",
    "stream_apply": LATEST,
    "live_bootstrap": LATEST,
    "live_drop_counts": f"""
SELECT count(*) AS read, count(*) FILTER (event_id % 9 <> 0 AND ts < {START}) AS older,
       count(*) FILTER (event_id % 9 = 0) AS untimed,
       count(*) FILTER (event_id % 9 <> 0 AND ts >= {START} AND event_id % 7 = 0) AS skipped
FROM events""",
}
ORACLE["replicate_from"] = f"""
SELECT position, event_id, CASE event_type WHEN 'error' THEN 'DELETE' ELSE 'UPSERT' END AS op FROM (
  SELECT *, row_number() OVER (PARTITION BY position, user_id ORDER BY event_id DESC) AS rn
  FROM events JOIN (SELECT unnest(['at', 'after', 'time', 'newest']) AS position)
    ON CASE position WHEN 'at' THEN event_id >= 777 WHEN 'after' THEN event_id > 777 WHEN 'time' THEN ts >= {START} ELSE false END)
WHERE rn = 1"""
ORACLE["trimmed_log"] = """
SELECT 'shard-' || user_id % 4 AS shard_id, count(*) AS records, min(event_id) AS first_seq, max(event_id) AS last_seq, true AS files_gone
FROM events WHERE event_id % 4 = 2 GROUP BY 1"""
ORACLE["shard_lineage"] = """
WITH RECURSIVE u AS (SELECT DISTINCT user_id AS u FROM events),
e AS (SELECT u AS child, u // 2 AS parent FROM u WHERE u > 1 UNION SELECT u, u // 3 FROM u WHERE u % 3 = 0),
k AS (SELECT child, parent FROM e SEMI JOIN u ON u.u = e.parent),
g AS (SELECT u AS shard, 0 AS depth FROM u UNION SELECT k.child, depth + 1 FROM g JOIN k ON k.parent = g.shard WHERE k.child <> k.parent)
SELECT 's' || shard AS shard_id, CAST(max(depth) AS BIGINT) AS generation FROM g WHERE shard <> 0 GROUP BY 1"""
ORACLE["stream_counts"] = ORACLE["bulk_counts"]
