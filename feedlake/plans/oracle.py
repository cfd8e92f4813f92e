"""Oracle SQL (DuckDB dialect) for the query catalogue.

Each statement computes, straight from the driver tables, what the Spark
query computes through landed documents, writers and readers.  Column names
and types match the Spark side.
"""

from __future__ import annotations

# The query parameters, stated here on their own: an error in the catalogue's
# must show as a difference, not be shared.
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
)
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
EVENT_TYPE_LABELS = {
    "click": ("Click", "CLK"), "error": ("Error", "ERR"), "purchase": ("Purchase", "PUR"), "signup": ("Sign-up", "SGN"),
    "view": ("View", "VEW"),
}
URL_RULES = (("?", "query"), ("#", "fragment"), ("blog.", "blog"), (".html", "static"))
CUSTOMER_REQUIRED = ("c_custkey", "c_name", "c_phone", "c_mktsegment")
ORDER_STATES = ("F", "O", "P")
MERGE_SNAPSHOTS = ((1, 1, 15), (2, 10, 25), (3, 20, 31))
PRUNE_FROM_DATE, PRUNE_MIN_PRICE, THRESHOLD = "2024-01-15", 100.0, 50.0
CHART_CHUNK, SPOT_CHUNK, CATALOG_CHUNK = 256, 256, 1000


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


MS = "date_trunc('millisecond', ts)"

# chart points exist only for pairs with both a time and a value
CHART_EVENTS = "(SELECT * FROM events WHERE ts IS NOT NULL AND value IS NOT NULL)"

CHART_POINTS = f"""
SELECT event_type AS coin_id, {MS} AS "timestamp", value AS price, CAST(ts AS DATE) AS date
FROM {CHART_EVENTS}"""

# one spot row per numeric quote in an event's props
SPOT_QUOTES = """
(SELECT CAST(event_id AS VARCHAR) AS coin_id, e.key AS currency, TRY_CAST(e.value AS DOUBLE) AS price
 FROM events, UNNEST(map_entries(CAST(CAST(props AS JSON) AS MAP(VARCHAR, VARCHAR)))) AS u(e)
 WHERE TRY_CAST(e.value AS DOUBLE) IS NOT NULL)"""

# kept rows and problems per feed of the documents with a known share of damaged parts
FEED_DAMAGE = f"""
SELECT 'chart' AS kind, 'rows' AS what, count(*) AS n FROM {CHART_EVENTS} WHERE event_id % 7 <> 0
UNION ALL SELECT 'chart', 'non-numeric pair in prices', count(*) FROM events WHERE ts IS NOT NULL AND event_id % 7 = 0 HAVING count(*) > 0
UNION ALL SELECT 'chart', 'short pair in prices', count(*) FROM events
  WHERE ts IS NULL OR (value IS NULL AND event_id % 7 <> 0) HAVING count(*) > 0
UNION ALL SELECT 'spot', 'rows', count(*) FROM {SPOT_QUOTES} WHERE CAST(coin_id AS BIGINT) % 5 <> 0
UNION ALL SELECT 'spot', 'no quotes under', count(*) FROM events WHERE event_id % 5 = 0 HAVING count(*) > 0
UNION ALL SELECT 'catalog', 'rows', count(*) FROM customer WHERE c_custkey % 11 <> 0
UNION ALL SELECT 'catalog', 'element is not an object', count(*) FROM customer WHERE c_custkey % 11 = 0 HAVING count(*) > 0"""

CHART_TABLE_COUNTS = f"""
SELECT coin_id, date, count(*) AS n_points, min(price) AS min_price, max(price) AS max_price
FROM ({CHART_POINTS}) GROUP BY coin_id, date"""

_pivot = ",\n  ".join(
    f"arg_max(value, (ts, event_id)) FILTER (WHERE event_type = {_q(t)}) AS {t}" for t in EVENT_TYPES
)

_url_case = " ".join(f"WHEN contains(url, {_q(n)}) THEN {_q(k)}" for n, k in URL_RULES)

_merge_parts = "\nUNION ALL\n".join(
    f"SELECT event_type AS coin_id, {MS} AS t, value + {float(s)} AS price, {s} AS snap FROM {CHART_EVENTS} "
    f"WHERE day(ts) BETWEEN {a} AND {b}"
    for s, a, b in MERGE_SNAPSHOTS
)

_required = "\nUNION ALL\n".join(
    f"SELECT {_q(c)} AS column_name, true AS present, count({c}) AS non_null FROM customer"
    if c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    else f"SELECT {_q(c)} AS column_name, false AS present, CAST(NULL AS BIGINT) AS non_null"
    for c in CUSTOMER_REQUIRED
)

_label_case = " ".join(f"WHEN {_q(k)} THEN {_q(v[0])}" for k, v in EVENT_TYPE_LABELS.items())
_code_case = " ".join(f"WHEN {_q(k)} THEN {_q(v[1])}" for k, v in EVENT_TYPE_LABELS.items())

_known = ", ".join(f"({_q(s)})" for s in ORDER_STATES)

_lines = "length(text) - length(replace(text, chr(10), '')) + CASE WHEN length(text) > 0 AND NOT suffix(text, chr(10)) THEN 1 ELSE 0 END"

_doc_cols = ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
_order_cols = (
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "double"),
    ("o_orderdate", "timestamp_ntz"),
    ("o_orderpriority", "string"),
)

ORACLE: dict[str, str] = {
    "chart_prices": CHART_POINTS,
    "chart_volumes": """
SELECT l_returnflag AS coin_id, date_trunc('millisecond', l_shipdate) AS "timestamp", l_quantity AS volume,
       CAST(l_shipdate AS DATE) AS date
FROM lineitem WHERE l_shipdate IS NOT NULL AND l_quantity IS NOT NULL""",
    "series_stats": f"""
SELECT event_type AS coin_id, CAST(ts AS DATE) AS date, count(value) AS n_points,
       min({MS}) AS first_ts, max({MS}) AS last_ts, round(avg(value), 6) AS mean_price,
       min(value) AS min_price, max(value) AS max_price
FROM {CHART_EVENTS} GROUP BY 1, 2""",
    "catalog_project": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS symbol, c_name AS name FROM customer""",
    "json_document_scan": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders""",
    "landing_scan": "SELECT page_id, url, CAST(length(html) AS BIGINT) AS n_chars FROM pages",
    "spot_long": f"SELECT * FROM {SPOT_QUOTES}",
    "spot_wide": f"""
SELECT user_id AS coin_id,
  {_pivot}
FROM events GROUP BY user_id""",
    "spot_usd": """
SELECT CAST(event_id AS VARCHAR) AS coin_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
FROM events WHERE json_exists(props, '$.k') AND TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) IS NOT NULL""",
    "cast_measures": """
SELECT l_orderkey, CAST(l_partkey AS DOUBLE) AS l_partkey, CAST(l_suppkey AS DOUBLE) AS l_suppkey, l_linenumber,
       CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,
       CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax,
       TRY_CAST(l_returnflag AS DOUBLE) AS l_returnflag, TRY_CAST(l_linestatus AS DOUBLE) AS l_linestatus, l_shipdate
FROM lineitem""",
    "feed_routing": f"SELECT page_id, CASE {_url_case} ELSE 'unrecognised' END AS kind FROM pages",
    "shape_routing": f"""
SELECT 'chart' AS shape, count(*) AS n_docs FROM (SELECT DISTINCT event_type, CAST(ts AS DATE), event_id // {CHART_CHUNK} FROM events)
UNION ALL SELECT 'spot', count(*) FROM (SELECT DISTINCT event_id // {SPOT_CHUNK} FROM events)
UNION ALL SELECT 'catalog', count(*) FROM (SELECT DISTINCT c_custkey // {CATALOG_CHUNK} FROM customer)
UNION ALL SELECT 'invalid', count(*) FROM pages
UNION ALL SELECT 'unrecognised', count(*) FROM events""",
    "name_field": r"""
SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, split_part(url, '/', 4) AS section,
       regexp_extract(regexp_extract(url, '^[^?#]*', 0), '([^/]+?)(\.[^./]*)?$', 1) AS leaf
FROM pages""",
    "latest_snapshot": """
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
    "chart_merge": f"""
SELECT coin_id, t AS "timestamp", price FROM (
  SELECT *, row_number() OVER (PARTITION BY coin_id, t ORDER BY snap DESC, price DESC) AS rn
  FROM ({_merge_parts}))
WHERE rn = 1""",
    "table_roundtrip": "SELECT * FROM supplier",
    "failed_overwrite_kept": """
SELECT form, o_orderkey, o_orderstatus, o_totalprice
FROM orders, (VALUES ('full'), ('partitioned'), ('touched'), ('merge')) f(form)""",
    "partitioned_overwrite": CHART_TABLE_COUNTS,
    "partition_refresh": f"""
SELECT coin_id, date, count(*) AS n_points, max(price) AS max_price FROM (
  SELECT event_type AS coin_id, CAST(ts AS DATE) AS date,
         CASE WHEN CAST(ts AS DATE) = (SELECT min(CAST(ts AS DATE)) FROM {CHART_EVENTS}) THEN 0.0 ELSE value END AS price
  FROM {CHART_EVENTS})
GROUP BY coin_id, date""",
    "partition_pruned_read": f"""
SELECT * FROM ({CHART_POINTS}) WHERE date >= DATE '{PRUNE_FROM_DATE}' AND price > {PRUNE_MIN_PRICE}""",
    "partition_listing": f"""
SELECT DISTINCT event_type AS coin_id, CAST(ts AS DATE) AS date FROM {CHART_EVENTS} ORDER BY 1, 2""",
    "write_verify": f"""
SELECT 'chart_prices' AS table_name, count(*) AS rows_written, count(*) AS rows_read FROM {CHART_EVENTS}
UNION ALL SELECT 'spot', count(*), count(*) FROM {SPOT_QUOTES}
UNION ALL SELECT 'catalog', count(*), count(*) FROM customer""",
    "csv_export": "SELECT * FROM documents",
    "discovered_tables": """
SELECT 'nation' AS table_name, count(*) AS n_rows FROM nation
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'supplier', count(*) FROM supplier""",
    "json_export": "SELECT * FROM part",
    "preview_rows": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5",
    "schema_profile": "\nUNION ALL\n".join(
        f"SELECT {i} AS position, {_q(c)} AS column_name, {_q(t)} AS data_type, count({c}) AS non_null FROM orders"
        for i, (c, t) in enumerate(_order_cols)
    ),
    "table_inventory": "\nUNION ALL\n".join(
        f"SELECT {_q(t)} AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES
    ),
    "distinct_keys": "SELECT DISTINCT user_id FROM events",
    "distinct_time_values": """
SELECT 'o_orderdate' AS column_name, CAST(o_orderdate AS VARCHAR) AS value
FROM (SELECT DISTINCT o_orderdate FROM orders ORDER BY o_orderdate LIMIT 10)""",
    "null_counts": "\nUNION ALL\n".join(
        f"SELECT {_q(c)} AS column_name, count(*) - count({'d.' if c == 'doc_id' else ''}{c}) AS nulls "
        f"FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
        for c in _doc_cols
    ),
    "required_columns": _required,
    "similar_columns": """
SELECT 'key' AS wanted, 'c_custkey' AS candidate, count(c_custkey) AS non_null FROM customer
UNION ALL SELECT 'key', 'c_nationkey', count(c_nationkey) FROM customer
UNION ALL SELECT 'name', 'c_name', count(c_name) FROM customer
UNION ALL SELECT 'seg', 'c_mktsegment', count(c_mktsegment) FROM customer""",
    "date_time_split": "SELECT event_id, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S.%f') AS time_of_day FROM events",
    "epoch_seconds": """
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch_s, date_trunc('second', ts) AS ts_s FROM events""",
    "ingest_stamp": "SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_stamps FROM customer",
    "json_shape_profile": """
SELECT event_id, CAST(len(json_keys(props)) AS BIGINT) AS n_items, array_to_string(json_keys(props), ',') AS keys
FROM events""",
    "json_type_profile": """
SELECT event_type, e.key AS key, CASE json_type(e.value) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
         WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS json_type,
       count(*) AS n
FROM events, UNNEST(map_entries(CAST(CAST(props AS JSON) AS MAP(VARCHAR, JSON)))) AS u(e) GROUP BY ALL""",
    "text_shape_profile": f"""
SELECT doc_id, CAST(strlen(text) AS BIGINT) AS n_bytes, CAST({_lines} AS BIGINT) AS n_lines,
       ({_lines}) = 1 AS single_line, substr(text, 1, 200) AS head
FROM documents""",
    "price_label": "SELECT o_orderkey, concat('$', format('{:,.2f}', o_totalprice)) AS label FROM orders",
    "asset_labels": f"""
SELECT event_type, CASE event_type {_label_case} END AS label, CASE event_type {_code_case} END AS code,
       count(*) AS n_events
FROM events GROUP BY event_type""",
    "state_counts": """
SELECT nullif(o_orderstatus, 'P') AS state, count(nullif(o_orderstatus, 'P')) AS n FROM orders GROUP BY 1""",
    "state_counts_filled": f"""
WITH c AS (SELECT nullif(o_orderstatus, 'P') AS state, count(nullif(o_orderstatus, 'P')) AS n FROM orders GROUP BY 1)
SELECT state, n FROM c
UNION ALL
SELECT s, CAST(0 AS BIGINT) FROM (VALUES {_known}) k(s) WHERE s NOT IN (SELECT state FROM c WHERE state IS NOT NULL)""",
    "metric_lines": """
SELECT state, n, 'airflow_dag_run_count{state="' || coalesce(state, 'None') || '"} ' || CAST(n AS VARCHAR) AS line
FROM (SELECT nullif(o_orderstatus, 'P') AS state, count(nullif(o_orderstatus, 'P')) AS n FROM orders GROUP BY 1)""",
    "metric_exposition": """
WITH c AS (SELECT nullif(o_orderstatus, 'P') AS state, count(nullif(o_orderstatus, 'P')) AS n FROM orders GROUP BY 1),
t AS (SELECT unnest(['success','running','failed','up_for_retry','upstream_failed','skipped','up_for_reschedule','queued','scheduled']) AS state)
SELECT 'airflow_dag_run_count' AS metric, CAST(0 AS BIGINT) AS line_no, '# HELP airflow_dag_run_count Number of runs by state' AS line
UNION ALL SELECT 'airflow_dag_run_count', 1, '# TYPE airflow_dag_run_count gauge'
UNION ALL SELECT 'airflow_dag_run_count', 1 + row_number() OVER (ORDER BY state NULLS LAST),
       'airflow_dag_run_count{state="' || coalesce(state, 'None') || '"} ' || CAST(n AS VARCHAR) FROM c
UNION ALL SELECT 'airflow_task_instance_count', 0, '# HELP airflow_task_instance_count Number of tasks by state'
UNION ALL SELECT 'airflow_task_instance_count', 1, '# TYPE airflow_task_instance_count gauge'
UNION ALL SELECT 'airflow_task_instance_count', 1 + row_number() OVER (ORDER BY state),
       'airflow_task_instance_count{state="' || state || '"} 0' FROM t""",
    "counter_rate": """
WITH s AS (
  SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start, CAST(event_id % 1000 AS DOUBLE) AS c,
         lag(CAST(event_id % 1000 AS DOUBLE)) OVER (PARTITION BY event_type, time_bucket(INTERVAL 5 MINUTE, ts) ORDER BY ts, event_id) AS prev
  FROM events)
SELECT event_type, window_start,
       round(sum(CASE WHEN prev IS NULL THEN NULL WHEN c >= prev THEN c - prev ELSE c END) / 300.0, 6) AS rate,
       count(*) AS n_samples
FROM s GROUP BY 1, 2""",
    "sliding_rate": """
WITH s AS (
  SELECT event_type, event_id, ts, CAST(event_id % 1000 AS DOUBLE) AS c,
         unnest(range(CAST(ceil(epoch_us(ts) / 60000000) AS BIGINT), CAST(ceil(epoch_us(ts) / 60000000) AS BIGINT) + 5)) AS e
  FROM events),
d AS (SELECT *, lag(c) OVER (PARTITION BY event_type, e ORDER BY ts, event_id) AS prev FROM s)
SELECT event_type, make_timestamp(e * 60000000) AS step_ts, count(*) AS n_samples,
       round(sum(CASE WHEN prev IS NULL THEN NULL WHEN c >= prev THEN c - prev ELSE c END) / 300.0, 6) AS rate
FROM d GROUP BY event_type, e HAVING count(*) > 1""",
    "instant_values": """
SELECT event_type, make_timestamp(e * 30000000) AS step_ts, value, ts AS sample_ts FROM (
  SELECT event_type, event_id, ts, value,
         unnest(range(CAST(ceil(epoch_us(ts) / 30000000) AS BIGINT), CAST(ceil(epoch_us(ts) / 30000000) AS BIGINT) + 10)) AS e
  FROM events)
QUALIFY row_number() OVER (PARTITION BY event_type, e ORDER BY ts DESC, event_id DESC) = 1""",
    "alert_changes": f"""
WITH v AS (
  SELECT event_type, e, value FROM (
    SELECT event_type, event_id, ts, value,
           unnest(range(CAST(ceil(epoch_us(ts) / 30000000) AS BIGINT), CAST(ceil(epoch_us(ts) / 30000000) AS BIGINT) + 4)) AS e
    FROM events)
  QUALIFY row_number() OVER (PARTITION BY event_type, e ORDER BY ts DESC, event_id DESC) = 1),
g AS (SELECT event_type, e, e - row_number() OVER (PARTITION BY event_type ORDER BY e) AS grp FROM v WHERE value > {THRESHOLD}),
r AS (SELECT event_type, min(e) AS a, max(e) AS b FROM g GROUP BY event_type, grp)
SELECT event_type, make_timestamp(a * 30000000) AS step_ts, 'pending' AS state FROM r
UNION ALL SELECT event_type, make_timestamp((a + 4) * 30000000), 'firing' FROM r WHERE a + 4 <= b
UNION ALL SELECT event_type, make_timestamp((b + 1) * 30000000), 'inactive' FROM r""",
    "label_select": "SELECT event_id, ts, value FROM events WHERE event_type = 'click'",
    "sustained_threshold": f"""
WITH s AS (
  SELECT event_type, ts, value > {THRESHOLD} AS above,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id)
       - row_number() OVER (PARTITION BY event_type, value > {THRESHOLD} ORDER BY ts, event_id) AS grp
  FROM events)
SELECT event_type, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_samples
FROM s WHERE above GROUP BY event_type, grp
HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 300000000""",
    "sustained_threshold_gap": """
WITH s AS (
  SELECT CASE WHEN event_type NOT IN ('click', 'view') THEN event_type END AS label, event_id, ts, value > 50.0 AS above FROM events),
m AS (
  SELECT *, CASE WHEN above AND lag(above) OVER w AND epoch_us(ts) - epoch_us(lag(ts) OVER w) <= 240000000 THEN 0 ELSE 1 END AS starts
  FROM s WINDOW w AS (PARTITION BY label ORDER BY ts, event_id)),
g AS (SELECT *, sum(starts) OVER (PARTITION BY label ORDER BY ts, event_id) AS run FROM m)
SELECT label, min(ts) AS start_ts, max(ts) AS end_ts, count(*) AS n_samples
FROM g WHERE above GROUP BY label, run HAVING epoch_us(max(ts)) - epoch_us(min(ts)) >= 300000000""",
    "sample_grid": """
SELECT event_type, slot_start, value, n_samples FROM (
  SELECT event_type, time_bucket(INTERVAL 30 SECOND, ts) AS slot_start, value,
         count(*) OVER (PARTITION BY event_type, time_bucket(INTERVAL 30 SECOND, ts)) AS n_samples,
         row_number() OVER (PARTITION BY event_type, time_bucket(INTERVAL 30 SECOND, ts) ORDER BY ts DESC, event_id DESC) AS rn
  FROM events)
WHERE rn = 1""",
    "quarantine": """
SELECT CASE WHEN event_type = 'error' THEN 'not a keyed JSON object' ELSE 'ok' END AS status, count(*) AS n_docs
FROM events GROUP BY 1""",
    "run_report": f"""
SELECT 'chart' AS kind, (SELECT count(*) FROM (SELECT DISTINCT event_type, CAST(ts AS DATE), event_id // {CHART_CHUNK} FROM events)) AS n_files,
       (SELECT count(*) FROM {CHART_EVENTS}) AS n_rows, CAST(0 AS BIGINT) AS n_bad, 'ok' AS status
UNION ALL SELECT 'spot', (SELECT count(*) FROM (SELECT DISTINCT event_id // {SPOT_CHUNK} FROM events)),
       (SELECT count(*) FROM {SPOT_QUOTES}), 0, 'ok'
UNION ALL SELECT 'catalog', (SELECT count(*) FROM (SELECT DISTINCT c_custkey // {CATALOG_CHUNK} FROM customer)),
       (SELECT count(*) FROM customer), 0, 'ok'
UNION ALL SELECT 'unrecognised', (SELECT count(*) FROM pages), 0, 0, 'skipped'""",
    "feed_damage": FEED_DAMAGE,
    "quarantine_history": f"SELECT * FROM ({FEED_DAMAGE}) WHERE what <> 'rows'",
    "latest_landed_file": f"""
WITH f AS (
  SELECT 'chart' AS kind, date_trunc('second', max(ts)) AS s,
         'market_chart_' || event_type || '_' || strftime(max(ts), '%Y%m%d_%H%M%S') || '.json' AS file_name
  FROM events GROUP BY event_type, CAST(ts AS DATE), event_id // {CHART_CHUNK}
  UNION ALL SELECT 'spot', date_trunc('second', max(ts)), 'simple_price_' || strftime(max(ts), '%Y%m%d_%H%M%S') || '.json'
  FROM events GROUP BY event_id // {SPOT_CHUNK}
  UNION ALL SELECT 'catalog', TIMESTAMP '2025-01-01', 'coins_list_20250101_000000.json' FROM customer
  UNION ALL SELECT 'unrecognised', TIMESTAMP '1970-01-01', 'page_' || CAST(page_id AS VARCHAR) || '.html' FROM pages)
SELECT kind, max_by(file_name, (s, file_name)) AS file_name FROM f GROUP BY kind""",
    "newest_landed_file": f"""
WITH f AS (
  SELECT max(ts) AS last, sum((SELECT count(*) FROM {SPOT_QUOTES} q WHERE q.coin_id = CAST(event_id AS VARCHAR))) AS n_rows
  FROM events GROUP BY event_id // {SPOT_CHUNK})
SELECT 'spot' AS kind, 'simple_price_' || strftime(max(last), '%Y%m%d_%H%M%S') || '.json' AS file_name,
       CAST(max_by(n_rows, last) AS BIGINT) AS n_rows FROM f
UNION ALL SELECT 'catalog', strftime(TIMESTAMP '2025-01-01' + to_seconds(c_custkey // {CATALOG_CHUNK}), 'coins_list_%Y%m%d_%H%M%S.json'), count(*)
FROM customer WHERE c_custkey // {CATALOG_CHUNK} = (SELECT max(c_custkey // {CATALOG_CHUNK}) FROM customer)
GROUP BY c_custkey // {CATALOG_CHUNK}""",
    "ingest_two_runs": f"""
WITH d AS (SELECT *, date_trunc('second', max(ts) OVER (PARTITION BY event_type, CAST(ts AS DATE), event_id // {CHART_CHUNK})) AS s FROM events),
m AS (SELECT event_type, CAST(epoch_us({MS}) AS VARCHAR) AS item, s, value, CAST(user_id AS DOUBLE) AS volume FROM d)
SELECT 'chart_prices' AS table_name, event_type AS coin_id, item, max_by(value, (s, value)) AS value
FROM m WHERE item IS NOT NULL AND value IS NOT NULL GROUP BY event_type, item
UNION ALL SELECT 'chart_volumes', event_type, item, max_by(volume, (s, volume))
FROM m WHERE item IS NOT NULL AND volume IS NOT NULL GROUP BY event_type, item
UNION ALL SELECT 'spot', * FROM {SPOT_QUOTES}
UNION ALL SELECT 'spot_latest', * FROM {SPOT_QUOTES}""",
    "landing_batches": f"""
SELECT 'chart_prices' AS table_name, event_type AS coin_id, CAST(epoch_us({MS}) AS VARCHAR) AS item, value FROM {CHART_EVENTS}
UNION ALL SELECT 'chart_volumes', event_type, CAST(epoch_us({MS}) AS VARCHAR), CAST(user_id AS DOUBLE)
FROM events WHERE ts IS NOT NULL AND user_id IS NOT NULL
UNION ALL SELECT 'spot', * FROM {SPOT_QUOTES}
UNION ALL SELECT 'catalog', CAST(c_custkey AS VARCHAR), c_mktsegment, NULL FROM customer""",
    "landed_file_stream": f"SELECT * FROM {SPOT_QUOTES}",
    "nested_tables": f"""
SELECT 'market/charts/all/prices' AS table_name, count(*) AS n_rows FROM ({CHART_POINTS})
UNION ALL SELECT 'market/parties', count(*) FROM supplier
UNION ALL SELECT 'nation', count(*) FROM nation""",
    "stream_ingest": "SELECT event_type, count(*) AS n_events FROM events GROUP BY 1",
    "stream_dedup": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1",
}
