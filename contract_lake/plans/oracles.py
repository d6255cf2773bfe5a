"""DuckDB oracle SQL for the registered queries (same column names).

Written against the semantics the Spark side states, with engine differences
spelled out: DuckDB ``trim`` strips more than spaces, so the oracle trims
``' '`` only; DuckDB rounds when casting a fraction to an integer, so the
oracle truncates first.
"""

from __future__ import annotations

KEYED_DOCS = """kd AS (
  SELECT CASE WHEN doc_id % 7 = 0 THEN NULL
              WHEN doc_id % 11 = 0 THEN '  '
              WHEN doc_id % 13 = 0 THEN ''
              ELSE CAST(doc_id AS VARCHAR) END AS feature_id,
         doc_id, lang, source, n_chars
  FROM documents)"""

DOC_OK = "(feature_id IS NOT NULL AND trim(feature_id, ' ') != '')"

EVENT_ROWS = """ev AS (
  SELECT CAST(event_id AS VARCHAR) AS feature_id, user_id, event_type, ts, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS note
  FROM events)"""

DOC_MANIFEST = """m AS (
  SELECT source AS dataset, 'doc_' || CAST(doc_id AS VARCHAR) || '.json' AS path,
         'part_' || CAST(doc_id % 50 AS VARCHAR) || '.json' AS name,
         n_chars AS size, sha256(text) AS content_hash
  FROM documents)"""

ORDER_MANIFEST = """m AS (
  SELECT o_orderpriority AS dataset, 'order_' || CAST(o_orderkey AS VARCHAR) || '.json' AS path,
         'order_' || CAST(o_orderkey AS VARCHAR) || '.json' AS name,
         CAST(trunc(o_totalprice) AS BIGINT) AS size, o_orderdate AS modified_at,
         CAST(trunc(date_diff('second', o_orderdate, TIMESTAMP '1998-01-01 00:00:00') / 86400.0) AS BIGINT) AS age_days
  FROM orders)"""

LOG_ROWS = """lg AS (
  SELECT CASE WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
              ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS timestamp,
         CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING'
                         WHEN 'view' THEN 'DEBUG' ELSE 'INFO' END AS level,
         'events' AS logger,
         event_type || ' by user ' || CAST(user_id AS VARCHAR) AS message,
         'ingest' AS notebook,
         'job-' || CAST(user_id % 10 AS VARCHAR) AS job_id,
         coalesce(CASE WHEN event_id % 2 = 0 THEN 'parent-' || CAST(user_id AS VARCHAR) END,
                  'run-' || CAST(event_id AS VARCHAR)) AS run_id,
         event_type AS task_id
  FROM events)"""


def scd2_sql(source: str, key: str, seq: str, ties: list[str], track: str | None,
             delete: str | None, cols: list[str], where: str = "", ctes: str = "") -> str:
    """SCD Type 2 with window functions: ties keep the last row, a run of
    equal tracked values is one version carrying its last row's values,
    tombstones close the open version."""
    order = ", ".join([seq] + ties)
    is_del = f"coalesce({delete}, false)" if delete else "false"
    trk = track or "NULL"

    def differs(other: str) -> str:
        return "true" if track is None else f"({other} IS DISTINCT FROM {trk})"

    head = f"WITH {ctes + ',' if ctes else ''}"
    return f"""{head}
s AS (SELECT *, {is_del} AS _del,
             lead({seq}) OVER (PARTITION BY {key} ORDER BY {order}) AS _nx
      FROM {source} WHERE {seq} IS NOT NULL),
d AS (SELECT * FROM s WHERE _nx IS NULL OR _nx <> {seq}),
n AS (SELECT *, row_number() OVER w AS _rn, lag(_del) OVER w AS _p_del, lag({trk}) OVER w AS _p_trk,
             lead({seq}) OVER w AS _n_seq, lead(_del) OVER w AS _n_del, lead({trk}) OVER w AS _n_trk
      FROM d WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
c AS (SELECT *, (_rn = 1 OR _del OR _p_del OR {differs('_p_trk')}) AS _chg,
                (_n_seq IS NULL OR _n_del OR _del OR {differs('_n_trk')}) AS _end
      FROM n),
r AS (SELECT *, max(CASE WHEN _chg THEN {seq} END) OVER (PARTITION BY {key} ORDER BY {order}
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _from
      FROM c)
SELECT {', '.join(cols)}, _from AS valid_from, _n_seq AS valid_to, _n_seq IS NULL AS is_current
FROM r WHERE _end AND NOT _del {where}"""


EV_COLS = ["user_id", "event_id", "event_type", "value"]
ENTRY_COLS = ["user_id", "feature_id", "event_type", "value", "k"]
AS_OF = "TIMESTAMP '2024-01-15 12:00:00'"

CONTRACT_PROJECTION = f"""WITH {EVENT_ROWS}
SELECT feature_id, user_id, event_type, ts, value, k, note FROM ev"""

ENTRY_HISTORY = scd2_sql("ev", "user_id", "ts", ["feature_id"], "event_type", None, ENTRY_COLS,
                         ctes=EVENT_ROWS)

AS_OF_EACH = f"""
WITH hist AS ({scd2_sql("events", "user_id", "ts", ["event_id"], "event_type", "event_type = 'error'", EV_COLS)}),
probes AS (SELECT event_id AS probe_id, user_id, ts + INTERVAL 1 HOUR * CAST(event_id % 97 - 48 AS INTEGER) AS asked_at FROM events),
met AS (
  SELECT p.*, h.event_id, h.event_type, h.valid_from, h.valid_to, h.event_id IS NOT NULL AND (h.valid_to IS NULL OR p.asked_at < h.valid_to) AS known
  FROM probes p ASOF LEFT JOIN hist h ON p.user_id = h.user_id AND p.asked_at >= h.valid_from)
SELECT probe_id, user_id, asked_at, CASE WHEN known THEN event_id END AS version_event_id, CASE WHEN known THEN event_type END AS version_event_type,
       CASE WHEN known THEN valid_from END AS version_valid_from, CASE WHEN known THEN valid_to END AS version_valid_to
FROM met"""

ORACLES: dict[str, str] = {
    "explode_features": """
SELECT user_id AS doc_user, CAST(event_id AS VARCHAR) AS id, event_type, ts, value FROM events""",

    "flatten_features": """
SELECT CAST(event_id AS VARCHAR) AS id, 'Point' AS type, value AS x, CAST(user_id AS DOUBLE) AS y,
       user_id, event_type, ts, value, props FROM events""",

    "contract_projection": CONTRACT_PROJECTION,

    "typed_casts": """
SELECT user_id, value AS value_double, CAST(value AS FLOAT) AS value_float,
       CAST(trunc(value) AS INTEGER) AS value_int,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_long,
       event_type = 'error' AS is_error, event_type, event_type AS event_type_default,
       CAST(NULL AS INTEGER) AS absent, CAST(NULL AS DOUBLE) AS no_source,
       '' AS cast_failed
FROM events""",

    "tag_changes": """
SELECT CAST(event_id AS VARCHAR) AS id, 'UPDATE' AS change, event_type FROM events""",

    "valid_rows": f"""WITH {KEYED_DOCS}
SELECT * FROM kd WHERE {DOC_OK}""",

    "quarantine_rows": f"""WITH {KEYED_DOCS}
SELECT feature_id, doc_id, 'feature_id IS NOT NULL AND TRIM(feature_id) != ''''' AS validation_rule_failed,
       'valid_id' AS validation_rule_name
FROM kd WHERE NOT coalesce({DOC_OK}, false)""",

    "quality_split_counts": f"""WITH {KEYED_DOCS}
SELECT count(*) AS n_in,
       CAST(sum(CASE WHEN coalesce({DOC_OK}, false) THEN 1 ELSE 0 END) AS BIGINT) AS n_pass,
       CAST(sum(CASE WHEN coalesce({DOC_OK}, false) THEN 0 ELSE 1 END) AS BIGINT) AS n_quarantine
FROM kd""",

    "contract_rule_failures": """
SELECT c_custkey, 'c_custkey_required' AS rule, 'error' AS criticality FROM customer WHERE c_custkey IS NULL
UNION ALL
SELECT c_custkey, 'c_acctbal_range', 'warn' FROM customer
  WHERE NOT (c_acctbal IS NULL OR (c_acctbal >= -500 AND c_acctbal <= 9000))
UNION ALL
SELECT c_custkey, 'c_mktsegment_allowed', 'error' FROM customer
  WHERE NOT (c_mktsegment IS NULL OR c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY'))
UNION ALL
SELECT c_custkey, 'c_name_pattern', 'error' FROM customer
  WHERE NOT (c_name IS NULL OR regexp_matches(c_name, '^Customer#[0-9]{9}$'))
UNION ALL
SELECT c_custkey, 'c_nationkey_range', 'error' FROM customer
  WHERE NOT (c_nationkey IS NULL OR (c_nationkey >= 0 AND c_nationkey <= 20))""",

    "stream_unique": """
        WITH r AS (SELECT o_orderkey, o_custkey, o_orderdate, COUNT(*) OVER w AS n, MIN(o_orderkey) OVER w AS first_key
                   FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
                   WINDOW w AS (PARTITION BY o_custkey, o_orderdate))
        SELECT o_orderkey, o_custkey, o_orderdate, o_orderkey = first_key AS is_first FROM r WHERE n > 1""",
    "unique_failures": """
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE (o_custkey, o_orderdate) IN (SELECT o_custkey, o_orderdate FROM orders
                                   GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)""",

    "cast_failures": """
WITH c AS (
  SELECT count(o_orderkey) AS n_key, count(o_orderstatus) AS n_status,
         count(*) FILTER (WHERE o_orderstatus IS NOT NULL AND upper(trim(o_orderstatus))
             NOT IN ('T', 'TRUE', 'Y', 'YES', '1', 'F', 'FALSE', 'N', 'NO', '0')) AS f_status,
         count(o_totalprice) AS n_price,
         count(*) FILTER (WHERE o_totalprice <> trunc(o_totalprice)) AS f_price, count(o_orderdate) AS n_date, count(o_orderpriority) AS n_prio
  FROM orders)
SELECT 'o_orderkey' AS "column", 'bigint' AS expected_type, 'string' AS actual_type, 'ok' AS issue,
       n_key AS n_present, CAST(0 AS BIGINT) AS n_cast_failed FROM c
UNION ALL SELECT 'o_orderstatus', 'boolean', 'string', CASE WHEN f_status > 0 THEN 'cast_failures' ELSE 'ok' END,
       n_status, f_status FROM c
UNION ALL SELECT 'o_totalprice', 'int', 'string', CASE WHEN f_price > 0 THEN 'cast_failures' ELSE 'ok' END,
       n_price, f_price FROM c
UNION ALL SELECT 'o_orderdate', 'string', 'string', 'unknown_type', n_date, 0 FROM c
UNION ALL SELECT 'o_orderpriority', 'string', 'string', 'ok', n_prio, 0 FROM c
UNION ALL SELECT 'o_clerk', 'string', NULL, 'missing', NULL, NULL FROM c
UNION ALL SELECT 'o_custkey', NULL, 'string', 'extra', NULL, NULL FROM c""",

    "small_files": f"""WITH {DOC_MANIFEST}
SELECT dataset, name, path, size, round(size / 1024.0, 2) AS size_kb FROM m
WHERE round(size / 1024.0, 2) < 2""",

    "duplicate_files": f"""WITH {DOC_MANIFEST}
SELECT dataset, name, count(*) AS n_copies FROM m GROUP BY dataset, name HAVING count(*) > 1""",

    "duplicate_content": f"""WITH {DOC_MANIFEST}
SELECT content_hash, count(*) AS n_copies, count(DISTINCT dataset) AS n_datasets
FROM m GROUP BY content_hash HAVING count(*) > 1""",

    "empty_datasets": """
SELECT dataset FROM (SELECT 'src' || CAST(i AS VARCHAR) AS dataset FROM range(25) t(i))
WHERE dataset NOT IN (SELECT source FROM documents)""",

    "file_metrics": """
SELECT '2024-02-01T00:00:00' AS timestamp, 'completeness' AS metric_type, 'files_in_folder' AS metric_name,
       CAST(count(*) AS DOUBLE) AS value, CAST(1 AS BIGINT) AS expected, 'Count' AS unit,
       source AS dataset, CASE WHEN count(*) = 1 THEN 'success' ELSE 'failure' END AS status
FROM documents GROUP BY source""",

    "stale_files": f"""WITH {ORDER_MANIFEST}
SELECT dataset, name, modified_at, age_days FROM m WHERE age_days > 5""",

    "gate_failures": f"""WITH {ORDER_MANIFEST}
SELECT dataset, name, path, 'small_file' AS "check",
       printf('%.2f KB < %s KB', round(size / 1024.0, 2), '2') AS detail
FROM m WHERE round(size / 1024.0, 2) < 2
UNION ALL
SELECT dataset, name, path, 'stale_file', printf('%d days > %d', age_days, 5) FROM m WHERE age_days > 5
UNION ALL
SELECT dataset, name, NULL, 'duplicate_name', printf('%d copies', count(*)) FROM m
GROUP BY dataset, name HAVING count(*) > 1""",

    "scd2_history": scd2_sql("events", "user_id", "ts", ["event_id"], "event_type", None, EV_COLS),
    "scd2_segmented": scd2_sql("events", "user_id", "ts", ["event_id"], "event_type", None, EV_COLS),
    "scd2_hot_user": scd2_sql(
        "evh", "user_id", "ts", ["event_id"], "event_type", None, EV_COLS,
        ctes="evh AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN CAST(0 AS BIGINT) "
             "ELSE user_id END AS user_id) FROM events)"),
    "scd2_batch_stamp": scd2_sql(
        "evd", "user_id", "batch_day", ["ts", "event_id"], "event_type", None,
        EV_COLS + ["batch_day"],
        ctes="evd AS (SELECT *, CAST(date_trunc('day', ts) AS TIMESTAMP) AS batch_day FROM events)"),
    "scd2_track_all": scd2_sql("events", "user_id", "ts", ["event_id"], None, None, EV_COLS),
    "scd_current": scd2_sql("events", "user_id", "ts", ["event_id"], "event_type", None, EV_COLS,
                            where="AND _n_seq IS NULL"),
    "scd2_as_of": scd2_sql("events", "user_id", "ts", ["event_id"], "event_type", None, EV_COLS,
                           where=f"AND _from <= {AS_OF} AND (_n_seq IS NULL OR {AS_OF} < _n_seq)"),
    "scd2_as_of_each": AS_OF_EACH,
    "scd2_deletes": scd2_sql("events", "user_id", "ts", ["event_id"], None, "event_type = 'error'", EV_COLS),
    "scd2_track_deletes": scd2_sql("events", "user_id", "ts", ["event_id"], "event_type",
                                   "event_type = 'error'", EV_COLS),
    "scd2_bucketed_deletes": scd2_sql("events", "user_id", "ts", ["event_id"], None, "event_type = 'error'",
                                      EV_COLS),
    "scd2_ties": scd2_sql("orders", "o_custkey", "o_orderdate", ["o_orderkey"], None, None,
                          ["o_custkey", "o_orderkey", "o_totalprice"]),
    "entry_history": ENTRY_HISTORY,

    "event_messages": """
SELECT event_id, 'event type: update_progress state: ' ||
       CASE CAST(json_extract_string(props, '$.k') AS INTEGER) % 4
            WHEN 0 THEN 'QUEUED' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'COMPLETED' ELSE 'FAILED' END AS message
FROM events WHERE event_type IN ('view', 'click')""",

    "schema_drift": """
SELECT field, count(*) AS n_docs, field NOT IN ('k') AS is_new
FROM (SELECT unnest(json_keys(props)) AS field FROM events) GROUP BY field""",

    "ops_log_sorted": f"WITH {LOG_ROWS} SELECT * FROM lg",
    "log_level_filter": f"WITH {LOG_ROWS} SELECT * FROM lg WHERE level IN ('WARNING', 'ERROR', 'CRITICAL')",

    # streaming queries: the same results as their batch twins
    "stream_explode": CONTRACT_PROJECTION,
    "scd2_stream": ENTRY_HISTORY,
    "scd2_compacted": ENTRY_HISTORY,
    "scd2_maintained": ENTRY_HISTORY,
    "stream_lines_history": ENTRY_HISTORY,
    "stream_collection_lines": ENTRY_HISTORY,
    "variant_projection": CONTRACT_PROJECTION,
    "stream_quarantine": f"""WITH {KEYED_DOCS}
SELECT feature_id, doc_id, lang, source,
       'feature_id IS NOT NULL AND TRIM(feature_id) != ''''' AS validation_rule_failed,
       'valid_id' AS validation_rule_name, true AS stamped
FROM kd WHERE NOT coalesce({DOC_OK}, false)""",
    "scd2_bursty_user": scd2_sql(
        "evb", "user_id", "ts", ["event_id"], "event_type", None, EV_COLS,
        ctes="evb AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN CAST(0 AS BIGINT) ELSE user_id END AS user_id, "
             "CASE WHEN event_id % 3 = 0 AND event_id % 100 <> 0 "
             "THEN TIMESTAMP '2024-01-10 00:00:00' + to_microseconds(event_id) ELSE ts END AS ts) FROM events)"),
    "batch_inference": """
SELECT CAST(event_id AS VARCHAR) AS id, 'Point' AS type, value AS x, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    "folder_gate": """
WITH f AS (SELECT c_nationkey AS n, sum(length(c_name) + 1) AS size FROM customer GROUP BY 1)
SELECT 'nation' || CAST(n AS VARCHAR) AS dataset, 'small_file' AS "check",
       printf('%.2f KB < %s KB', round(size / 1024.0, 2), '200') AS detail
FROM f WHERE round(size / 1024.0, 2) < 200
UNION ALL
SELECT 'nation' || CAST(i AS VARCHAR), 'unreachable', 'cannot list' FROM range(26) t(i)
WHERE i NOT IN (SELECT n FROM f)""",
    "scd2_maintained_deletes": scd2_sql("ev5", "user_id", "ts", ["feature_id"], "event_type", None, ENTRY_COLS,
                                        ctes=EVENT_ROWS + ", ev5 AS (SELECT * FROM ev WHERE user_id % 5 <> 0)"),
    "changeset_roundtrip": f"""WITH {EVENT_ROWS}
SELECT feature_id, user_id, event_type, value, k, 'UPDATE' AS change FROM ev""",
    "stream_whole_files": ENTRY_HISTORY,
    "collection_lines_mixed": """
SELECT CAST(event_id AS VARCHAR) AS feature_id,
       CASE WHEN (event_id // 256) % 4 = 3 THEN 'quarantined' ELSE 'landed' END AS status FROM events""",
    "scd2_processing_time": """
WITH r AS (
  SELECT CAST(event_id // 4096 AS VARCHAR) || '-' || CAST(user_id AS VARCHAR) AS doc_key, event_id, event_type, value,
         row_number() OVER (PARTITION BY event_id // 4096, user_id ORDER BY event_id DESC) AS n
  FROM events)
SELECT reader, doc_key, CAST(event_id AS VARCHAR) AS feature_id, event_type, value, true AS is_current
FROM r, (VALUES ('whole'), ('lines')) v(reader) WHERE n = 1""",
    "stream_evolved_contract": scd2_sql(
        "eve", "user_id", "ts", ["feature_id"], "event_type", None, ENTRY_COLS,
        ctes=EVENT_ROWS + ", eve AS (SELECT * REPLACE (CASE WHEN user_id % 2 = 1 THEN value END AS value, "
                          "CASE WHEN user_id % 2 = 1 THEN k END AS k) FROM ev)"),
    "run_all_history": f"""
SELECT 'events' AS entry, CAST(user_id AS VARCHAR) AS key, event_type AS label, feature_id, is_current FROM ({ENTRY_HISTORY})
UNION ALL
SELECT 'documents', feature_id, lang, feature_id, true FROM (WITH {KEYED_DOCS} SELECT * FROM kd WHERE {DOC_OK})""",
    "ingest_counts": """
SELECT 'rows_in' AS metric_name, count(*) AS total FROM events
UNION ALL SELECT 'rows_passed', count(*) FROM events
UNION ALL SELECT 'rows_failed', count(*) FILTER (WHERE false) FROM events""",
    "variant_drift": """
SELECT field, count(*) AS n_docs, field NOT IN ('event_type', 'props', 'ts', 'user_id') AS is_new
FROM (SELECT unnest(['user_id', 'event_type', 'ts', 'value', 'props']) AS field FROM events)
GROUP BY field""",
}
