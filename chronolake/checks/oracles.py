"""The same results in plain SQL over the given tables, for an independent engine."""

from __future__ import annotations

_EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k,
         (epoch_us(ts) // 1000) AS ts_ms,
         make_timestamp(((epoch_us(ts) // 1000) + event_id % 5000) * 1000) AS processed_at,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op0
  FROM events
)"""


def _log(damaged: bool) -> str:
    """CTE ``lg``: the parsed log."""

    def broken(rest: int, value: str, otherwise: str) -> str:
        return f"CASE WHEN event_id % 50 = {rest} THEN {value} ELSE {otherwise} END" if damaged else otherwise

    op = f"CASE WHEN event_id % 50 = 7 THEN NULL WHEN event_id % 50 = 17 THEN 'x' ELSE op0 END" if damaged else "op0"
    after_text = """CASE WHEN op0 <> 'd' THEN '{"id":' || user_id || ',"status":"' || event_type || '","amount":'
        || CAST(value AS VARCHAR) || ',"k":' || k || '}' END"""
    before_text = """CASE WHEN op0 = 'd' THEN '{"id":' || user_id || '}' END"""
    lost = "CASE WHEN event_id % 50 = 47 THEN NULL ELSE {0} END" if damaged else "{0}"
    not_json = "CASE WHEN event_id % 50 = 47 THEN 'not json' ELSE {0} END" if damaged else "{0}"
    whole = """'{"before":' || coalesce(before_j, 'null') || ',"after":' || coalesce(after_j, 'null')
      || ',"op":' || coalesce('"' || op || '"', 'null') || ',"ts_ms":' || ts_ms
      || ',"source":{"db":"shop","schema":"public","table":' || coalesce('"' || tab || '"', 'null')
      || ',"lsn":' || event_id || ',"txId":null}}'"""
    return f"""{_EVENTS},
im AS (
  SELECT *, {op} AS op, {broken(27, "NULL", "'users'")} AS tab,
         {broken(37, "NULL", after_text)} AS after_j, {broken(37, "NULL", before_text)} AS before_j
  FROM ev
),
lg AS (
  SELECT 'cdc.public.users' AS topic, CAST(user_id % 3 AS INTEGER) AS kafka_partition,
         event_id AS kafka_offset, ts AS kafka_timestamp, CAST(user_id AS VARCHAR) AS record_key,
         {not_json.format(whole)} AS raw_value,
         {lost.format("op")} AS operation, {lost.format("before_j")} AS before_json,
         {lost.format("after_j")} AS after_json, {lost.format("'shop'")} AS source_db,
         {lost.format("'public'")} AS source_schema, {lost.format("tab")} AS source_table,
         {lost.format("event_id")} AS pg_lsn, CAST(NULL AS BIGINT) AS pg_tx_id,
         {lost.format("ts_ms")} AS source_ts_ms, processed_at,
         'cdc.public.users-' || (user_id % 3) || '-' || event_id AS event_id,
         {lost.format("event_id")} AS _cdc_order_lsn
  FROM im
)"""


_CLASSES = """
cl AS (
  SELECT *, CASE WHEN operation IS NULL THEN 'NULL_OPERATION'
                 WHEN operation NOT IN ('c', 'u', 'd') THEN 'INVALID_OPERATION'
                 WHEN source_table IS NULL THEN 'NULL_TABLE'
                 WHEN before_json IS NULL AND after_json IS NULL THEN 'EMPTY_PAYLOAD' END AS error_type
  FROM lg
)"""

_DAMAGED = f"WITH {_log(True)},{_CLASSES}"

# Decoded rows with id and status, and their content hash.
_ROWS = f"""{_EVENTS},
rw AS (
  SELECT user_id AS id, CASE WHEN op0 = 'd' THEN NULL ELSE event_type END AS status, op0 <> 'd' AS is_active,
         op0 AS operation, ts_ms AS source_ts_ms, processed_at, CAST(user_id % 3 AS INTEGER) AS kafka_partition,
         event_id AS kafka_offset, event_id AS pg_lsn, ts,
         sha256(CAST(user_id AS VARCHAR) || '||' || CASE WHEN op0 = 'd' THEN 'NULL||false' ELSE event_type || '||true' END) AS _hash
  FROM ev
)"""

_HISTORY = f"""{_ROWS},
st AS (
  SELECT *, CASE WHEN operation = 'd' THEN '' ELSE _hash END AS state FROM rw
),
ch AS (
  SELECT * FROM (
    SELECT *, lag(state) OVER (PARTITION BY id ORDER BY pg_lsn, source_ts_ms, kafka_offset) AS prev FROM st)
  WHERE state <> coalesce(prev, '')
),
nx AS (
  SELECT *, lead(operation) OVER w AS n_op, lead(pg_lsn) OVER w AS n_lsn, lead(source_ts_ms) OVER w AS n_ms,
         lead(kafka_offset) OVER w AS n_off
  FROM ch WINDOW w AS (PARTITION BY id ORDER BY pg_lsn, source_ts_ms, kafka_offset)
),
hs AS (
  SELECT id, status, coalesce(n_op <> 'd', true) AS is_active, operation, pg_lsn,
         make_timestamp(source_ts_ms * 1000) AS _valid_from, make_timestamp(n_ms * 1000) AS _valid_to,
         n_op IS NULL AS _is_current, _hash, n_lsn AS _close_lsn, n_ms AS _close_ts_ms, n_off AS _close_offset
  FROM nx WHERE operation <> 'd'
)"""


def _latest(source: str, condition: str) -> str:
    return f"""SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY pg_lsn DESC, source_ts_ms DESC, kafka_offset DESC) AS rn
      FROM {source} WHERE {condition}) WHERE rn = 1"""


_STEPS = f"""{_ROWS},
b1 AS ({_latest("rw", "ts < TIMESTAMP '2024-01-16'")}),
op AS (SELECT * FROM b1 WHERE operation <> 'd'),
fe AS (SELECT id, pg_lsn AS f_lsn FROM b1 WHERE operation = 'd'),
b2 AS ({_latest("rw", "source_ts_ms > (SELECT max(source_ts_ms) FROM op) - 86400000")}),
pa AS (
  SELECT coalesce(op.id, b2.id) AS id,
         CASE WHEN b2.id IS NULL THEN 'KEEP'
              WHEN op.id IS NULL AND b2.operation = 'd' THEN 'SKIP'
              WHEN op.id IS NULL AND b2.pg_lsn <= fe.f_lsn THEN 'SKIP'
              WHEN op.id IS NULL THEN 'INSERT'
              WHEN b2.pg_lsn <= op.pg_lsn THEN 'SKIP'
              WHEN b2.operation = 'd' THEN 'CLOSE'
              WHEN b2._hash = op._hash THEN 'TOUCH'
              ELSE 'CLOSE_AND_INSERT' END AS action
  FROM op FULL OUTER JOIN b2 ON op.id = b2.id LEFT JOIN fe ON fe.id = b2.id
),
mg AS (
  SELECT op.id, op.status, a.action <> 'CLOSE' AS is_active, op.operation,
         CASE WHEN a.action = 'TOUCH' THEN b2.source_ts_ms ELSE op.source_ts_ms END AS source_ts_ms,
         CASE WHEN a.action = 'TOUCH' THEN b2.processed_at ELSE op.processed_at END AS processed_at,
         CASE WHEN a.action = 'TOUCH' THEN b2.kafka_partition ELSE op.kafka_partition END AS kafka_partition,
         CASE WHEN a.action = 'TOUCH' THEN b2.kafka_offset ELSE op.kafka_offset END AS kafka_offset,
         CASE WHEN a.action = 'TOUCH' THEN b2.pg_lsn ELSE op.pg_lsn END AS pg_lsn,
         TIMESTAMP '2024-01-16' AS _valid_from,
         CASE WHEN a.action LIKE 'CLOSE%' THEN TIMESTAMP '2024-02-01' END AS _valid_to,
         a.action NOT LIKE 'CLOSE%' AS _is_current, op._hash,
         CASE WHEN a.action = 'TOUCH' THEN b2.pg_lsn ELSE op.pg_lsn END AS _cdc_order_lsn,
         CASE WHEN a.action LIKE 'CLOSE%' THEN b2.pg_lsn END AS _close_lsn,
         CASE WHEN a.action LIKE 'CLOSE%' THEN b2.source_ts_ms END AS _close_ts_ms,
         CASE WHEN a.action LIKE 'CLOSE%' THEN b2.kafka_offset END AS _close_offset
  FROM pa a JOIN op ON op.id = a.id LEFT JOIN b2 ON b2.id = a.id
  UNION ALL
  SELECT b2.id, b2.status, true, b2.operation, b2.source_ts_ms, b2.processed_at, b2.kafka_partition,
         b2.kafka_offset, b2.pg_lsn, TIMESTAMP '2024-02-01', NULL, true, b2._hash, b2.pg_lsn, NULL, NULL, NULL
  FROM pa a JOIN b2 ON b2.id = a.id WHERE a.action IN ('INSERT', 'CLOSE_AND_INSERT')
)"""

# The same with runs that read by delivery: the second reads what the first hasn't.
_TABLE_STEPS = _STEPS.replace(
    "source_ts_ms > (SELECT max(source_ts_ms) FROM op) - 86400000", "ts >= TIMESTAMP '2024-01-16'"
)

# The first batch as complete history instead of one run.
_REBUILT = (
    _HISTORY.replace("st AS (", "early AS (SELECT * FROM rw WHERE ts < TIMESTAMP '2024-01-16'),\nst AS (").replace(
        "AS state FROM rw", "AS state FROM early"
    )
    + """,
op AS (SELECT rw.*, hs._valid_from AS since FROM hs JOIN rw USING (pg_lsn) WHERE hs._is_current),
fe AS (SELECT id, max(pg_lsn) AS f_lsn FROM early WHERE operation = 'd' GROUP BY id),
b2 AS"""
    + _TABLE_STEPS.split("b2 AS", 1)[1].replace("TIMESTAMP '2024-01-16' AS _valid_from", "op.since AS _valid_from")
)

_FACTS = """
f AS (
  SELECT user_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS product_id,
         value AS total_amount, ts AS happened
  FROM events WHERE event_type = 'purchase'
)"""

_ORDERS_H = """
f AS (SELECT o_custkey AS user_id, o_totalprice AS total_amount, o_orderdate AS happened FROM orders)"""

_LINES_H = """
f AS (
  SELECT o_custkey AS user_id, l_partkey AS product_id, l_extendedprice AS total_amount, o_orderdate AS happened
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_CENTS = "sum(CAST(round(total_amount * 100) AS BIGINT))"


def _user_mart(facts: str, today: str, vip: int, loyal: int, frequent: int) -> str:
    return f"""WITH {facts},
s AS (
  SELECT user_id, count(*) AS n, CAST({_CENTS} AS DOUBLE) / 100.0 AS spent, max(happened) AS last_at FROM f GROUP BY user_id
)
SELECT c_custkey AS user_id, c_name AS full_name, 'n' || c_nationkey || '.example.com' AS email_domain,
       '2024-01-01' AS registration_date, coalesce(n, 0) AS total_orders, coalesce(spent, 0.0) AS total_spent,
       coalesce(spent / n, 0.0) AS avg_order_value, last_at AS last_order_date,
       CAST(date_diff('day', CAST(last_at AS DATE), DATE '{today}') AS INTEGER) AS recency_days,
       CASE WHEN coalesce(spent, 0) > {vip} THEN 'VIP' WHEN coalesce(spent, 0) > {loyal} THEN 'Loyal'
            WHEN coalesce(n, 0) > {frequent} THEN 'Frequent' ELSE 'New' END AS segment,
       TIMESTAMP '2024-02-01' AS refresh_date
FROM customer LEFT JOIN s ON c_custkey = s.user_id"""


def _product_mart(facts: str, today: str, star: int, good: int, average: int) -> str:
    return f"""WITH {facts},
s AS (
  SELECT product_id, count(*) AS n, CAST({_CENTS} AS DOUBLE) / 100.0 AS revenue,
         CAST(sum(CASE WHEN date_diff('day', CAST(happened AS DATE), DATE '{today}') <= 30
                       THEN CAST(round(total_amount * 100) AS BIGINT) END) AS DOUBLE) / 100.0 AS recent,
         count(DISTINCT user_id) AS customers
  FROM f GROUP BY product_id
)
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS price,
       coalesce(n, 0) AS total_orders, coalesce(revenue, 0.0) AS total_revenue, coalesce(customers, 0) AS unique_customers,
       coalesce(recent, 0.0) AS revenue_last_30d,
       CASE WHEN coalesce(revenue, 0) > {star} THEN 'Star' WHEN coalesce(revenue, 0) > {good} THEN 'Good'
            WHEN coalesce(revenue, 0) > {average} THEN 'Average' ELSE 'Low' END AS performance_tier,
       TIMESTAMP '2024-02-01' AS refresh_date
FROM part LEFT JOIN s ON p_partkey = s.product_id"""


_DAYS = f"""
d AS (SELECT strftime(happened, '%Y-%m-%d') AS order_date, user_id, product_id, total_amount FROM f),
p AS (SELECT order_date, product_id, count(*) AS n, {_CENTS} AS cents FROM d GROUP BY 1, 2),
t AS (
  SELECT order_date, product_id FROM (
    SELECT *, row_number() OVER (PARTITION BY order_date ORDER BY cents DESC, product_id ASC) AS rn FROM p)
  WHERE rn = 1
)"""


def _daily_mart(facts: str) -> str:
    return f"""WITH {facts},{_DAYS},
a AS (
  SELECT order_date, count(*) AS n, CAST({_CENTS} AS DOUBLE) / 100.0 AS revenue, count(DISTINCT user_id) AS customers
  FROM d GROUP BY order_date
)
SELECT a.order_date AS date_key, n AS total_orders, revenue AS total_revenue, revenue / n AS avg_order_value,
       customers AS unique_customers, coalesce(t.product_id, 0) AS top_product_id, TIMESTAMP '2024-02-01' AS refresh_date
FROM a LEFT JOIN t ON t.order_date = a.order_date"""


# Order lines after the three steps of the incremental marts.
_CHANGED_LINES = """
f AS (
  SELECT o_custkey AS user_id, l_partkey AS product_id,
         CASE WHEN l_orderkey % 10 = 0 THEN l_extendedprice * 2 ELSE l_extendedprice END AS total_amount,
         CAST(CASE WHEN l_orderkey % 10 = 0 THEN o_orderdate - INTERVAL 12 MONTH ELSE o_orderdate END AS TIMESTAMP) AS happened
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_orderkey % 7 <> 0
)"""


# Current orders after two runs; an order is dated by the run that wrote its version.
_SHOP_ORDERS = """
f AS (
  SELECT user_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS product_id,
         CASE WHEN ts < TIMESTAMP '2024-01-16' AND event_id % 10 = 0 THEN value * 2 ELSE value END AS total_amount,
         CASE WHEN ts < TIMESTAMP '2024-01-16' AND event_id % 10 <> 0 THEN TIMESTAMP '2024-01-16'
              ELSE TIMESTAMP '2024-02-01' END AS happened
  FROM events WHERE event_type = 'purchase' AND NOT (ts < TIMESTAMP '2024-01-16' AND event_id % 7 = 0)
)"""


def _marts_as_text(users: str, products: str, days: str) -> str:
    return f"""SELECT 'users' AS mart, CAST(user_id AS VARCHAR) AS subject, total_orders, CAST(round(total_spent * 100) AS BIGINT) AS cents,
       segment AS label, strftime(last_order_date, '%Y-%m-%d') AS extra FROM ({users})
UNION ALL
SELECT 'products', CAST(product_id AS VARCHAR), total_orders, CAST(round(total_revenue * 100) AS BIGINT), performance_tier,
       CAST(CAST(round(revenue_last_30d * 100) AS BIGINT) AS VARCHAR) FROM ({products})
UNION ALL
SELECT 'days', date_key, total_orders, CAST(round(total_revenue * 100) AS BIGINT), CAST(top_product_id AS VARCHAR),
       CAST(unique_customers AS VARCHAR) FROM ({days})"""


_GOOD_COLUMNS = "event_id, operation, source_table, before_json, after_json, source_ts_ms"

_DLQ_COLUMNS = "topic, kafka_partition, kafka_offset, raw_value, error_type"

_CUSTOMER_JSON = """'{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
    || ',"c_acctbal":' || CAST(c_acctbal AS VARCHAR) || ',"c_mktsegment":"' || c_mktsegment || '"}'"""

_HEALTH = """
pt AS (SELECT user_id, event_type, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2),
ps AS (
  SELECT *, CASE WHEN value < 5 THEN 'FAILED' WHEN value < 10 THEN 'PAUSED' ELSE 'RUNNING' END AS state FROM pt
),
hl AS (
  SELECT 'connector-' || user_id AS connector,
         coalesce(max(state) FILTER (event_type = 'error'), 'RUNNING') AS connector_state,
         CAST(count(*) FILTER (state = 'RUNNING') AS INTEGER) AS tasks_running,
         CAST(count(*) FILTER (state = 'FAILED') AS INTEGER) AS tasks_failed
  FROM ps GROUP BY user_id
)"""


# Queries that reach another one's result by another way.
_SAME_AS = {
    "snapshot_diff_pruned": "snapshot_diff",
    "log_table_scan": "stream_bronze",
    "log_compacted": "stream_bronze",
    "stream_dedup_late_copy": "stream_bronze",
    "dq_scd2_invariants_hot": "dq_scd2_invariants",
}


def sql() -> dict[str, str]:
    found = _sql()
    return {**found, **{name: found[other] for name, other in _SAME_AS.items()}}


def _sql() -> dict[str, str]:
    user_mart = _user_mart(_FACTS, "2024-01-31", 1000, 500, 5)
    product_mart = _product_mart(_FACTS, "2024-01-31", 10_000, 5_000, 1_000)
    daily_mart = _daily_mart(_FACTS)
    deduped = f"WITH {_log(False)} SELECT event_id, kafka_offset, raw_value FROM lg"
    return {
        "parse_envelope": f"WITH {_log(False)} SELECT * FROM lg",
        "validate_split": f"{_DAMAGED} SELECT {_GOOD_COLUMNS} FROM cl WHERE error_type IS NULL",
        "dlq_errors": f"{_DAMAGED} SELECT {_DLQ_COLUMNS}, processed_at, TIMESTAMP '2024-02-01' AS dlq_timestamp "
        "FROM cl WHERE error_type IS NOT NULL",
        "dq_error_counts": f"{_DAMAGED} SELECT topic, error_type, count(*) AS error_count FROM cl "
        "WHERE error_type IS NOT NULL GROUP BY 1, 2",
        "dq_acceptance": f"{_DAMAGED} SELECT topic, count(*) FILTER (error_type IS NULL) AS accepted, "
        "count(*) FILTER (error_type IS NOT NULL) AS rejected, "
        "CAST(count(*) FILTER (error_type IS NOT NULL) AS DOUBLE) / count(*) AS rejected_share FROM cl GROUP BY topic",
        "dedupe_events": deduped,
        "high_watermark": "SELECT max((epoch_us(ts) // 1000)) AS watermark FROM events",
        "incremental_slice": f"WITH {_log(False)} SELECT event_id, source_ts_ms, operation FROM lg "
        "WHERE source_ts_ms > (SELECT max(source_ts_ms) FROM lg) - 3600000",
        "incremental_slice_day": f"WITH {_log(False)} SELECT event_id, source_ts_ms, operation FROM lg "
        "WHERE source_ts_ms > (SELECT max(source_ts_ms) FROM lg) - 86400000",
        "decode_payload": f"""WITH {_EVENTS}
SELECT user_id AS id, CASE WHEN op0 <> 'd' THEN event_type END AS status, CASE WHEN op0 <> 'd' THEN value END AS amount,
       CASE WHEN op0 <> 'd' THEN k END AS k, op0 <> 'd' AS is_active, op0 AS operation, ts_ms AS source_ts_ms,
       processed_at, CAST(user_id % 3 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, event_id AS pg_lsn
FROM ev""",
        "derive_email_domain": """SELECT c_custkey AS id,
       lower(c_mktsegment) || c_custkey || '@n' || c_nationkey || '.example.com' AS email,
       'n' || c_nationkey || '.example.com' AS email_domain FROM customer""",
        "derive_price_category": "SELECT event_id, value AS price, CASE WHEN value < 50 THEN 'Low' "
        "WHEN value < 200 THEN 'Medium' ELSE 'High' END AS price_category FROM events",
        "derive_order_category": "SELECT event_id, value AS total_amount, CASE WHEN value < 100 THEN 'Small' "
        "WHEN value < 500 THEN 'Medium' ELSE 'Large' END AS order_value_category FROM events",
        "row_hash": f"""WITH {_EVENTS}
SELECT event_id AS kafka_offset, user_id AS id,
       sha256(user_id || '||' || CASE WHEN op0 = 'd' THEN 'NULL||NULL||false' ELSE event_type || '||' || k || '||true' END) AS _hash
FROM ev""",
        "latest_per_key": f"""WITH {_EVENTS}
SELECT user_id AS id, CASE WHEN op0 <> 'd' THEN event_type END AS status, CASE WHEN op0 <> 'd' THEN k END AS k,
       op0 <> 'd' AS is_active, op0 AS operation, ts_ms AS source_ts_ms, event_id AS kafka_offset, event_id AS pg_lsn
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ev) WHERE rn = 1""",
        "scd2_history": f"WITH {_HISTORY} SELECT * FROM hs",
        "scd2_history_hot": f"WITH {_HISTORY} SELECT * EXCLUDE (_hash) FROM hs",
        "history_with_late_events": f"WITH {_HISTORY} SELECT * FROM hs",
        "scd2_actions": f"WITH {_STEPS} SELECT id, action FROM pa",
        "scd2_merge": f"WITH {_STEPS} SELECT * FROM mg",
        "scd2_anti_replay": f"""WITH {_STEPS}
SELECT 'first' AS delivery, id, operation, kafka_offset, _hash FROM b2
WHERE operation <> 'd' AND NOT EXISTS (SELECT 1 FROM op WHERE op.id = b2.id AND op._hash = b2._hash)
UNION ALL
SELECT 'replay', b2.id, b2.operation, b2.kafka_offset, b2._hash FROM b2 JOIN pa ON pa.id = b2.id LEFT JOIN op ON op.id = b2.id
WHERE b2.operation <> 'd' AND pa.action = 'SKIP' AND (op.id IS NULL OR op._hash <> b2._hash)""",
        "silver_after_two_runs": f"WITH {_TABLE_STEPS} SELECT * FROM mg",
        "silver_after_compaction": f"""WITH {_TABLE_STEPS}
SELECT mg.*, written FROM mg, (VALUES ('appended'), ('folded')) AS w(written)""",
        "rebuild_then_merge": f"""WITH {_REBUILT} SELECT * FROM mg
UNION ALL
SELECT rw.id, rw.status, hs.is_active, rw.operation, rw.source_ts_ms, rw.processed_at, rw.kafka_partition, rw.kafka_offset, rw.pg_lsn,
       hs._valid_from, hs._valid_to, false, rw._hash, rw.pg_lsn, hs._close_lsn, hs._close_ts_ms, hs._close_offset
FROM hs JOIN rw USING (pg_lsn) WHERE NOT hs._is_current""",
        "pipeline_marts": _marts_as_text(
            _user_mart(_SHOP_ORDERS, "2099-01-01", 1000, 500, 5),
            _product_mart(_SHOP_ORDERS, "2099-01-01", 10_000, 5_000, 1_000),
            _daily_mart(_SHOP_ORDERS),
        ),
        "gold_incremental": _marts_as_text(
            _user_mart(_CHANGED_LINES, "2001-08-01", 3_500_000, 2_500_000, 10),
            _product_mart(_CHANGED_LINES, "2001-08-01", 2_000_000, 1_700_000, 1_400_000),
            _daily_mart(_CHANGED_LINES),
        ),
        "gold_distinct_rollup": "\nUNION ALL\n".join(
            f"""SELECT '{p}' AS period, strftime(date_trunc('{p}', o_orderdate), '%Y-%m-%d') AS period_start,
       count(DISTINCT o_custkey) AS unique_customers FROM orders GROUP BY 2"""
            for p in ("day", "week", "month")
        ),
        "refine_late_events": f"""WITH {_ROWS}, b AS ({_latest("rw", "true")})
SELECT id, status, pg_lsn FROM b WHERE operation <> 'd'""",
        "decode_connector_types": """SELECT o_orderkey AS id,
       (CAST(round(o_totalprice * 100) AS BIGINT) - 20000000) / 100.0::DOUBLE AS total_amount,
       CAST(o_orderkey AS BIGINT) AS created_at FROM orders""",
        "scd2_last_closed": f"WITH {_HISTORY} SELECT id, max(_valid_to) AS last_valid_to FROM hs WHERE NOT _is_current GROUP BY id",
        "scd2_current": f"WITH {_HISTORY} SELECT id, status, pg_lsn, _valid_from FROM hs WHERE _is_current",
        "silver_stats": f"WITH {_HISTORY} SELECT count(*) AS total_rows, count(*) FILTER (_is_current) AS current_rows FROM hs",
        "scd2_as_of": f"""WITH {_HISTORY} SELECT id, status, _valid_from, _valid_to FROM hs
WHERE _valid_from <= TIMESTAMP '2024-01-16' AND (_valid_to IS NULL OR _valid_to > TIMESTAMP '2024-01-16')""",
        "scd2_fact_join": f"""WITH {_HISTORY}
SELECT e.event_id, e.user_id, hs.status, hs._valid_from, hs._valid_to
FROM events e LEFT JOIN hs ON hs.id = e.user_id AND e.ts >= hs._valid_from AND (hs._valid_to IS NULL OR e.ts < hs._valid_to)""",
        "stream_fact_join": f"""WITH {_HISTORY},
mk AS (SELECT max(greatest(_valid_from, coalesce(_valid_to, _valid_from))) - INTERVAL 5 DAY AS mark FROM hs)
SELECT e.event_id, e.user_id, hs.status, hs._valid_from, e.ts IS NULL OR coalesce(e.ts <= mk.mark, false) AS settled
FROM mk CROSS JOIN events e
LEFT JOIN hs ON hs.id = e.user_id AND e.ts >= hs._valid_from AND (hs._valid_to IS NULL OR e.ts < hs._valid_to)""",
        "scd2_fact_join_hot": f"""WITH {_HISTORY}
SELECT e.event_id, e.user_id, hs.status, hs._valid_from, hs._valid_to
FROM events e LEFT JOIN hs ON hs.id = e.user_id AND e.ts >= hs._valid_from AND (hs._valid_to IS NULL OR e.ts < hs._valid_to)""",
        "gold_user_analytics": user_mart,
        "gold_user_analytics_orders": _user_mart(_ORDERS_H, "2001-08-01", 3_500_000, 2_500_000, 10),
        "gold_product_analytics": product_mart,
        "gold_product_analytics_lines": _product_mart(_LINES_H, "2001-08-01", 2_000_000, 1_700_000, 1_400_000),
        "gold_daily_sales": daily_mart,
        "gold_daily_sales_lines": _daily_mart(_LINES_H),
        "gold_top_product": f"WITH {_FACTS},{_DAYS} SELECT order_date, product_id AS top_product_id FROM t",
        "gold_product_days": f"""WITH {_LINES_H},{_DAYS}
SELECT order_date, product_id, n AS order_count, CAST(cents AS BIGINT) AS revenue_cents FROM p""",
        "gold_roundtrip": daily_mart,
        "gold_counts": f"""SELECT 'gold_user_analytics' AS mart, count(*) AS row_count FROM ({user_mart})
UNION ALL SELECT 'gold_product_analytics', count(*) FROM ({product_mart})
UNION ALL SELECT 'gold_sales_summary', count(*) FROM ({daily_mart})""",
        "snapshot_events": f"""SELECT CAST(c_custkey AS VARCHAR) AS "key",
       '{{"before":null,"after":' || {_CUSTOMER_JSON} || ',"op":"r","ts_ms":1704067200000,'
       || '"source":{{"db":"shop","schema":"public","table":"users","lsn":0,"txId":null}}}}' AS value
FROM customer""",
        "snapshot_diff": f"""WITH n AS (
  SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey = 5 THEN c_acctbal + 1000 ELSE c_acctbal END AS c_acctbal, c_mktsegment
  FROM customer WHERE c_mktsegment <> 'FURNITURE'
  UNION ALL SELECT s_suppkey + 1000000000000, s_name, s_nationkey, s_acctbal, 'SUPPLY' FROM supplier
),
o AS (SELECT c_custkey AS id, {_CUSTOMER_JSON} AS before_json FROM customer),
w AS (SELECT c_custkey AS id, {_CUSTOMER_JSON} AS after_json FROM n)
SELECT CAST(coalesce(o.id, w.id) AS VARCHAR) AS "key",
       CASE WHEN before_json IS NULL THEN 'c' WHEN after_json IS NULL THEN 'd' ELSE 'u' END AS op, before_json, after_json
FROM o FULL OUTER JOIN w ON o.id = w.id WHERE before_json IS DISTINCT FROM after_json""",
        "stream_bronze": f"{_DAMAGED} SELECT {_GOOD_COLUMNS} FROM cl WHERE error_type IS NULL",
        "stream_dlq": f"{_DAMAGED} SELECT {_DLQ_COLUMNS} FROM cl WHERE error_type IS NOT NULL",
        "stream_dedup": deduped,
        "stream_split": f"{_DAMAGED} SELECT kafka_offset, coalesce(error_type, 'GOOD') AS outcome FROM cl",
        "dq_nulls": "\nUNION ALL ".join(
            f"SELECT '{name}' AS column_name, count(*) AS total_rows, count(*) FILTER ({test}) AS null_rows FROM events"
            for name, test in {
                "id": "user_id IS NULL",
                "status": "event_type = 'error'",
                "amount": "event_type = 'error'",
                "k": "event_type = 'error'",
            }.items()
        ),
        "dq_payload_fields": """SELECT 'id' AS field, count(*) AS row_count, true AS declared FROM events
UNION ALL SELECT 'status', count(*), true FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'k', count(*), true FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'amount', count(*), false FROM events WHERE event_type <> 'error'""",
        "schema_evolution": """WITH later AS (SELECT * FROM events WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-16')
SELECT 'users' AS source_table, * FROM (
  SELECT 'id' AS field, 'unchanged' AS change, 'bigint' AS old_kind, 'bigint' AS new_kind, count(user_id) AS row_count FROM later
  UNION ALL SELECT 'status', 'unchanged', 'string', 'string', count(event_type) FROM later
  UNION ALL SELECT 'amount', 'widened', 'bigint', 'double', count("value") FROM later
  UNION ALL SELECT 'k', 'added', NULL, 'bigint', count(json_extract_string(props, '$.k')) FROM later
  UNION ALL SELECT 'flag', 'dropped', 'boolean', 'boolean', 0)""",
        "dq_duplicates": "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
        "dq_orphans": "\nUNION ALL ".join(
            f"SELECT '{child}.{column}' AS reference, {column} AS missing_key, count(*) AS row_count FROM {child} "
            f"WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent}) GROUP BY {column}"
            for child, column, parent, key in (
                ("orders", "o_custkey", "customer", "c_custkey"),
                ("lineitem", "l_partkey", "part", "p_partkey"),
                ("events", "user_id", "supplier", "s_suppkey"),
            )
        ),
        "dq_message_rate": "SELECT 'users' AS source_table, date_trunc('hour', ts) AS window_start, count(*) AS event_count FROM events GROUP BY 2",
        "dq_lag": """SELECT 'users' AS source_table, count(*) AS event_count, min(event_id % 5000) AS min_lag_ms,
       max(event_id % 5000) AS max_lag_ms, CAST(sum(event_id % 5000) AS DOUBLE) / count(*) AS avg_lag_ms FROM events""",
        "stream_lag": """WITH l AS (SELECT date_trunc('day', ts) AS day, event_id % 5000 AS lag FROM events),
b AS (SELECT day, lag, CAST(1 AS BIGINT) << greatest(length(bin(lag)) - 5, 0) AS width FROM l),
h AS (SELECT day, lag - lag % width + width AS lag_to, count(*) AS n FROM b GROUP BY 1, 2),
r AS (SELECT *, sum(n) OVER (PARTITION BY day ORDER BY lag_to) AS reached, sum(n) OVER (PARTITION BY day) AS total FROM h)
SELECT 'users' AS source_table, day, CAST(sum(n) AS BIGINT) AS event_count,
       min(lag_to) FILTER (reached * 100 >= total * 50) AS p50_lag_ms,
       min(lag_to) FILTER (reached * 100 >= total * 95) AS p95_lag_ms,
       min(lag_to) FILTER (reached * 100 >= total * 99) AS p99_lag_ms
FROM r GROUP BY day""",
        "dq_scd2_invariants": f"""WITH {_HISTORY}
SELECT id, CAST(2 AS BIGINT) AS open_rows, CAST(0 AS BIGINT) AS flag_mismatches, CAST(1 AS BIGINT) AS overlaps, 'open rows twice' AS written FROM hs WHERE _is_current""",
        "health_rollup": f"""WITH {_HEALTH}
SELECT *, connector_state = 'RUNNING' AND tasks_failed = 0 AS healthy FROM hl""",
        "health_summary": f"""WITH {_HEALTH}
SELECT count(*) AS connector_count, count(*) FILTER (connector_state <> 'RUNNING') = 0 AS connectors_healthy,
       CAST(sum(tasks_failed) AS BIGINT) AS failed_tasks FROM hl""",
    }
