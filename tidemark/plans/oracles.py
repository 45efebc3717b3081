"""DuckDB SQL equivalents of the named queries (same column names)."""

from __future__ import annotations

from .queries import (EVENT_RULES, LINEAGE_KEYS, LOOKBACK, MARK_CAPS, TARGET_RULES, ORDERS_BACKFILL_FROM, ORDERS_FIRST_RUN_CAP,
                      ORDERS_LOW_MARK)

_RULES = " AND ".join(f"coalesce({r}, false)" for r in EVENT_RULES.values())

_TARGET = "coalesce(" + TARGET_RULES["bought"] + ", false)"

_EVENTS = "event_id, ts, user_id, event_type, value, props"

_SCD2_EVENTS = ('SELECT *, ts AS "__START_AT", '
                'lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT" FROM events')

_SCD1_EVENTS = (f"SELECT {_EVENTS} FROM (SELECT *, row_number() OVER "
                "(PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1")

_FIRST_EVENTS = (f"SELECT {_EVENTS} FROM (SELECT *, row_number() OVER "
                 "(PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events WHERE ts IS NOT NULL) WHERE rn = 1")

_SCD2_EXCEPT = """
WITH a AS (
  SELECT user_id, ts, event_type, value, event_id, props,
         CASE WHEN row_number() OVER w = 1
                OR event_type IS DISTINCT FROM lag(event_type) OVER w THEN 1 ELSE 0 END AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
b AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts) AS r FROM a),
c AS (SELECT user_id, r, min(ts) AS s, max(ts) AS ts, arg_max(event_type, ts) AS event_type,
             arg_max(value, ts) AS value, arg_max(event_id, ts) AS event_id, arg_max(props, ts) AS props
      FROM b GROUP BY user_id, r)
SELECT user_id, ts, event_type, value, event_id, props, s AS "__START_AT",
       lead(s) OVER (PARTITION BY user_id ORDER BY s) AS "__END_AT"
FROM c"""


_ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"

# latest order per customer; ties on (customer, date) go to the greatest row
_SCD1_ORDERS = (f"SELECT {_ORDERS} FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
                "ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders "
                "WHERE o_orderdate IS NOT NULL) WHERE rn = 1")

# one version per (customer, date), the greatest row of a tie
_SCD2_ORDERS = (f"SELECT {_ORDERS}, o_orderdate AS \"__START_AT\", "
                "lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS \"__END_AT\" "
                "FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate "
                "ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_orderdate IS NOT NULL) WHERE rn = 1")


def _report_row(table: str, col: str) -> str:
    return (f"SELECT '{table}' AS table_name, 'SUCCEEDED' AS status, count(*) AS rows_read, "
            f"strftime(max({col}), '%Y-%m-%d %H:%M:%S.%f') AS watermark "
            f"FROM {table} WHERE {col} IS NOT NULL")


def _metric_row(name: str, rule: str) -> str:
    return (f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT coalesce({rule}, false)) "
            f"AS failed_rows, count(*) AS total_rows FROM events")


def _counters(dataset: str, batch: int, rows: str, rules: dict[str, str]) -> str:
    kept = " AND ".join(f"coalesce({r}, false)" for r in rules.values())
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, {batch}::BIGINT AS batch, count(*) AS rows_in, count(*) FILTER (WHERE {kept}) AS rows_out, "
        f"'{n}' AS rule, count(*) FILTER (WHERE NOT coalesce({r}, false)) AS failed_rows FROM events WHERE {rows}"
        for n, r in rules.items())


_BATCH_METRICS = " UNION ALL ".join([
    _counters("events_stg", 0, "event_id % 2 = 0", EVENT_RULES), _counters("events_stg", 1, "true", EVENT_RULES),
    _counters("purchases", 0, f"event_id % 2 = 0 AND {_RULES}", TARGET_RULES), _counters("purchases", 1, _RULES, TARGET_RULES)])

ORACLES: dict[str, str] = {
    "incremental_extract": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{ORDERS_LOW_MARK}'",
    "backfill_extract": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{ORDERS_BACKFILL_FROM}'",
    "extract_two_runs": "SELECT * FROM orders WHERE o_orderdate IS NOT NULL",
    "watermark_max": "SELECT max(o_orderdate) AS cdc FROM orders",
    "ingest_report": " UNION ALL ".join([_report_row("orders", "o_orderdate"),
                                         _report_row("events", "ts"),
                                         _report_row("lineitem", "l_shipdate")]),
    "drop_columns": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    "upper_name": "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "regexp_clean": ("SELECT o_orderkey, "
                     "regexp_replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', ' ', 'g') AS order_day, "
                     "regexp_replace(o_orderpriority, '-', ' ', 'g') AS o_orderpriority FROM orders"),
    "range_flag": ("SELECT p_partkey, p_size, CASE WHEN p_size < 15 THEN 'low' "
                   "WHEN p_size < 30 THEN 'medium' ELSE 'high' END AS size_flag FROM part"),
    "stream_copy": "SELECT * FROM events",
    "stream_first_arrival": _FIRST_EVENTS,
    "stream_first_arrival_merge": _FIRST_EVENTS,
    "stream_type_drift": (
        "SELECT * EXCLUDE (bad) REPLACE (CAST(CASE WHEN bad THEN NULL ELSE o_custkey END AS INTEGER) AS o_custkey), "
        "CASE WHEN bad THEN '{\"o_custkey\":\"C-' || o_custkey || '\"}' END AS _rescued_data "
        "FROM (SELECT *, o_orderkey % 3 = 1 AND o_custkey % 10 = 0 AS bad FROM orders)"),
    "expect_or_drop": f"SELECT * FROM events WHERE {_RULES}",
    "expect_metrics": " UNION ALL ".join(_metric_row(n, r) for n, r in EVENT_RULES.items()),
    "scd1_latest": _SCD1_EVENTS,
    "scd1_out_of_order": _SCD1_EVENTS,
    "scd1_batch": ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
                   "FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey "
                   "ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders "
                   "WHERE o_orderdate IS NOT NULL) WHERE rn = 1"),
    "scd2_history": _SCD2_EVENTS,
    "scd2_out_of_order": _SCD2_EVENTS,
    "scd2_batch": _SCD2_EVENTS,
    "scd2_except_columns": _SCD2_EXCEPT,
    "scd1_daily_merge": _SCD1_EVENTS,
    "scd2_daily_merge": _SCD2_EVENTS,
    "scd2_except_daily_merge": _SCD2_EXCEPT,
    "scd1_orders_daily_merge": _SCD1_ORDERS,
    "scd2_orders_daily_merge": _SCD2_ORDERS,
    "scd2_closed": f'SELECT * FROM ({_SCD2_EVENTS}) WHERE "__END_AT" IS NOT NULL',
    "scd2_lineage": (f"SELECT * FROM ({_SCD2_EVENTS}) WHERE user_id IN "
                     f"({', '.join(str(k) for k in LINEAGE_KEYS)})"),
    "declared_flows": ('SELECT *, ts AS "__START_AT", '
                       'lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT" '
                       f"FROM events WHERE {_RULES}"),
    "key_uniqueness": ("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem "
                       "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"),
    "star_left_join": ("SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, "
                       "o.o_orderdate, o.o_orderpriority, c.c_name, c.c_mktsegment "
                       "FROM lineitem AS l LEFT JOIN orders AS o ON l.l_orderkey = o.o_orderkey "
                       "LEFT JOIN customer AS c ON o.o_custkey = c.c_custkey"),
    "star_dup_dimension": ("SELECT l.l_orderkey, l.l_linenumber, o.o_orderdate, o.o_totalprice "
                           "FROM lineitem AS l LEFT JOIN (SELECT * FROM orders UNION ALL "
                           "SELECT * FROM orders WHERE o_orderdate > "
                           f"TIMESTAMP '{ORDERS_FIRST_RUN_CAP}') AS o "
                           "ON l.l_orderkey = o.o_orderkey"),
    "orders_chain": ("SELECT o.o_orderkey, o.o_orderdate, "
                     "regexp_replace(o.o_orderpriority, '-', ' ', 'g') AS o_orderpriority, "
                     "o.o_totalprice, c.c_name, c.c_mktsegment "
                     "FROM orders AS o LEFT JOIN customer AS c ON o.o_custkey = c.c_custkey"),
    "scd2_added_column": (
        "SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 3 = 0 THEN props END AS props, "
        'ts AS "__START_AT", lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT" FROM events'),
    "scd1_key_widened": _SCD1_ORDERS,
    "scd2_key_widened": _SCD2_ORDERS,
    "scd2_key_to_text": f"SELECT * REPLACE (CAST(o_custkey AS VARCHAR) AS o_custkey) FROM ({_SCD2_ORDERS})",
    "gold_by_name_after_merges": (
        "SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 4 > 1 THEN props END AS props, "
        'ts AS "__START_AT", lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT" FROM events'),
    "silver_by_name_added_column": (
        "SELECT event_id, ts, user_id, event_type, value, CASE WHEN event_id % 2 = 1 THEN props END AS props FROM events"),
    "gold_by_name": f'SELECT * FROM ({_SCD2_ORDERS}) WHERE "__END_AT" IS NOT NULL',
    "table_stream_by_name": _SCD1_EVENTS,
    "declared_chain": (
        f"SELECT {_EVENTS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn "
        f"FROM events WHERE event_type = 'purchase' AND {_RULES}) WHERE rn = 1"),
    "target_expectation": (
        'SELECT *, ts AS "__START_AT", lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT" '
        f"FROM events WHERE {_RULES} AND {_TARGET}"),
    "upserted_rows": (
        "SELECT 'purchases' AS target, 1::BIGINT AS batches, count(*) FILTER (WHERE p AND ts IS NOT NULL) AS rows_upserted, "
        "count(*) FILTER (WHERE NOT p) AS rows_dropped, count(*) FILTER (WHERE ts IS NULL) AS null_sequence "
        f"FROM (SELECT *, {_TARGET} AS p FROM events WHERE {_RULES})"),
    "failed_table_report": (
        "SELECT 'daily' AS pipeline, 'orders' AS table_name, 'SUCCEEDED' AS status, count(*) AS rows_read FROM orders "
        "WHERE o_orderdate IS NOT NULL UNION ALL SELECT 'daily', 'events', 'FAILED', 0 UNION ALL "
        "SELECT 'daily', 'lineitem', 'SUCCEEDED', count(*) FROM lineitem WHERE l_shipdate IS NOT NULL"),
    "converted_copy": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS DOUBLE) AS o_custkey, o_orderstatus, "
        "CAST(trunc(o_totalprice) AS INTEGER) AS o_totalprice, o_orderdate, left(o_orderpriority, 3) AS o_orderpriority "
        "FROM orders WHERE o_orderdate IS NOT NULL"),
    "converted_copy_rejects": (
        "SELECT column_name, wanted, count(*) AS n, count(DISTINCT value) AS n_values, min(value) AS least, max(value) AS greatest, "
        "count(*) AS reported FROM ("
        "SELECT 'o_custkey' AS column_name, 'bigint' AS wanted, 'C-' || o_custkey AS value FROM orders "
        "WHERE o_custkey % 11 = 0 AND o_orderdate IS NOT NULL UNION ALL "
        "SELECT 'o_orderkey', 'smallint', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey > 32767 AND o_orderdate IS NOT NULL) "
        "GROUP BY column_name, wanted"),
    "late_rows_lookback": (
        f"WITH one AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '{ORDERS_FIRST_RUN_CAP}' AND o_orderkey % 7 > 0), "
        "two AS (SELECT max(o_orderdate) AS m FROM one) "
        "SELECT * FROM one UNION ALL SELECT orders.* FROM orders, two WHERE o_orderdate > two.m "
        f"OR o_orderkey % 7 = 0 AND o_orderdate > two.m - INTERVAL '{LOOKBACK}'"),
    "declared_batch_metrics": _BATCH_METRICS,
    "declared_chain_over_batch": (
        f"SELECT {_EVENTS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events "
        f"WHERE {_RULES} AND user_id IN (SELECT user_id FROM events WHERE event_type = 'purchase' AND {_RULES})) WHERE rn = 1"),
    "star_bounded_theta": (
        "SELECT o_orderkey, o_totalprice, b.least, c_name FROM orders LEFT JOIN "
        "(SELECT n_nationkey * 20000.0::DOUBLE AS least, (n_nationkey + 1) * 20000.0::DOUBLE AS below FROM nation) AS b "
        "ON o_totalprice >= b.least AND o_totalprice < b.below LEFT JOIN customer ON o_custkey = c_custkey"),
    "watermark_log": " UNION ALL ".join(
        f"SELECT strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S.%f') AS cdc FROM orders WHERE o_orderdate <= TIMESTAMP '{cap}'"
        for cap in MARK_CAPS),
    "silver_reset": "SELECT * FROM events WHERE ts IS NOT NULL",
    "one_shot_flow": _SCD1_ORDERS.replace("FROM orders WHERE", "FROM orders WHERE o_orderkey % 2 = 0 AND"),
    "constant_column": "SELECT *, '2025-01-01' AS cdc FROM customer",
    "range_flag_nulls": (
        "SELECT p_partkey, s AS p_size, CASE WHEN s < 15 THEN 'low' WHEN s < 30 THEN 'medium' ELSE 'high' END AS size_flag "
        "FROM (SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN p_size END AS s FROM part)"),
    "expect_or_drop_nulls": (
        f"SELECT {_EVENTS} FROM (SELECT event_id, ts, CASE WHEN event_id % 5 > 0 THEN user_id END AS user_id, "
        f"CASE WHEN event_id % 3 > 0 THEN event_type END AS event_type, value, props FROM events) WHERE {_RULES}"),
}
