"""DuckDB oracles for the single-operator entries (``plans.single_ops``)."""

from __future__ import annotations

from clickweave.checks.oracle import (
    CNT, LIBRARY_SQL, TODAY, amount, cd, flag, library_sql, money, money_per,
    over_json, over_transformed, r2, rate, when_count,
)

NO_STAMP = ("event_id, user_id, session_id, event_type, timestamp, page_url, product_id, "
            "product_name, product_category, price, quantity, device_type, referrer, hour, "
            "event_date, event_category, event_sequence, is_session_start, has_product_data, "
            "has_price_data, year, month, day")

# Sessions by window functions: each session's rows with its extreme times.
SPANS = """
, spans AS (
  SELECT DISTINCT session_id, MIN(timestamp) OVER s AS opened_at, MAX(timestamp) OVER s AS closed_at,
         COUNT(*) OVER s AS n, COUNT(*) FILTER (event_type = 'purchase') OVER s > 0 AS buys
  FROM transformed WINDOW s AS (PARTITION BY session_id)
)"""

# Events marked new or returning by their rank inside the user's events.
MARKED = """
, marked AS (
  SELECT *, FIRST_VALUE(timestamp) OVER u AS earliest,
         IF(rank() OVER u = 1, 'New User', 'Returning User') AS user_type
  FROM transformed WINDOW u AS (PARTITION BY user_id ORDER BY timestamp)
)"""

# Oracles over the JSON fixture (``landing``/``landed``/``transformed``).
JSON_SQL = {
    "sessions_across_runs": """SELECT event_id, session_id, event_sequence, is_session_start
       FROM transformed WHERE session_id IS NOT NULL""",
    "array_layout": "SELECT event_id, user_id, event_type, timestamp FROM landed",
    "column_statistics": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count,
       CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value FROM transformed""" for c in ("price", "quantity", "hour")),
    "events_delivered_twice": f"SELECT {NO_STAMP} FROM transformed",
    "scan_raw_json": "SELECT event_id, user_id, event_type, timestamp FROM landed",
    "raw_schema": "SELECT event_id, price, quantity, device_type, referrer FROM landed",
    "permissive_corrupt": f"""SELECT CAST(COUNT(*) FILTER (WHERE _broken) AS BIGINT) AS corrupt_records,
       {CNT} AS total_lines FROM landing""",
    "scan_curated": f"SELECT {NO_STAMP} FROM transformed",
    "job_args": f"""SELECT {CNT} AS total_records, {cd('user_id')} AS distinct_users,
       CAST(COUNT(DISTINCT session_id) + MAX(CASE WHEN session_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS distinct_sessions FROM transformed""",
    "sink_partitioned_parquet": f"""SELECT year, month, day, {CNT} AS row_count
       FROM transformed GROUP BY year, month, day""",
    "sink_corrupt_text": f"SELECT {CNT} AS corrupt_records FROM landing WHERE _broken",
    "drop_corrupt": f"SELECT event_type, {CNT} AS rows_kept FROM landed GROUP BY event_type",
    "count_corrupt": f"SELECT CAST(COUNT(*) FILTER (WHERE _broken) AS BIGINT) AS corrupt_records FROM landing",
    "require_fields": f"""SELECT event_type, {CNT} AS rows_kept FROM landed
       WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
         AND timestamp IS NOT NULL GROUP BY event_type""",
    "null_counts": """SELECT
       CAST(COUNT(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS null_event_id,
       CAST(COUNT(*) FILTER (WHERE user_id IS NULL AND event_id IS NOT NULL) AS BIGINT) AS null_user_id,
       CAST(COUNT(*) FILTER (WHERE event_type IS NULL AND event_id IS NOT NULL
                             AND user_id IS NOT NULL) AS BIGINT) AS null_event_type,
       CAST(COUNT(*) FILTER (WHERE timestamp IS NULL AND event_id IS NOT NULL AND user_id IS NOT NULL
                             AND event_type IS NOT NULL) AS BIGINT) AS null_timestamp
       FROM landed""",
    "drop_columns": """SELECT event_id, user_id, session_id, event_type, timestamp, page_url,
       product_id, product_name, product_category, price, quantity, device_type, referrer
       FROM landed""",
    "parse_timestamp": """SELECT event_id, timestamp, TRY_CAST(timestamp AS TIMESTAMP) AS event_time
       FROM landed""",
    "batch_transform": f"SELECT {NO_STAMP} FROM transformed",
    "run_summary": f"""SELECT {CNT} AS total_records, {cd('user_id')} AS distinct_users,
       CAST(COUNT(DISTINCT session_id) + MAX(CASE WHEN session_id IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS distinct_sessions FROM transformed""",
    "run_type_counts": f"SELECT event_type, {CNT} AS count FROM transformed GROUP BY event_type",
    "run_counters": """SELECT
       CAST((SELECT COUNT(*) FROM landing) AS BIGINT) AS rows_read,
       CAST((SELECT COUNT(*) FROM landing WHERE _broken) AS BIGINT) AS corrupt_records,
       CAST(COUNT(*) FILTER (WHERE event_id IS NULL) AS BIGINT) AS null_event_id,
       CAST(COUNT(*) FILTER (WHERE user_id IS NULL AND event_id IS NOT NULL) AS BIGINT) AS null_user_id,
       CAST(COUNT(*) FILTER (WHERE event_type IS NULL AND event_id IS NOT NULL
                             AND user_id IS NOT NULL) AS BIGINT) AS null_event_type,
       CAST(COUNT(*) FILTER (WHERE timestamp IS NULL AND event_id IS NOT NULL AND user_id IS NOT NULL
                             AND event_type IS NOT NULL) AS BIGINT) AS null_timestamp,
       CAST(COUNT(*) FILTER (WHERE event_id IS NOT NULL AND user_id IS NOT NULL
                             AND event_type IS NOT NULL AND timestamp IS NOT NULL) AS BIGINT)
         AS valid_records
       FROM landed""",
    "scalar_dates": """SELECT event_id,
       CAST(year(TRY_CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS y,
       CAST(month(TRY_CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS m,
       CAST(day(TRY_CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS d,
       CAST(hour(TRY_CAST(timestamp AS TIMESTAMP)) AS INTEGER) AS h,
       CAST(TRY_CAST(timestamp AS TIMESTAMP) AS DATE) AS dt
       FROM landed""",
}

# Streaming entries, also over the JSON fixture.
JSON_SQL.update({
    "stream_deliver_raw": f"SELECT {CNT} AS delivered_records FROM landing",
    "stream_error_route": """SELECT 'good' AS kind, CAST(COUNT(*) FILTER (WHERE NOT _broken) AS BIGINT)
         AS records FROM landing
       UNION ALL
       SELECT 'error', CAST(COUNT(*) FILTER (WHERE _broken) AS BIGINT) FROM landing""",
    "incremental_transform": f"SELECT {NO_STAMP} FROM transformed",
    "newline_framing": "SELECT event_id, event_type FROM landed",
    "live_monitor": """SELECT timestamp, event_type, user_id, session_id, product_id, product_name,
         price, device_type, page_url FROM landed
       WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND event_type IS NOT NULL
         AND timestamp IS NOT NULL
       ORDER BY TRY_CAST(timestamp AS TIMESTAMP) DESC NULLS LAST, event_id ASC LIMIT 100""",
    "stream_dedup": f"""SELECT event_type, {CNT} AS event_count FROM landed
       WHERE TRY_CAST(timestamp AS TIMESTAMP) IS NOT NULL GROUP BY event_type""",
})

# Oracles over the curated table of the direct mapping (``transformed``).
CURATED_SQL = {
    "preview_limit": f"SELECT {NO_STAMP} FROM transformed ORDER BY event_id LIMIT 10",
    "query_result_sink": LIBRARY_SQL["q06_top_referrers"],
    "catalog_database": f"SELECT 'clickweave_fixture' AS namespace, {CNT} AS total_rows FROM transformed",
    "catalog_register": f"SELECT event_type, {CNT} AS event_count FROM transformed GROUP BY event_type",
    "schema_evolve": f"""SELECT event_type,
       CAST(CASE WHEN event_type = 'purchase' THEN 2 ELSE 1 END * COUNT(*) AS BIGINT) AS row_count,
       CAST(CASE WHEN event_type = 'purchase' THEN COUNT(referrer) ELSE 0 END AS BIGINT) AS with_campaign
       FROM transformed GROUP BY event_type""",
    "repair_partitions": """SELECT CAST(0 AS BIGINT) AS partitions_before,
       CAST(COUNT(DISTINCT (year, month, day)) AS BIGINT) AS partitions_after FROM transformed""",
    "show_partitions": """SELECT DISTINCT 'year=' || year || '/month=' || month || '/day=' || day
       AS partition FROM transformed""",
    "table_statistics": f"SELECT {CNT} AS row_count FROM transformed",
    "show_tables": f"SELECT 'direct' AS tableName, {CNT} AS row_count FROM transformed",
    "saved_queries": LIBRARY_SQL["nq3_product_performance"],
    "select_columns": "SELECT user_id, event_type, timestamp FROM transformed",
    "not_null_filter": "SELECT event_id, session_id FROM transformed WHERE session_id IS NOT NULL",
    "non_empty_filter": "SELECT event_id, referrer FROM transformed WHERE referrer <> ''",
    "equality_filter": "SELECT event_id, user_id, price FROM transformed WHERE event_type = 'purchase'",
    "column_inequality": SPANS + """
SELECT session_id, opened_at, closed_at FROM spans WHERE opened_at <> closed_at""",
    "having_filter": f"""SELECT product_id, views FROM (
       SELECT product_id, {when_count("event_type = 'product_view'")} AS views
       FROM transformed WHERE product_id IS NOT NULL GROUP BY product_id) g WHERE views > 5""",
    "today_partition_filter": f"SELECT event_id, year, month, day FROM transformed WHERE {TODAY}",
    "literal_partition_filter": """SELECT event_id, event_type FROM transformed
       WHERE year = '2024' AND month = '01' AND day = '23'""",
    "qualified_star": MARKED + f"""
SELECT {NO_STAMP}, user_type FROM marked""",
    "processed_timestamp": """SELECT event_id, TIMESTAMP '2024-02-01 00:00:00' AS processed_timestamp
       FROM transformed""",
    "date_partitions": "SELECT event_id, year, month, day FROM transformed",
    "event_hour": "SELECT event_id, hour FROM transformed",
    "event_date": "SELECT event_id, event_date FROM transformed",
    "quality_flags": "SELECT event_id, has_product_data, has_price_data FROM transformed",
    "event_category": f"""SELECT event_type, event_category, {CNT} AS event_count
       FROM transformed GROUP BY event_type, event_category""",
    "join_first_event": MARKED + """
SELECT event_id, user_id, earliest, user_type FROM marked""",
    "group_count": f"SELECT device_type, {CNT} AS event_count FROM transformed GROUP BY device_type",
    "count_distinct": f"""SELECT event_category, {cd('user_id')} AS unique_users,
       {cd('session_id')} AS unique_sessions, {cd('product_id')} AS unique_products
       FROM transformed GROUP BY event_category""",
    "distinct_count_rows": f"SELECT {CNT} AS distinct_sessions FROM (SELECT DISTINCT session_id FROM transformed) d",
    "conditional_sum": f"""SELECT device_type, {when_count("event_type = 'purchase'")} AS purchases,
       {when_count("event_type = 'product_view'")} AS views FROM transformed GROUP BY device_type""",
    "conditional_max_flag": f"""SELECT session_id, {flag("event_type = 'product_view'")} AS viewed_product,
       {flag("event_type = 'purchase'")} AS completed_purchase FROM transformed GROUP BY session_id""",
    "conditional_avg_rate": f"""SELECT hour,
       {r2("AVG(CASE WHEN event_type = 'purchase' THEN 1.0 ELSE 0.0 END::DOUBLE) * 100.0")} AS purchase_rate
       FROM transformed GROUP BY hour""",
    "conditional_revenue_sum": f"""SELECT product_category,
       {money("SUM(CASE WHEN event_type = 'purchase' THEN " + amount() + " ELSE 0 END)")} AS revenue
       FROM transformed GROUP BY product_category""",
    "sum_product": f"""SELECT event_type, {money('c')} AS total_amount,
       {money_per('c', 'n')} AS avg_amount
       FROM (SELECT event_type, SUM({amount()}) AS c, COUNT(*) AS n FROM transformed
             WHERE price IS NOT NULL AND quantity IS NOT NULL GROUP BY event_type) g""",
    "avg_product": f"""SELECT event_type,
       {money_per('c', 'n')} AS avg_amount
       FROM (SELECT event_type, SUM({amount()}) AS c, COUNT(*) AS n FROM transformed
             WHERE price IS NOT NULL AND quantity IS NOT NULL GROUP BY event_type) g""",
    "avg_numeric": f"""SELECT device_type, {r2('AVG(event_sequence)')} AS avg_sequence
       FROM transformed GROUP BY device_type""",
    "min_max_timestamp": """SELECT user_id, MIN(timestamp) AS first_seen, MAX(timestamp) AS last_seen
       FROM transformed GROUP BY user_id""",
    "ratio_guarded": f"""SELECT product_id, {rate('purchases', 'views')} AS conversion_rate FROM (
       SELECT product_id, {when_count("event_type = 'purchase'")} AS purchases,
              {when_count("event_type = 'product_view'")} AS views
       FROM transformed WHERE product_id IS NOT NULL GROUP BY product_id) g""",
    "ratio_unguarded": f"""SELECT referrer,
       {r2('CAST(COUNT(*) AS DOUBLE) / NULLIF(CAST(COUNT(DISTINCT session_id) AS DOUBLE), 0)')}
         AS events_per_session FROM transformed GROUP BY referrer""",
    "global_aggregate": f"""SELECT {CNT} AS total_records, {cd('user_id')} AS unique_users,
       {money('SUM(' + amount() + ')')} AS total_amount,
       {r2('AVG(event_sequence)')} AS avg_sequence FROM transformed""",
    "multi_key_group": f"""SELECT year, month, day, {CNT} AS event_count FROM transformed
       GROUP BY year, month, day""",
    "group_key_expression": SPANS + f"""
SELECT IF(buys, 'Converted', 'Not Converted') AS conversion_status, {CNT} AS session_count
FROM spans GROUP BY buys""",
    "duplicate_count": f"""
, doubled AS (SELECT event_id FROM transformed
              UNION ALL SELECT event_id FROM transformed WHERE product_id = 'prod_023')
SELECT {CNT} AS total_records, {cd('event_id')} AS unique_events,
       CAST(COUNT(*) - COUNT(DISTINCT event_id) AS BIGINT) AS duplicate_events FROM doubled""",
    "event_sequence": "SELECT event_id, session_id, event_sequence FROM transformed",
    "is_session_start": "SELECT event_id, is_session_start FROM transformed",
    "share_of_total": f"""SELECT device_type, event_count,
       {rate('event_count', 'SUM(event_count) OVER ()')} AS percentage
       FROM (SELECT device_type, {CNT} AS event_count FROM transformed GROUP BY device_type) g""",
    "order_by": f"SELECT hour, {CNT} AS event_count FROM transformed GROUP BY hour ORDER BY hour",
    "order_by_multi": f"""SELECT year, month, day, {CNT} AS event_count FROM transformed
       GROUP BY year, month, day ORDER BY year DESC, month DESC, day DESC""",
    "top_k": f"""SELECT user_id, {CNT} AS event_count FROM transformed GROUP BY user_id
       ORDER BY event_count DESC, user_id ASC LIMIT 20""",
    "union_all": LIBRARY_SQL["q05_session_funnel"],
    "distinct_rows": "SELECT DISTINCT user_id, device_type FROM transformed",
    "cte": SPANS + f"""
SELECT CAST(buys AS INTEGER) AS bought, {CNT} AS session_count, {r2('AVG(n)')} AS avg_events
FROM spans WHERE opened_at <> closed_at GROUP BY buys""",
    "skipping_layout": f"""SELECT event_type, device_type, {CNT} AS event_count
       FROM transformed WHERE event_type IN ('purchase', 'signup') GROUP BY event_type, device_type""",
    "rollup_active_between": """SELECT CAST(COUNT(DISTINCT user_id) AS BIGINT) AS users,
       CAST(COUNT(DISTINCT session_id) AS BIGINT) AS sessions, CAST(COUNT(*) AS BIGINT) AS events
       FROM transformed WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21'""",
    "scalar_strings": """SELECT event_id,
       lpad(CAST(month(event_date) AS VARCHAR), 2, '0') AS padded_month,
       CAST(hour AS VARCHAR) AS hour_text,
       session_id || '/' || product_id AS session_product FROM transformed""",
    "scalar_elapsed_seconds": SPANS + """
SELECT session_id, date_sub('second', TRY_CAST(opened_at AS TIMESTAMP),
                            TRY_CAST(closed_at AS TIMESTAMP)) AS elapsed_seconds FROM spans""",
    "scalar_null_safe": f"""SELECT product_id, NULLIF(adds, 0) AS adds_or_null,
       {rate('purchases', 'adds')} AS cart_to_purchase_rate,
       CASE WHEN purchases > 0 THEN 'sold' ELSE 'unsold' END AS status
       FROM (SELECT product_id, {when_count("event_type = 'add_to_cart'")} AS adds,
                    {when_count("event_type = 'purchase'")} AS purchases
             FROM transformed WHERE product_id IS NOT NULL GROUP BY product_id) g""",
}


def _curated(sql: str) -> str:
    sql = sql.strip()
    if sql.startswith("WITH"):
        return sql  # already complete (taken from the library)
    if sql.startswith(","):
        from clickweave.checks.oracle import PREFIX
        return PREFIX.rstrip() + sql + "\n"
    return over_transformed(sql)


def ops_sql() -> dict[str, str]:
    lib = library_sql()
    out = {}
    for key, sql in CURATED_SQL.items():
        if sql is LIBRARY_SQL.get("q06_top_referrers"):
            out[key] = lib["q06_top_referrers"]
        elif sql is LIBRARY_SQL.get("nq3_product_performance"):
            out[key] = lib["nq3_product_performance"]
        elif sql is LIBRARY_SQL.get("q05_session_funnel"):
            out[key] = lib["q05_session_funnel"]
        else:
            out[key] = _curated(sql)
    # the same questions asked of the structures beside the event table
    out["q11_by_user_layout"] = lib["q11_new_vs_returning"]
    out["rollup_daily_active_users"] = lib["q02_daily_active_users"]
    out["rollup_quality_check"] = lib["dq_check"]
    for key, sql in JSON_SQL.items():
        out[key] = over_json(sql)
    return out

