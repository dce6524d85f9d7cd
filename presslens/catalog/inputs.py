"""Views that read the driver tables as publisher data.

The texts run unchanged on Spark and on DuckDB and use every row of their tables.  Subscription
dates are the order dates moved by a constant so that they meet the month of the event table.
"""

from __future__ import annotations

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

#: The month covered by the event table, and windows used by the queries.
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-30"
MOVE = "INTERVAL 8218 DAY"

IPHONE = "Mozilla/5.0 (iPhone; CPU iPhone OS 13_3 like Mac OS X) AppleWebKit/605.1.15 Version/13.0 Mobile/15E148 Safari/604.1"
WINDOWS = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/80.0.3987.87 Safari/537.36"
ANDROID = "Mozilla/5.0 (Linux; Android 9; SM-G960F) AppleWebKit/537.36 Chrome/79.0.3945.136 Mobile Safari/537.36"
IPAD = "Mozilla/5.0 (iPad; CPU OS 12_2 like Mac OS X) AppleWebKit/605.1.15 Version/12.1 Mobile/15E148 Safari/604.1"

_BROWSER = "concat('b', regexp_extract(props, '([0-9]+)', 1))"

VIEWS: dict[str, str] = {
    "fx_pageviews": f"""
        SELECT event_id,
          CASE WHEN event_id % 3 = 1 THEN '' ELSE CAST(user_id AS VARCHAR(20)) END AS user_id,
          {_BROWSER} AS browser_id,
          CASE WHEN event_id % 3 = 0 THEN 'True' ELSE 'False' END AS subscriber,
          CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'direct' WHEN 2 THEN 'email'
            WHEN 3 THEN 'external' WHEN 4 THEN 'internal' WHEN 5 THEN 'search'
            ELSE 'social' END AS derived_referer_medium,
          CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'blog' WHEN 2 THEN 'sport'
            WHEN 3 THEN 'rodina-a-vztahy' ELSE 'svet' END AS category,
          concat('t', CAST(event_id % 6 AS VARCHAR(20)), ',t', CAST(event_id % 4 AS VARCHAR(20))) AS tags,
          ts AS time, CAST(ts AS DATE) AS date,
          concat('s', CAST(user_id % 50 AS VARCHAR(20)), '-', CAST(hour(ts) AS VARCHAR(20))) AS session_id,
          CASE event_id % 4 WHEN 0 THEN '{IPHONE}' WHEN 1 THEN '{WINDOWS}'
            WHEN 2 THEN '{ANDROID}' ELSE '{IPAD}' END AS user_agent,
          CAST(floor(value) AS BIGINT) AS timespent
        FROM events WHERE event_type IN ('view', 'click')""",
    "fx_timespent": "SELECT date, user_id, browser_id, timespent FROM fx_pageviews",
    "fx_commerce": f"""
        SELECT event_id, {_BROWSER} AS browser_id, ts AS time, CAST(ts AS DATE) AS date,
          CAST(user_id AS VARCHAR(20)) AS user_id,
          CASE WHEN event_type = 'signup' THEN 'payment' WHEN event_type = 'purchase' THEN 'purchase'
            WHEN event_id % 10 = 0 THEN 'refund' ELSE 'checkout' END AS step
        FROM events WHERE event_type IN ('signup', 'purchase', 'error')""",
    "fx_subscription_types": """
        SELECT CAST(p_partkey AS INT) AS id, p_name AS name, p_brand AS code,
          CASE WHEN p_partkey % 10 = 0 THEN 5 ELSE 31 * (1 + CAST(p_partkey % 4 AS INT)) END AS length,
          p_retailprice AS price, CASE WHEN p_partkey % 3 = 0 THEN 0 ELSE 1 END AS web,
          CAST(p_partkey % 2 AS INT) AS mobile, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS club,
          CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE 0 END AS print,
          CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 0 END AS print_friday,
          p_partkey % 20 = 18 AS no_subscription
        FROM part""",
    "fx_subscriptions": f"""
        SELECT o_orderkey AS id, o_custkey AS user_id,
          CAST(o_orderkey % (SELECT count(*) FROM part) AS INT) AS subscription_type_id,
          o_orderdate + {MOVE} AS created_at, o_orderdate + {MOVE} AS start_time,
          CASE WHEN o_orderkey % 50 = 0 THEN o_orderdate + {MOVE}
            ELSE o_orderdate + {MOVE} + INTERVAL 30 DAY END AS end_time,
          30 AS length, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS is_recurrent,
          CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END AS is_paid, 'regular' AS type
        FROM orders""",
    "fx_payments": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS subscription_id, o_custkey AS user_id,
          l_extendedprice AS amount,
          CASE WHEN l_linenumber = 1 THEN 0.0 ELSE l_tax * 100 END AS additional_amount,
          CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS recurrent_charge,
          CASE WHEN l_discount > 0.08 THEN 'refund' WHEN l_discount > 0.07 THEN 'form'
            WHEN l_linestatus = 'O' THEN 'paid' ELSE 'prepaid' END AS status,
          l_shipdate + {MOVE} AS created_at
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_subscription_upgrades": f"""
        SELECT o_orderkey AS id, o_orderkey AS base_subscription_id,
          o_orderkey + 1 AS upgraded_subscription_id, 'paid' AS type, o_orderdate + {MOVE} AS created_at
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "fx_article_pageviews": f"""
        SELECT l_shipdate + {MOVE} AS time_from, CAST(l_quantity AS BIGINT) AS pv_sum FROM lineitem""",
    "fx_predictions": f"""
        SELECT event_id, CAST(ts AS DATE) AS date, {_BROWSER} AS browser_id,
          CASE WHEN event_id % 4 = 0 THEN CAST(NULL AS VARCHAR(50))
            ELSE concat(CAST(user_id AS VARCHAR(20)), ',', CAST(user_id + event_id % 3 AS VARCHAR(20))) END AS user_ids,
          CASE event_id % 10 WHEN 0 THEN 'conversion' WHEN 1 THEN 'shared_account_login'
            ELSE 'no_conversion' END AS predicted_outcome,
          CAST(event_id % 100 AS DOUBLE) / 250.0 AS conversion_probability,
          CASE WHEN event_id % 5 = 0 THEN '0.9' ELSE '1.0' END AS model_version, ts AS created_at
        FROM events""",
    "fx_models": """
        SELECT CAST(date AS TIMESTAMP) + INTERVAL 5 HOUR AS train_date,
          CAST(CAST(date AS TIMESTAMP) - INTERVAL 7 DAY AS DATE) AS min_date,
          CAST(CAST(date AS TIMESTAMP) - INTERVAL 1 DAY AS DATE) AS max_date,
          'conversion' AS model_type, model_version, 30 AS window_days, count(*) AS train_rows
        FROM fx_predictions GROUP BY date, model_version""",
    "fx_arms": """
        SELECT CAST(user_id % 5 AS INT) AS experiment,
          CASE WHEN event_id % 3 = 0 THEN 'variant-a' WHEN event_id % 3 = 1 THEN 'variant-b'
            ELSE 'variant-c' END AS arm,
          event_type = 'purchase' AS converted
        FROM events""",
}
