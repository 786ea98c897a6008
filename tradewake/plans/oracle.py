"""ANSI SQL twins of the derived inputs, used to check results with DuckDB."""

from __future__ import annotations

import re

PAGES = "['home','search','good_list','good_detail','cart','trade','payment','comment','spec','mine']"

VIEWS: dict[str, str] = {
    "log0": """
        SELECT event_id, user_id, event_type, value, ts,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "log": f"""
        SELECT event_id, user_id, event_type, value, ts, k,
               epoch_us(ts) // 1000 AS ts_ms,
               strftime(ts, '%Y-%m-%d') AS dt,
               CASE event_type WHEN 'signup' THEN 'start' WHEN 'view' THEN 'page' WHEN 'click' THEN 'action'
                    WHEN 'error' THEN 'err' ELSE 'payment' END AS log_type,
               CAST(user_id AS VARCHAR) AS uid,
               'mid_' || user_id AS mid,
               's_' || user_id || '_' || strftime(ts, '%Y-%m-%d') AS session_id,
               {PAGES}[k % 10 + 1] AS page_id,
               CASE WHEN event_id % 6 <> 0 THEN {PAGES}[(event_id // 10) % 10 + 1] END AS last_page_id,
               event_id % 200 AS product_id,
               CASE WHEN k % 4 = 0 THEN 'kw' || (k % 10) ELSE CAST(event_id % 200 AS VARCHAR) END AS item,
               CASE WHEN k % 4 = 0 THEN 'keyword' ELSE 'sku_id' END AS item_type,
               CAST(round(value * 1000) AS BIGINT) AS during_time,
               CASE WHEN k % 11 <> 0 THEN 'ch' || (k % 5) END AS ch,
               'ar' || (user_id % 25) AS ar,
               'v' || (k % 3) AS vc,
               CAST(user_id % 2 AS VARCHAR) AS is_new,
               'brand' || (user_id % 7) AS ba,
               'md' || (user_id % 9) AS md,
               CASE WHEN user_id % 3 = 0 THEN 'iOS' ELSE 'Android' END AS os
        FROM log0""",
    "good_log": """
        SELECT *, 'promotion' AS source_type,
               log_type = 'err' OR (log_type = 'start' AND k % 10 = 0) AS has_err,
               log_type <> 'start' AS has_page,
               log_type IN ('page', 'err') AS has_displays,
               log_type IN ('action', 'err') AS has_actions
        FROM log WHERE event_id % 97 <> 0""",
    "display": """
        SELECT g.*, ['activity','promotion','recommend'][(k + i) % 3 + 1] AS display_type,
               CAST((event_id * 7 + i * 13) % 200 AS VARCHAR) AS display_item,
               'sku_id' AS display_item_type, i + 1 AS display_order, (k + i) % 5 AS pos_id
        FROM good_log g, unnest(range(k % 3)) AS u(i) WHERE has_displays""",
    "action": """
        SELECT g.*, ['favor_add','cart_add','get_coupon'][(k + i) % 3 + 1] AS action_id,
               CAST((event_id * 11 + i * 17) % 200 AS VARCHAR) AS action_item,
               'sku_id' AS action_item_type, ts_ms + i * 100 AS action_ts
        FROM good_log g, unnest(range(k % 2 + 1)) AS u(i) WHERE has_actions""",
    "page_log": "SELECT * FROM log WHERE log_type <> 'start'",
    "visit": """
        SELECT event_id AS log_id, user_id, session_id, product_id, CAST(floor(value) AS BIGINT) AS dwell_seconds,
               ['PC','Wireless','App'][event_id % 3 + 1] AS terminal, page_id AS entry_page,
               last_page_id AS referrer_page, os AS device_type, ar AS region, ts AS event_time, dt
        FROM log WHERE event_type = 'view'""",
    "cart": """
        SELECT event_id AS log_id, user_id, session_id, product_id, k % 5 + 1 AS quantity,
               CASE WHEN k % 4 = 0 THEN 'REMOVE' ELSE 'ADD' END AS action_type, ts AS action_time, dt
        FROM log WHERE event_type = 'click'""",
    "fav": """
        SELECT event_id AS log_id, user_id, product_id,
               CASE WHEN k % 5 = 0 THEN 'REMOVE' ELSE 'ADD' END AS action_type, ts AS fav_time, dt
        FROM log WHERE event_type = 'signup'""",
    "micro": """
        SELECT event_id AS log_id, user_id, session_id, product_id, CAST(floor(value) AS BIGINT) AS duration_sec,
               ['PC','Wireless','App'][event_id % 3 + 1] AS terminal, ts AS event_time, dt
        FROM log WHERE event_type = 'purchase'""",
    "search": """
        SELECT event_id AS log_id, user_id, session_id, 'kw' || (k % 10) AS search_keyword, k AS result_count,
               CASE WHEN k % 2 = 0 THEN product_id END AS clicked_product_id, ts AS search_time, dt
        FROM log WHERE event_type = 'error'""",
    "traffic_source": """
        SELECT event_id AS log_id, session_id, user_id, ['organic','ads','referral','direct'][k % 4 + 1] AS source_type,
               ts AS visit_time, dt
        FROM log WHERE event_type = 'signup'""",
    "page_stay": """
        SELECT event_id AS log_id, session_id, product_id,
               CASE WHEN k % 2 = 0 THEN 'PRODUCT_DETAIL' ELSE 'LIST' END AS page_type, ts AS entry_time,
               CAST(value AS DECIMAL(10,2)) AS stay_seconds, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS is_bounce, dt
        FROM log WHERE event_type = 'view'""",
    "order0": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_custkey % 25 AS province_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CASE o_orderstatus WHEN 'F' THEN 'PAID' WHEN 'O' THEN 'CREATED' ELSE 'REFUNDED' END AS status,
               make_timestamp((1704067200 + (date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) % 60) * 86400
                               + (o_orderkey * 37) % 86400) * 1000000) AS order_time
        FROM orders""",
    "order_info": """
        SELECT *, CASE WHEN status <> 'CREATED' THEN order_time + INTERVAL 10 MINUTE END AS pay_time,
               strftime(order_time, '%Y-%m-%d') AS dt
        FROM order0""",
    "order_item": """
        SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_no, l_orderkey * 10 + l_linenumber AS detail_id,
               l_partkey AS product_id, l_partkey * 10 + l_linenumber % 3 AS sku_id, l_partkey % 10 + 1 AS shop_id,
               CAST(l_quantity AS BIGINT) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag,
               o.user_id, o.status, o.order_time, o.pay_time, o.dt
        FROM lineitem JOIN order_info o ON l_orderkey = o.order_id""",
    "payment": """
        SELECT detail_id AS payment_id, order_id, product_id, sku_id, shop_id, user_id, quantity, amount AS payment_amount,
               ['ALIPAY','WECHAT','CCB','OTHER'][order_id % 4 + 1] AS payment_method,
               CASE WHEN order_id % 2 = 0 THEN 1 ELSE 0 END AS is_presale,
               ['DEPOSIT','FINAL','ALL'][order_id % 3 + 1] AS presale_stage,
               CASE WHEN order_id % 7 = 0 THEN 1 ELSE 0 END AS is_group_buy, status, pay_time AS payment_time, dt
        FROM order_item WHERE status IN ('PAID', 'REFUNDED')""",
    "refund": """
        SELECT detail_id AS refund_id, detail_id AS payment_id, order_id, product_id, shop_id, user_id,
               amount AS refund_amount, order_time + INTERVAL 3 DAY AS refund_time,
               strftime(order_time + INTERVAL 3 DAY, '%Y-%m-%d') AS dt
        FROM order_item WHERE status = 'REFUNDED' AND l_returnflag = 'R'""",
    "price0": """
        SELECT p_partkey, CAST(round(p_retailprice * 100) AS BIGINT) AS cents, i
        FROM part, unnest(range(3)) AS u(i)""",
    "price_change": """
        SELECT p_partkey * 3 + i AS change_id, p_partkey AS product_id,
               CAST(cents / 100 AS DECIMAL(18,2)) AS old_price,
               CAST((cents * (100 - (p_partkey * 7 + i * 3) % 20) // 100) / 100 AS DECIMAL(18,2)) AS new_price,
               DATE '2024-01-01' + CAST((p_partkey + i * 11) % 30 AS INTEGER) AS change_day,
               strftime(DATE '2024-01-01' + CAST((p_partkey + i * 11) % 30 AS INTEGER), '%Y-%m-%d') AS dt
        FROM price0""",
    "inventory": """
        SELECT l_partkey * 10 + l_linenumber % 3 AS sku_id, CAST(l_quantity AS BIGINT) AS inventory_qty,
               l_shipdate AS snapshot_time, l_orderkey AS snapshot_id
        FROM lineitem""",
    "coupon": """
        SELECT order_id AS log_id, order_id % 50 AS coupon_id, user_id, order_id, order_time AS issue_time,
               pay_time + INTERVAL 1 DAY AS use_time, amount
        FROM order_info""",
    "dim_item": """
        SELECT p_partkey AS item_id, p_name AS item_name, CAST(p_size AS BIGINT) AS category_id, p_type AS category_name,
               CAST(regexp_extract(p_brand, '([0-9]+)$', 1) AS BIGINT) AS brand_id, p_brand AS brand_name,
               CAST(p_size % 3 AS BIGINT) AS first_cat_id, CAST(p_size % 10 AS BIGINT) AS second_cat_id,
               CAST(p_size AS BIGINT) AS third_cat_id,
               CAST((CAST(round(p_retailprice * 100) AS BIGINT) - 90000) * 3 / 100 AS DECIMAL(18,2)) AS price
        FROM part""",
    "dim_category": """
        SELECT DISTINCT CAST(p_size AS BIGINT) AS category_id, 'Category ' || p_size AS category_name, 2::BIGINT AS level
        FROM part""",
    "dim_user": """
        SELECT c_custkey AS user_id, c_name AS user_name, c_mktsegment AS user_level, CAST(c_nationkey AS BIGINT) AS province_id,
               CASE WHEN c_custkey % 4 <> 0 THEN DATE '2022-06-01' + CAST(c_custkey % 900 AS INTEGER) END AS last_payment_date
        FROM customer""",
    "dim_shop": """
        SELECT s_suppkey AS shop_id, s_name AS shop_name, CAST(s_nationkey AS BIGINT) AS province_id FROM supplier""",
    "dim_province": """
        SELECT CAST(n_nationkey AS BIGINT) AS province_id, n_name AS province_name, CAST(n_regionkey AS BIGINT) AS region_id
        FROM nation""",
    "dim_region": "SELECT CAST(r_regionkey AS BIGINT) AS region_id, r_name AS region_name FROM region",
    "cdc": """
        SELECT 'order_info' AS tbl, order_id AS key, epoch_us(order_time) // 1000 AS ts_ms FROM order_info
        UNION ALL SELECT 'payment_info', order_id, epoch_us(pay_time) // 1000 FROM order_info WHERE status <> 'CREATED'
        UNION ALL SELECT 'refund_info', order_id + 1, epoch_us(pay_time) // 1000 FROM order_info WHERE status = 'REFUNDED'
        UNION ALL SELECT 'user_info', user_id, user_id * 1000 + 1704067200000 FROM dim_user
        UNION ALL SELECT 'sku_info', item_id, item_id * 1000 + 1704067200000 FROM dim_item""",
    "cdc_op": "SELECT *, ['r','c','u','d'][key % 4 + 1] AS op FROM cdc",
}


def rounded(expr: str, digits: int) -> str:
    """Half-up rounding on the decimal value, as double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), {digits}) AS DOUBLE)"


def ratio(a: str, b: str, digits: int | None = None) -> str:
    q = f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"
    return q if digits is None else rounded(q, digits)


def percent(a: str, b: str, digits: int | None = None) -> str:
    q = f"({ratio(a, b)} * 100)"
    return q if digits is None else rounded(q, digits)


def percent_text(a: str, b: str, digits: int = 2) -> str:
    return f"CAST({percent(a, b, digits)} AS VARCHAR) || '%'"


def sql(body: str, **steps: str) -> str:
    """``body`` with the views it needs, and extra steps in order, in front."""
    needed: list[str] = []

    def add(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"[a-z_][a-z0-9_]*", text)):
            if word in VIEWS and word not in steps and word not in needed and re.search(
                rf"(?:FROM|JOIN|,)\s+{word}\b", text
            ):
                add(VIEWS[word])
                needed.append(word)

    for text in steps.values():
        add(text)
    add(body)
    parts = [f"{name} AS ({VIEWS[name]})" for name in needed] + [f"{name} AS MATERIALIZED ({text})" for name, text in steps.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
