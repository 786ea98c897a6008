"""Queries over windows of trade, behaviour and shop facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import shops as S
from tradewake.operators import windows as W
from tradewake.plans.oracle import rounded, sql
from tradewake.plans.registry import query
from tradewake.sources.tables import Tables

c = F.col

# ---- 10-second trade windows -------------------------------------------------


def trade_events(t: Tables):
    """Order, payment and refund events of the enriched detail, at detail time."""
    item = t.order_item.join(t.dim_item.select(c("item_id").alias("product_id"), "category_id", "brand_id"), "product_id")
    base = item.select("sku_id", c("category_id").alias("category3_id"), c("brand_id").alias("tm_id"), "user_id", "amount",
                       c("order_time").alias("ts"), "status", "l_returnflag")
    kinds = F.array(
        F.lit("order"),
        F.when(c("status") != "CREATED", "payment"),
        F.when((c("status") == "REFUNDED") & (c("l_returnflag") == "R"), "refund"),
    )
    return (
        base.withColumn("event_type", F.explode(F.filter(kinds, lambda k: k.isNotNull())))
        .withColumn("order_amount", c("amount"))
        .withColumn("payment_amount", c("amount"))
        .withColumn("refund_amount", c("amount"))
    )


STATS_SQL = """
    SELECT strftime(time_bucket(INTERVAL 10 SECOND, o.order_time), '%Y-%m-%d %H:%M:%S') AS stt,
           strftime(time_bucket(INTERVAL 10 SECOND, o.order_time) + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS edt,
           o.sku_id, i.category_id AS category3_id, i.brand_id AS tm_id, count(*) AS {p}_ct, count(DISTINCT o.user_id) AS {p}_user_ct,
           {extra} CAST(sum(o.amount) AS DOUBLE) AS {p}_amount
    FROM order_item o JOIN dim_item i ON o.product_id = i.item_id WHERE {where} GROUP BY ALL"""
ORDER_STATS = STATS_SQL.format(p="order", where="true", extra="count(*) AS sku_num,")
PAYMENT_STATS = STATS_SQL.format(p="payment", where="status <> 'CREATED'", extra="")
REFUND_STATS = STATS_SQL.format(p="refund", where="status = 'REFUNDED' AND l_returnflag = 'R'", extra="")


@query("win_order_stats", sql(ORDER_STATS))
def win_order_stats(t):
    return W.labelled(W.order_stats(trade_events(t)))


@query("win_payment_stats", sql(PAYMENT_STATS))
def win_payment_stats(t):
    return W.labelled(W.payment_stats(trade_events(t)))


@query("win_refund_stats", sql(REFUND_STATS))
def win_refund_stats(t):
    return W.labelled(W.refund_stats(trade_events(t)))


@query("trade_stats_joined", sql("""
    SELECT * FROM os LEFT JOIN ps USING (stt, edt, sku_id, category3_id, tm_id) LEFT JOIN rs USING (stt, edt, sku_id, category3_id, tm_id)""",
    os=ORDER_STATS, ps=PAYMENT_STATS, rs=REFUND_STATS))
def trade_stats_joined(t):
    return W.labelled(W.trade_windows(trade_events(t)))


# ---- 10-second behaviour windows ---------------------------------------------

BUCKET10 = """strftime(time_bucket(INTERVAL 10 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS stt,
    strftime(time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND, '%Y-%m-%d %H:%M:%S') AS edt"""


@query("win_pv_uv", sql(f"SELECT {BUCKET10}, vc, ch, ar, is_new, count(*) AS pv_ct, count(DISTINCT uid) AS uv_ct FROM log GROUP BY ALL"))
def win_pv_uv(t):
    return W.labelled(W.pv_uv(t.log))


@query("win_session", sql(f"""
    SELECT {BUCKET10}, vc, ch, ar, is_new, count(*) AS sv_ct, CAST(sum(CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS uj_ct
    FROM log WHERE log_type = 'start' GROUP BY ALL"""))
def win_session(t):
    return W.labelled(W.sessions(t.log.withColumn("event_type", c("log_type"))))


def display_events(t: Tables):
    kind = F.when(c("log_type") == "page", "display").when(c("log_type") == "action", "click")
    return t.log.withColumn("event_type", kind).withColumn("display_item", F.when(c("item_type") == "sku_id", c("item")))


@query("win_display_click", sql(f"""
    SELECT {BUCKET10}, item AS sku_id, page_id, ch, count(CASE WHEN log_type = 'page' THEN 1 END) AS disp_ct,
           count(DISTINCT CASE WHEN log_type = 'page' THEN item END) AS disp_sku_num
    FROM log WHERE log_type IN ('page', 'action') AND item_type = 'sku_id' GROUP BY ALL"""))
def win_display_click(t):
    return W.labelled(W.displays_clicks(display_events(t)))


@query("win_gmv", sql("""
    SELECT strftime(time_bucket(INTERVAL 5 MINUTE, pay_time), '%Y-%m-%d %H:%M:%S') AS stt,
           strftime(time_bucket(INTERVAL 5 MINUTE, pay_time) + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS edt,
           count(*) AS payment_ct, count(DISTINCT user_id) AS user_ct, CAST(sum(amount) AS DOUBLE) AS gmv
    FROM order_info WHERE status <> 'CREATED' GROUP BY ALL"""))
def win_gmv(t):
    return W.labelled(W.gmv(t.order_info.where(c("status") != "CREATED"), "pay_time", "amount", "user_id"))


# ---- shop days -----------------------------------------------------------------


def shop_facts(t: Tables):
    """Page, order, pay, refund and cart facts of the shop job."""
    shop = (c("product_id") % 10 + 1).alias("shop_id")
    item = c("product_id").alias("item_id")
    page = t.page_log.select(shop, item, "user_id", c("ts").alias("event_time"))
    order = t.order_item.select("shop_id", item, c("user_id").alias("buyer_id"), "order_id", "order_time")
    pay = t.order_item.select(
        "shop_id", item, c("user_id").alias("buyer_id"), "order_id", c("amount").alias("pay_amount"),
        F.when(c("status") == "CREATED", "FAILED").otherwise("SUCCESS").alias("pay_status"),
        (c("order_id") % 5 == 0).alias("is_presale_tail_paid"), (c("order_id") % 11 == 0).alias("is_zero_order_afterpay"),
        c("order_time").alias("pay_time"))
    refund = t.refund.select("shop_id", item, "order_id", "refund_amount",
                             F.when(c("refund_id") % 4 == 0, "failed").otherwise("success").alias("refund_status"), "refund_time")
    cart = t.cart.where(c("action_type") == "ADD").select(shop, item, "user_id", "quantity", c("action_time").alias("cart_time"))
    return page, order, pay, refund, cart


DAY_COLS = "dt, window_start, window_end"
PAGE_ITEM = """SELECT dt, product_id % 10 + 1 AS shop_id, product_id AS item_id, count(*) AS pv, count(DISTINCT user_id) AS uv
    FROM page_log GROUP BY ALL"""
PAGE_SHOP = "SELECT dt, product_id % 10 + 1 AS shop_id, count(*) AS pv, count(DISTINCT user_id) AS uv FROM page_log GROUP BY ALL"
ORDER_ITEM = "SELECT dt, shop_id, product_id AS item_id, count(DISTINCT user_id) AS order_buyer_cnt FROM order_item GROUP BY ALL"
PAY_ITEM = """SELECT dt, shop_id, product_id AS item_id, count(DISTINCT CASE WHEN status <> 'CREATED' THEN user_id END) AS pay_buyer_cnt,
    sum(CASE WHEN status <> 'CREATED' THEN amount ELSE 0 END) AS gross_pay_amt,
    CAST(sum(CASE WHEN status <> 'CREATED' AND order_id % 5 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS presale_tail_pay_cnt,
    CAST(sum(CASE WHEN status <> 'CREATED' AND order_id % 11 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS afterpay_pay_cnt
    FROM order_item GROUP BY ALL"""
REFUND_ITEM = """SELECT dt, shop_id, product_id AS item_id, sum(CASE WHEN refund_id % 4 <> 0 THEN refund_amount ELSE 0 END) AS refund_amt
    FROM refund GROUP BY ALL"""
BOUNDS = "dt || ' 00:00:00' AS window_start, strftime(CAST(dt AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS window_end"
ITEM_DAY = """
    SELECT dt, shop_id, item_id, coalesce(pv, 0) AS pv, coalesce(uv, 0) AS uv, coalesce(order_buyer_cnt, 0) AS order_buyer_cnt,
           coalesce(pay_buyer_cnt, 0) AS pay_buyer_cnt, coalesce(presale_tail_pay_cnt, 0) AS presale_tail_pay_cnt,
           coalesce(afterpay_pay_cnt, 0) AS afterpay_pay_cnt, coalesce(gross_pay_amt, 0) AS gross_pay_amt, coalesce(refund_amt, 0) AS refund_amt,
           greatest(coalesce(gross_pay_amt, 0) - coalesce(refund_amt, 0), 0) AS net_pay_amt
    FROM pgi FULL OUTER JOIN odi USING (dt, shop_id, item_id) FULL OUTER JOIN pyi USING (dt, shop_id, item_id)
    FULL OUTER JOIN rfi USING (dt, shop_id, item_id)"""
ITEM_DAY_STEPS = {"pgi": PAGE_ITEM, "odi": ORDER_ITEM, "pyi": PAY_ITEM, "rfi": REFUND_ITEM, "item_day": ITEM_DAY}
AMOUNTS = "CAST(gross_pay_amt AS DOUBLE) AS gross_pay_amt, CAST(refund_amt AS DOUBLE) AS refund_amt, CAST(net_pay_amt AS DOUBLE) AS net_pay_amt"


@query("day_page_item", sql(f"SELECT *, {BOUNDS} FROM x", x=PAGE_ITEM))
def day_page_item(t):
    return S.dated(S.page_items(shop_facts(t)[0]))


@query("day_page_shop", sql(f"SELECT *, {BOUNDS} FROM x", x=PAGE_SHOP))
def day_page_shop(t):
    return S.dated(S.page_shops(shop_facts(t)[0]))


@query("day_order_item", sql(f"SELECT *, {BOUNDS} FROM x", x=ORDER_ITEM))
def day_order_item(t):
    return S.dated(S.order_items(shop_facts(t)[1]))


@query("day_pay_item", sql(f"SELECT * REPLACE (CAST(gross_pay_amt AS DOUBLE) AS gross_pay_amt), {BOUNDS} FROM x", x=PAY_ITEM))
def day_pay_item(t):
    return S.dated(S.pay_items(shop_facts(t)[2]))


@query("day_refund_item", sql(f"SELECT * REPLACE (CAST(refund_amt AS DOUBLE) AS refund_amt), {BOUNDS} FROM x", x=REFUND_ITEM))
def day_refund_item(t):
    return S.dated(S.refund_items(shop_facts(t)[3]))


@query("shop_item_daily", sql(f"""
    SELECT dt, {BOUNDS}, shop_id, item_id, pv, uv, order_buyer_cnt, pay_buyer_cnt, presale_tail_pay_cnt, afterpay_pay_cnt, {AMOUNTS} FROM item_day""",
    **ITEM_DAY_STEPS))
def shop_item_daily(t):
    return S.dated(S.item_days(*shop_facts(t)[:4]))


SHOP_DAY = """SELECT dt, shop_id, sum(pv) AS pv, sum(order_buyer_cnt) AS order_buyer_cnt, sum(pay_buyer_cnt) AS pay_buyer_cnt,
    sum(gross_pay_amt) AS gross_pay_amt, sum(refund_amt) AS refund_amt, sum(net_pay_amt) AS net_pay_amt FROM item_day GROUP BY ALL"""


@query("shop_daily", sql(f"""
    SELECT d.dt, {BOUNDS.replace('dt', 'd.dt')}, d.shop_id, CAST(d.pv AS BIGINT) AS pv, s.uv, CAST(order_buyer_cnt AS BIGINT) AS order_buyer_cnt,
           CAST(pay_buyer_cnt AS BIGINT) AS pay_buyer_cnt, {AMOUNTS}
    FROM shop_day d LEFT JOIN page_shop s ON d.dt = s.dt AND d.shop_id = s.shop_id""", **ITEM_DAY_STEPS, shop_day=SHOP_DAY, page_shop=PAGE_SHOP))
def shop_daily(t):
    facts = shop_facts(t)
    return S.dated(S.shop_days(S.item_days(*facts[:4]), facts[0]))


@query("shop_rollup", sql(f"""
    SELECT dt, min(dt || ' 00:00:00') AS window_start, max(strftime(CAST(dt AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')) AS window_end, shop_id,
           CAST(sum(pv) AS BIGINT) AS pv, CAST(sum(uv) AS BIGINT) AS uv, CAST(sum(order_buyer_cnt) AS BIGINT) AS order_buyer_cnt,
           CAST(sum(pay_buyer_cnt) AS BIGINT) AS pay_buyer_cnt, CAST(sum(gross_pay_amt) AS DOUBLE) AS gross_pay_amt,
           CAST(sum(refund_amt) AS DOUBLE) AS refund_amt, CAST(sum(net_pay_amt) AS DOUBLE) AS net_pay_amt
    FROM item_day GROUP BY dt, shop_id""", **ITEM_DAY_STEPS))
def shop_rollup(t):
    return S.rollup_shops(S.dated(S.item_days(*shop_facts(t)[:4])))


@query("cart_top50", sql("""
    SELECT shop_id, item_id, value, '{"metric":"cart_top50","shopId":"' || shop_id || '","itemId":"' || item_id || '","value":' || value || '}' AS json
    FROM (SELECT product_id % 10 + 1 AS shop_id, product_id AS item_id, CAST(sum(quantity) AS BIGINT) AS value FROM cart
          WHERE action_type = 'ADD' GROUP BY ALL ORDER BY value DESC, shop_id, item_id LIMIT 50)"""))
def cart_top50(t):
    return S.metric_json(S.top_items(S.keyed_totals(shop_facts(t)[4], "quantity")), "cart_top50")


@query("pay_top50", sql("""
    SELECT shop_id, item_id, CAST(value AS DOUBLE) AS value,
           '{"metric":"pay_top50","shopId":"' || shop_id || '","itemId":"' || item_id || '","value":' || value || '}' AS json
    FROM (SELECT shop_id, item_id, sum(amount) AS value FROM (
              SELECT shop_id, product_id AS item_id, payment_amount AS amount FROM payment
              UNION ALL SELECT shop_id, product_id, -refund_amount FROM refund) GROUP BY ALL ORDER BY value DESC, shop_id, item_id LIMIT 50)"""))
def pay_top50(t):
    pay = t.payment.select("shop_id", c("product_id").alias("item_id"), c("payment_amount").alias("pay_amount"))
    refund = t.refund.select("shop_id", c("product_id").alias("item_id"), "refund_amount")
    return S.metric_json(S.top_items(S.keyed_totals(S.net_payments(pay, refund), "amount")), "pay_top50")
