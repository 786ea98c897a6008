"""Queries over the app log: cleaning, splitting, flattening, unifying."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import routing as R
from tradewake.plans.oracle import sql
from tradewake.plans.registry import query
from tradewake.sources.tables import Tables

c = F.col


def parsed(t: Tables):
    return R.parse_log(t.log_text)


@query("src_null_safe", sql("SELECT event_id, topic FROM (SELECT event_id, 'topic_' || log_type AS topic FROM log) WHERE event_id % 13 <> 0"))
def src_null_safe(t):
    messages = t.log_text.withColumn(
        "value", F.when(c("event_id") % 26 == 0, F.lit(None)).when(c("event_id") % 13 == 0, F.lit("  ")).otherwise(c("value"))
    )
    return R.drop_blank(messages).select("event_id", "topic")


@query("src_json_typed", sql("SELECT mid, page_id, during_time, ts_ms AS ts FROM good_log WHERE has_page"))
def src_json_typed(t):
    return R.having(parsed(t), "page").select("rec.common.mid", "rec.page.page_id", "rec.page.during_time", "rec.ts")


@query("json_clean", sql("SELECT event_id, mid, ts_ms AS ts FROM good_log"))
def json_clean(t):
    return R.clean(t.log_text).select("event_id", "rec.common.mid", "rec.ts")


@query("json_dirty", sql("""SELECT '{"common": ' || event_id AS raw, 'malformed' AS error FROM log WHERE event_id % 97 = 0"""))
def json_dirty(t):
    return R.dirty(t.log_text)


@query(
    "log_split_overlap",
    sql("""
        SELECT event_id, 'start' AS part FROM good_log WHERE log_type = 'start'
        UNION ALL SELECT event_id, 'page' FROM good_log WHERE has_page
        UNION ALL SELECT event_id, 'display' FROM good_log WHERE has_displays
        UNION ALL SELECT event_id, 'action' FROM good_log WHERE has_actions
        UNION ALL SELECT event_id, 'error' FROM good_log WHERE has_err"""),
)
def log_split_overlap(t):
    return R.overlapping(parsed(t)).select("event_id", "part")


@query("log_split_err", sql("SELECT event_id, CAST(1000 + k AS VARCHAR) AS error_code FROM good_log WHERE has_err"))
def log_split_err(t):
    return R.split_err(parsed(t)).select("event_id", "err.error_code")


@query(
    "log_split_start",
    sql("""SELECT event_id, mid, ['icon','notice','install'][k % 3 + 1] AS entry, k * 10 AS loading_time, ts_ms AS ts
           FROM good_log WHERE log_type = 'start'"""),
)
def log_split_start(t):
    return R.split_start(parsed(t)).select("event_id", "rec.common.mid", "rec.start.entry", "rec.start.loading_time", "rec.ts")


DISPLAY_SQL = "SELECT event_id, mid, page_id, display_type, display_item AS item, display_order AS \"order\", pos_id, ts_ms AS ts FROM display"


@query("log_split_display", sql(DISPLAY_SQL))
def log_split_display(t):
    return R.split_display(parsed(t)).select(
        "event_id", "rec.common.mid", "rec.page.page_id", "display.display_type", "display.item", "display.order", "display.pos_id", "rec.ts"
    )


@query("log_split_action", sql("SELECT event_id, mid, page_id, action_id, action_item AS item, action_ts FROM action"))
def log_split_action(t):
    return R.split_action(parsed(t)).select(
        "event_id", "rec.common.mid", "rec.page.page_id", "action.action_id", "action.item", c("action.ts").alias("action_ts")
    )


@query("log_split_page", sql("SELECT event_id, mid, page_id, last_page_id, item, ts_ms AS ts FROM good_log WHERE has_page"))
def log_split_page(t):
    return R.split_page(parsed(t)).select("event_id", "rec.common.mid", "rec.page.page_id", "rec.page.last_page_id", "rec.page.item", "rec.ts")


@query("log_display", sql(DISPLAY_SQL))
def log_display(t):
    return R.displays(parsed(t)).select(
        "event_id", "rec.common.mid", "rec.page.page_id", "display.display_type", "display.item", "display.order", "display.pos_id", "rec.ts"
    )


@query("log_action", sql("SELECT event_id, mid, page_id, action_id, action_item AS item, action_ts, ts_ms AS ts FROM action"))
def log_action(t):
    return R.actions(parsed(t)).select(
        "event_id", "rec.common.mid", "rec.page.page_id", "action.action_id", "action.item", c("action.ts").alias("action_ts"), "rec.ts"
    )


@query("log_page", sql("SELECT event_id, mid, page_id, during_time FROM good_log WHERE has_page"))
def log_page(t):
    return R.having(parsed(t), "common", "page").select("event_id", "rec.common.mid", "rec.page.page_id", "rec.page.during_time")


@query("log_start", sql("SELECT event_id, mid, k * 100 AS open_ad_ms FROM good_log WHERE log_type = 'start'"))
def log_start(t):
    return R.having(parsed(t), "start").select("event_id", "rec.common.mid", "rec.start.open_ad_ms")


@query("log_error", sql("SELECT event_id, mid, CAST(1000 + k AS VARCHAR) AS error_code FROM good_log WHERE has_err"))
def log_error(t):
    return R.having(parsed(t), "err").select("event_id", "rec.common.mid", "rec.err.error_code")


COMMON_SQL = "ar AS area_code, ba AS brand, ch AS channel, is_new, md AS model, mid AS mid_id, os, uid AS user_id, vc AS version_code"
PAGE_SQL = "during_time, item AS page_item, item_type AS page_item_type, last_page_id, page_id, source_type"


@query(
    "flat_start",
    sql(f"""SELECT {COMMON_SQL}, ['icon','notice','install'][k % 3 + 1] AS entry, k * 10 AS loading_time,
                   CAST(k % 20 AS VARCHAR) AS open_ad_id, k * 100 AS open_ad_ms,
                   CASE WHEN k % 2 = 0 THEN k * 50 END AS open_ad_skip_ms, ts_ms AS ts, dt
            FROM good_log WHERE log_type = 'start'"""),
)
def flat_start(t):
    return R.flat_start(parsed(t))


URL_SQL = "CASE {p} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.PAGE_URLS.items()) + f" ELSE '{X.OTHER_URL}' END"


@query(
    "flat_page_url",
    sql(f"""SELECT ar, ba, ch, is_new, md, mid, os, uid, vc,
                   CASE WHEN has_page THEN page_id END AS page_id, CASE WHEN has_page THEN item END AS item,
                   CASE WHEN has_page THEN item_type END AS page_item_type,
                   CASE WHEN has_page THEN last_page_id END AS last_page_id,
                   CASE WHEN has_page THEN source_type END AS source_type,
                   CASE WHEN has_page THEN during_time END AS during_time,
                   {URL_SQL.format(p='CASE WHEN has_page THEN page_id END')} AS url, ts_ms AS ts, dt
            FROM good_log"""),
)
def flat_page_url(t):
    return R.flat_page(parsed(t))


@query(
    "flat_action",
    sql(f"""SELECT {COMMON_SQL}, {PAGE_SQL}, action_id, action_item AS item, action_item_type AS item_type, ts_ms AS ts, dt
            FROM action"""),
)
def flat_action(t):
    return R.flat_action(parsed(t))


@query(
    "flat_display",
    sql(f"""SELECT {COMMON_SQL}, {PAGE_SQL}, ts_ms AS ts, display_type, display_item AS item,
                   display_item_type AS item_type, display_order AS "order", pos_id, dt FROM display"""),
)
def flat_display(t):
    return R.flat_display(parsed(t))


@query(
    "log_unified",
    sql("""SELECT dt, log_type, mid, uid, ts_ms AS ts, strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time,
                  'topic_' || log_type AS topic, event_id % 4 AS "partition", event_id // 4 AS "offset", session_id AS sid,
                  CASE WHEN has_page THEN page_id END AS page_id, CASE WHEN has_page THEN item END AS item,
                  CAST(NULL AS VARCHAR) AS action_id, CAST(NULL AS VARCHAR) AS display_id,
                  CASE WHEN has_err THEN CAST(1000 + k AS VARCHAR) END AS error_code, os, vc, ch, ar
           FROM good_log"""),
)
def log_unified(t):
    return R.unified(parsed(t))


@query(
    "behavior_union",
    sql("""SELECT 'start' AS event_type, mid, ts_ms AS event_ts, CAST(NULL AS VARCHAR) AS page_id,
                  CAST(NULL AS VARCHAR) AS display_item, CAST(NULL AS VARCHAR) AS action_id
           FROM good_log WHERE log_type = 'start'
           UNION ALL SELECT 'page', mid, ts_ms, page_id, NULL, NULL FROM good_log WHERE has_page
           UNION ALL SELECT 'display', mid, ts_ms, page_id, display_item, NULL FROM display
           UNION ALL SELECT 'action', mid, action_ts, page_id, NULL, action_id FROM action"""),
)
def behavior_union(t):
    return R.behaviour(parsed(t)).select(
        "event_type", "mid", "event_ts", "page.page_id", c("display.item").alias("display_item"), "action.action_id"
    )


def shop_log(t: Tables):
    """Shop log rows with text times; some lack a required field."""
    e = c("event_id")
    return t.log.select(
        (c("product_id") % 10 + 1).cast("string").alias("shop_id"), "page_id",
        F.when(e % 31 != 0, e.cast("string")).alias("event_id"), "event_type",
        (c("k") % 5).cast("int").alias("quantity"), F.when(e % 37 != 0, c("mid")).alias("device_id"),
        F.when(e % 41 != 0, c("uid")).alias("user_id"), c("product_id").cast("string").alias("item_id"), "session_id",
        F.when(e % 43 != 0, X.time_text("ts")).alias("event_time"),
        F.create_map(F.lit("k"), c("k").cast("string")).alias("props"),
    )


@query(
    "log_cleanse",
    sql("""SELECT CAST(product_id % 10 + 1 AS VARCHAR) AS shop_id, page_id, CAST(event_id AS VARCHAR) AS event_id, event_type,
                  k % 5 AS quantity, mid AS device_id, uid AS user_id, CAST(product_id AS VARCHAR) AS item_id, session_id,
                  strftime(ts, '%Y-%m-%d %H:%M:%S') AS event_time, CAST(k AS VARCHAR) AS prop_k,
                  strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
           FROM log WHERE event_id % 31 <> 0 AND event_id % 37 <> 0 AND event_id % 41 <> 0 AND event_id % 43 <> 0"""),
)
def log_cleanse(t):
    return R.cleanse(shop_log(t)).withColumn("prop_k", c("props")["k"]).drop("props")


@query(
    "behavior_project",
    sql("""SELECT uid AS user_id, CAST(product_id AS VARCHAR) AS item_id, CAST(product_id % 10 + 1 AS VARCHAR) AS shop_id,
                  event_type FROM log"""),
)
def behavior_project(t):
    return R.behaviour_projection(
        t.log.select(c("uid").alias("user_id"), c("product_id").cast("string").alias("item_id"),
                     (c("product_id") % 10 + 1).cast("string").alias("shop_id"), "event_type")
    )


def wide_events(t: Tables):
    """The wide event topic: six row kinds in one 27-column layout."""
    s = lambda x: x.cast("string")
    money = "decimal(10,2)"
    item = t.order_item
    shop, user, part = t.dim_shop, t.dim_user, t.dim_item
    kinds = [
        item.select(F.lit("order_item").alias("event_type"), s(c("order_id")).alias("order_id"),
                    s(c("product_id")).alias("item_id"), s(c("sku_id")).alias("sku_id"), s(c("shop_id")).alias("shop_id"),
                    c("quantity").cast("int").alias("qty"), c("amount").cast(money).alias("unit_price")),
        t.payment.select(F.lit("payment").alias("event_type"), s(c("payment_id")).alias("payment_id"),
                         s(c("order_id")).alias("order_id"), s(c("user_id")).alias("buyer_id"),
                         c("payment_amount").cast(money).alias("pay_amount"), c("status").alias("pay_status"),
                         X.time_text("payment_time").alias("pay_time")),
        t.refund.select(F.lit("refund").alias("event_type"), s(c("refund_id")).alias("refund_id"),
                        s(c("order_id")).alias("order_id"), s(c("user_id")).alias("buyer_id"),
                        c("refund_amount").cast(money).alias("refund_amount"), F.lit("money").alias("refund_type")),
        user.select(F.lit("user").alias("event_type"), s(c("user_id")).alias("user_id"),
                    F.date_format("last_payment_date", "yyyy-MM-dd").alias("register_time"),
                    F.when(c("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
                    (c("user_id") % 60 + 18).cast("int").alias("age"), s(c("province_id")).alias("region"),
                    c("user_level").alias("device_type")),
        part.select(F.lit("item").alias("event_type"), s(c("item_id")).alias("item_id"),
                    s(c("item_id") * 10).alias("sku_id"), s(c("item_id") % 10 + 1).alias("shop_id"),
                    s(c("category_id")).alias("category_id"), "item_name", c("price").cast(money).alias("price")),
        shop.select(F.lit("shop").alias("event_type"), s(c("shop_id")).alias("shop_id"), "shop_name",
                    s(c("province_id")).alias("seller_id"), s(c("shop_id") % 7).alias("category_id"),
                    F.lit("2024-01-01").alias("create_time")),
    ]
    out = kinds[0]
    for k in kinds[1:]:
        out = out.unionByName(k, allowMissingColumns=True)
    return out


V = "CAST({} AS VARCHAR)"
WIDE_SQL = {
    "order_item": """SELECT CAST(order_id AS VARCHAR) AS order_id, CAST(product_id AS VARCHAR) AS item_id, CAST(sku_id AS VARCHAR) AS sku_id,
        CAST(shop_id AS VARCHAR) AS shop_id, quantity AS qty, CAST(amount AS DOUBLE) AS unit_price FROM order_item""",
    "payment": """SELECT CAST(payment_id AS VARCHAR) AS payment_id, CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS buyer_id,
        CAST(payment_amount AS DOUBLE) AS pay_amount, status AS pay_status,
        strftime(payment_time, '%Y-%m-%d %H:%M:%S') AS pay_time FROM payment""",
    "refund": """SELECT CAST(refund_id AS VARCHAR) AS refund_id, CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS buyer_id,
        CAST(refund_amount AS DOUBLE) AS refund_amount, 'money' AS refund_type FROM refund""",
    "user": """SELECT CAST(user_id AS VARCHAR) AS user_id, strftime(last_payment_date, '%Y-%m-%d') AS register_time,
        CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender, user_id % 60 + 18 AS age,
        CAST(province_id AS VARCHAR) AS region, user_level AS device_type FROM dim_user""",
    "item": """SELECT CAST(item_id AS VARCHAR) AS item_id, CAST(item_id * 10 AS VARCHAR) AS sku_id, CAST(item_id % 10 + 1 AS VARCHAR) AS shop_id,
        CAST(category_id AS VARCHAR) AS category_id, item_name, CAST(price AS DOUBLE) AS price FROM dim_item""",
    "shop": """SELECT CAST(shop_id AS VARCHAR) AS shop_id, shop_name, CAST(province_id AS VARCHAR) AS seller_id,
        CAST(shop_id % 7 AS VARCHAR) AS category_id, '2024-01-01' AS create_time FROM dim_shop""",
}
for _kind, _text in WIDE_SQL.items():
    query(f"wide_split_{_kind}", sql(_text))(lambda t, kind=_kind: R.wide_split(wide_events(t), kind))


@query(
    "amount_normalise",
    sql("""SELECT order_id, CASE WHEN order_id % 50 <> 0 THEN CAST(amount AS DOUBLE) END AS order_amount,
                  CASE WHEN status = 'PAID' AND order_id % 77 <> 0 THEN CAST(amount AS DOUBLE) END AS payment_amount,
                  CASE WHEN order_id % 50 = 0 THEN 'n/a' WHEN status = 'PAID' AND order_id % 77 = 0 THEN 'x1' END AS cast_error
           FROM order_info"""),
)
def amount_normalise(t):
    raw = t.order_info.select(
        "order_id",
        F.when(c("order_id") % 50 == 0, "n/a").otherwise(c("amount").cast("string")).alias("order_price"),
        F.when(c("status") == "PAID", F.when(c("order_id") % 77 == 0, "x1").otherwise(c("amount").cast("string"))).alias("pay_amount"),
    )
    return R.normalise_amounts(raw).drop("order_price", "pay_amount")


@query("drop_null_key", sql("SELECT order_id, user_id, CAST(amount AS DOUBLE) AS amount FROM order_info WHERE order_id % 19 <> 0 AND user_id % 23 <> 0"))
def drop_null_key(t):
    rows = t.order_info.select(
        F.when(c("order_id") % 19 != 0, c("order_id")).alias("order_id"),
        F.when(c("user_id") % 23 != 0, c("user_id")).alias("user_id"), "amount",
    )
    return R.require(rows, "order_id", "user_id")


@query(
    "cart_from_items",
    sql("""SELECT 'cart' AS event_type, CAST(user_id AS VARCHAR) AS user_id, CAST(product_id AS VARCHAR) AS item_id,
                  CAST(sku_id AS VARCHAR) AS sku_id, CAST(shop_id AS VARCHAR) AS shop_id, CAST(epoch_us(order_time) // 1000 AS VARCHAR) AS ts,
                  CAST(('0x' || right(md5(concat_ws('|', user_id, product_id, sku_id, shop_id, epoch_us(order_time) // 1000)), 6)) AS BIGINT) % 10 + 1 AS quantity
           FROM order_item"""),
)
def cart_from_items(t):
    items = t.order_item.select(
        *[c(a).cast("string").alias(b) for a, b in
          [("user_id", "user_id"), ("product_id", "item_id"), ("sku_id", "sku_id"), ("shop_id", "shop_id")]],
        F.unix_millis("order_time").cast("string").alias("ts"),
    )
    return R.cart_events(items)


@query("filter_combo", sql("""
    SELECT order_id, user_id, CAST(amount AS DOUBLE) AS amount, dt FROM order_info
    WHERE dt BETWEEN '2024-01-10' AND '2024-01-31' AND status IN ('PAID', 'REFUNDED') AND pay_time IS NOT NULL AND province_id IN (1, 2, 3)"""))
def filter_combo(t):
    return t.order_info.where(
        c("dt").between("2024-01-10", "2024-01-31") & c("status").isin("PAID", "REFUNDED") & c("pay_time").isNotNull()
        & c("province_id").isin(1, 2, 3)
    ).select("order_id", "user_id", "amount", "dt")


OVERRIDE_KEYS = list(X.BUCKET_OVERRIDES)


@query("hash_mod_bucket", sql(f"""
    SELECT event_id, lpad(CAST(CAST(('0x' || right(md5(addr), 3)) AS BIGINT) % 128 AS VARCHAR), 4, '0') AS plain_bucket,
           coalesce(CASE lower(addr) {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in X.BUCKET_OVERRIDES.items())} END,
                    lpad(CAST(CAST(('0x' || right(md5(addr), 3)) AS BIGINT) % 128 AS VARCHAR), 4, '0')) AS bucket
    FROM (SELECT event_id, CASE WHEN event_id % 20 = 0 THEN {OVERRIDE_KEYS}[(event_id // 20) % 7 + 1] ELSE mid END AS addr FROM log)"""))
def hash_mod_bucket(t):
    from tradewake.sources.tables import pick

    rows = t.log.select("event_id", F.when(c("event_id") % 20 == 0, pick(OVERRIDE_KEYS, F.floor(c("event_id") / 20) % 7)).otherwise(c("mid")).alias("addr"))
    return rows.select("event_id", X.hash_bucket("addr").alias("plain_bucket"), X.hash_bucket("addr", 128, X.BUCKET_OVERRIDES).alias("bucket"))


@query("regex_valid", sql("""SELECT page_id, url, CASE WHEN regexp_full_match(html, '[a-zA-Z0-9 ]*') THEN 1 ELSE 0 END::BIGINT AS simple_html,
        CASE WHEN regexp_full_match(replace(replace(url, '/', ''), '.', ''), '[a-zA-Z0-9\\-_:?#&%+~@!*()]+') THEN 1 ELSE 0 END::BIGINT AS valid FROM pages"""))
def regex_valid(t):
    bare = F.replace(F.replace("url", F.lit("/"), F.lit("")), F.lit("."), F.lit(""))
    return t.read("pages").select(
        "page_id", "url", F.col("html").rlike("^[a-zA-Z0-9 ]*$").cast("bigint").alias("simple_html"),
        bare.rlike(X.ALLOWED_TEXT).cast("bigint").alias("valid"),
    )


@query("day_partition_range", sql("""
    SELECT user_id, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS day_key
    FROM (SELECT user_id, unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS d FROM log GROUP BY user_id)"""))
def day_partition_range(t):
    spans = t.log.groupBy("user_id").agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last"))
    return R.day_keys(spans, "first", "last").select("user_id", "day_key")


@query("dwd_visit", sql("""
    SELECT log_id, user_id, session_id, product_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, entry_page,
           referrer_page, device_type, region, dt FROM visit"""))
def dwd_visit(t):
    return t.visit.select("log_id", "user_id", "session_id", "product_id", "event_time", "entry_page", "referrer_page",
                          "device_type", "region", X.day_text("event_time").alias("dt"))


@query("dwd_coupon_dt", sql("""
    SELECT log_id, coupon_id, user_id, order_id, strftime(issue_time, '%Y-%m-%d %H:%M:%S') AS issue_time,
           strftime(use_time, '%Y-%m-%d %H:%M:%S') AS use_time, strftime(coalesce(use_time, issue_time), '%Y-%m-%d') AS dt FROM coupon"""))
def dwd_coupon_dt(t):
    return t.coupon.select("log_id", "coupon_id", "user_id", "order_id", "issue_time", "use_time",
                           X.day_text(F.coalesce("use_time", "issue_time")).alias("dt"))
