"""Queries over change envelopes, wide tables and star joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import cdc as C
from tradewake.operators import dims as D
from tradewake.operators import facts as A
from tradewake.operators import routing as R
from tradewake.operators import wide as J
from tradewake.plans.oracle import sql
from tradewake.plans.registry import query
from tradewake.sources.tables import METHODS, Tables

c = F.col


def envelopes(t: Tables, table: str | None = None):
    """The change topic, parsed; of one table, its messages only, told by their topic key before any text is parsed."""
    return C.parse(t.cdc_text if table is None else t.cdc_text.where(c("source_table") == table))


@query("src_cdc_envelope", sql("""
    SELECT op, tbl AS source_table, key AS position, ts_ms FROM cdc_op
    UNION ALL SELECT 'r', 'base_region', region_id, 1704067200000 FROM dim_region"""))
def src_cdc_envelope(t):
    snapshot = C.snapshot_envelope(t.dim_region, "base_region", F.lit(1_704_067_200_000))
    first = snapshot.select("op", c("source")["table"].alias("source_table"),
                            c("after")["region_id"].cast("bigint").alias("position"), "ts_ms")
    return envelopes(t).select("op", c("source")["table"].alias("source_table"), "position", "ts_ms").unionByName(first)


@query("cdc_clean", sql("""
    SELECT tbl AS source_table, key AS position, op, CAST(op IN ('u','d') AS BIGINT) AS has_before, CAST(op <> 'd' AS BIGINT) AS has_after
    FROM cdc_op"""))
def cdc_clean(t):
    rows = C.clean(envelopes(t))
    return rows.select("source_table", "position", "op", c("before").isNotNull().alias("has_before"), c("after").isNotNull().alias("has_after"))


@query("cdc_config_clean", sql("""
    SELECT op, CAST(user_id AS VARCHAR) AS id, user_name AS login_name
    FROM dim_user JOIN cdc_op ON tbl = 'user_info' AND key = user_id"""))
def cdc_config_clean(t):
    rows = C.config_image(envelopes(t).where(c("source_table") == "user_info"))
    return rows.select("op", c("image")["id"].alias("id"), c("image")["login_name"].alias("login_name"))


@query("cdc_route", sql("""
    SELECT tbl AS source_table, key AS position,
           CASE WHEN tbl = 'order_info' AND op IN ('c','r') THEN 'dwd_trade_order_detail'
                WHEN tbl = 'order_info' AND op = 'u' THEN 'dwd_trade_order_pay'
                WHEN tbl = 'payment_info' AND op IN ('c','r') THEN 'dwd_trade_pay_detail'
                WHEN tbl = 'user_info' AND op IN ('c','r') THEN 'dwd_user_register'
                ELSE 'dwd_dynamic_fallback' END AS sink_table
    FROM cdc_op WHERE op <> 'd'"""))
def cdc_route(t):
    return C.route(envelopes(t)).select("source_table", "position", "sink_table")


@query("cdc_typed_activity", sql("""
    SELECT order_id AS id, status AS activity_type, CAST(amount AS VARCHAR) AS activity_desc,
           strftime(order_time, '%Y-%m-%d %H:%M:%S') AS create_time
    FROM order_info WHERE order_id % 4 <> 3"""))
def cdc_typed_activity(t):
    rows = envelopes(t).where(c("source_table") == "order_info")
    return C.typed(rows, {"order_status": "activity_type", "total_amount": "activity_desc"}, {"create_time": "create_time"})


CDC_SQL = {
    "order": """SELECT 'order_info' AS "table", ['r','c','u','d'][order_id % 4 + 1] AS op, CAST(order_id AS VARCHAR) AS order_id,
        CAST(user_id AS VARCHAR) AS user_id, CAST(order_id % 100 AS VARCHAR) AS sku_id, CAST(province_id AS VARCHAR) AS province_id,
        CAST(amount AS VARCHAR) AS total_amount, CAST(epoch_us(order_time) // 1000 AS VARCHAR) AS create_time
        FROM order_info WHERE order_id % 4 <> 3""",
    "payment": """SELECT 'payment_info' AS "table", ['r','c','u','d'][order_id % 4 + 1] AS op, CAST(order_id + 1000000 AS VARCHAR) AS payment_id,
        CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, CAST(amount AS VARCHAR) AS total_amount,
        CAST(order_id % 4 + 1101 AS VARCHAR) AS payment_type, CAST(epoch_us(pay_time) // 1000 AS VARCHAR) AS payment_time
        FROM order_info WHERE status <> 'CREATED' AND order_id % 4 <> 3""",
    "refund": """SELECT 'refund_info' AS "table", ['r','c','u','d'][(order_id + 1) % 4 + 1] AS op, CAST(order_id + 2000000 AS VARCHAR) AS refund_id,
        CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, CAST(amount AS VARCHAR) AS refund_amount,
        CAST(order_id % 3 + 1501 AS VARCHAR) AS refund_type, CAST(epoch_us(pay_time) // 1000 AS VARCHAR) AS refund_time
        FROM order_info WHERE status = 'REFUNDED' AND (order_id + 1) % 4 <> 3""",
}
for _name, _table in [("order", "order_info"), ("payment", "payment_info"), ("refund", "refund_info")]:
    query(f"cdc_project_{_name}", sql(CDC_SQL[_name]))(lambda t, table=_table: C.project(envelopes(t, table), table))


@query("snapshot_rows", sql("SELECT tbl AS source_table, key AS position FROM cdc_op WHERE op = 'r'"))
def snapshot_rows(t):
    from tradewake.streaming.state import snapshot_only

    return snapshot_only(envelopes(t)).select("source_table", "position")


CONFIG = [
    ("user_info", "dim_user_info", "id,login_name", "info", "id"),
    ("sku_info", "dim_sku_info", "id,sku_name,tm_id", "info", "id"),
]


DIM_BY_CONFIG = sql("""
    SELECT 'dim_user_info' AS sink_table, CAST(user_id AS VARCHAR) AS row_key, user_name AS name, CAST(NULL AS VARCHAR) AS tm_id
    FROM dim_user WHERE user_id % 4 <> 3
    UNION ALL SELECT 'dim_sku_info', CAST(item_id AS VARCHAR), item_name, CAST(brand_id AS VARCHAR) FROM dim_item WHERE item_id % 4 <> 3""")


def dim_columns(state):
    cell = lambda k: F.try_element_at("cells", F.lit(k))
    return state.select("sink_table", "row_key", F.coalesce(cell("login_name"), cell("sku_name")).alias("name"), cell("tm_id").alias("tm_id"))


@query("dim_route_by_config", DIM_BY_CONFIG)
def dim_route_by_config(t):
    return dim_columns(C.dim_state(C.route_dims(envelopes(t), C.config_frame(t.spark, CONFIG))))


@query("dim_table_plan", sql("""
    SELECT 'dim_' || user_id AS sink_table, CASE WHEN user_id % 4 = 3 THEN 'DROP' ELSE 'CREATE' END AS action FROM dim_user"""))
def dim_table_plan(t):
    users = envelopes(t).where(c("source_table") == "user_info")
    named = lambda image: F.when(c(image).isNotNull(), F.create_map(F.lit("sink_table"), F.concat(F.lit("dim_"), c(image)["id"])))
    first = users.withColumn("before", F.lit(None).cast("map<string,string>")).withColumn(
        "after", named("after")).withColumn("op", F.lit("c")).withColumn("ts_ms", c("ts_ms") - 1).where(c("after").isNotNull())
    changes = users.withColumn("after", named("after")).withColumn("before", named("before"))
    return C.table_plan(changes.unionByName(first))


# ---- wide tables -----------------------------------------------------------


def change_logs(t: Tables):
    """Six change logs of the trade topic; headers come in an older and a newer version."""
    item = t.order_item
    ms = F.unix_millis("order_time")
    detail = item.select(c("detail_id").alias("order_detail_id"), "order_id", "sku_id", c("amount").alias("order_price"),
                         c("quantity").alias("sku_num"), ms.alias("ts_ms"))
    info = t.order_info.select("order_id", "user_id", "province_id", c("order_time").alias("order_create_time"), ms.alias("ts_ms"))
    older = info.withColumn("province_id", c("province_id") + 100).withColumn("ts_ms", c("ts_ms") - 1)
    activity = item.where(c("detail_id") % 3 == 0).select(c("detail_id").alias("order_detail_id"),
                                                          (c("detail_id") % 20).alias("activity_id"), ms.alias("ts_ms"))
    coupon = item.where(c("detail_id") % 5 == 0).select(c("detail_id").alias("order_detail_id"),
                                                        (c("detail_id") % 50).alias("coupon_id"), ms.alias("ts_ms"))
    payment = t.order_info.where(c("status") != "CREATED").select(
        "order_id", (c("order_id") % 4 + 1101).alias("payment_type"), c("pay_time").alias("payment_time"),
        c("amount").alias("pay_amount"), F.unix_millis("pay_time").alias("ts_ms"))
    return detail, older.unionByName(info), activity, coupon, payment, refund_log(t)


def refund_log(t: Tables):
    return t.refund.select("order_id", "refund_id", "refund_amount", (c("refund_id") % 5).alias("refund_reason_type"),
                           c("refund_time").alias("refund_create_time"))


REFUND_LATEST = """SELECT order_id, refund_id, refund_amount, refund_id % 5 AS refund_reason_type, refund_time FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY refund_time DESC, refund_id DESC, refund_amount DESC) AS rn FROM refund) WHERE rn = 1"""


@query("latest_refund", sql(
    "SELECT order_id, refund_id, CAST(refund_amount AS DOUBLE) AS refund_amount, refund_reason_type, "
    "strftime(refund_time, '%Y-%m-%d %H:%M:%S') AS refund_create_time FROM refund_latest", refund_latest=REFUND_LATEST))
def latest_refund(t):
    return J.latest_refund(refund_log(t))


ORDER_WIDE = sql("""
    SELECT d.detail_id AS order_detail_id, d.order_id, d.sku_id, CAST(d.amount AS DOUBLE) AS order_price, d.quantity AS sku_num,
           i.user_id, i.province_id, strftime(i.order_time, '%Y-%m-%d %H:%M:%S') AS order_create_time,
           CASE WHEN d.detail_id % 3 = 0 THEN d.detail_id % 20 END AS activity_id,
           CASE WHEN d.detail_id % 5 = 0 THEN d.detail_id % 50 END AS coupon_id,
           CASE WHEN i.status <> 'CREATED' THEN d.order_id % 4 + 1101 END AS payment_type,
           strftime(i.pay_time, '%Y-%m-%d %H:%M:%S') AS payment_time,
           CASE WHEN i.status <> 'CREATED' THEN CAST(i.amount AS DOUBLE) END AS pay_amount,
           r.refund_id, CAST(r.refund_amount AS DOUBLE) AS refund_amount, r.refund_reason_type,
           strftime(r.refund_time, '%Y-%m-%d %H:%M:%S') AS refund_create_time,
           CASE WHEN r.order_id IS NOT NULL THEN 'refund' WHEN i.status <> 'CREATED' THEN 'payment' ELSE 'order' END AS event_type,
           epoch_us(d.order_time) // 1000 AS ts
    FROM detail_latest d JOIN order_info i ON d.order_id = i.order_id LEFT JOIN refund_latest r ON d.order_id = r.order_id""",
    detail_latest="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY order_time DESC, sku_id DESC, amount DESC, quantity DESC) AS rn
                     FROM order_item) WHERE rn = 1""", refund_latest=REFUND_LATEST)


@query("order_wide", ORDER_WIDE)
def order_wide(t):
    return J.order_wide(*change_logs(t))


def catalog(t: Tables):
    """Item, product, category and trademark tables keyed by text-like ids."""
    part = t.dim_item
    sku = part.select(c("item_id").alias("id"), (c("item_id") % 100).alias("spu_id"), c("category_id").alias("category3_id"),
                      c("brand_id").alias("tm_id"), c("item_name").alias("sku_name"))
    spu = part.select((c("item_id") % 100).alias("id")).distinct().withColumn("spu_name", F.concat(F.lit("spu_"), c("id").cast("string")))
    category = t.dim_category.select(c("category_id").alias("id"), c("category_name").alias("name"))
    trademark = part.select(c("brand_id").alias("id"), c("brand_name").alias("tm_name")).distinct()
    user = t.dim_user.select(c("user_id").alias("id"), c("user_name").alias("name"), "user_level")
    province = t.dim_province.select(c("province_id").alias("id"), c("province_name").alias("name"))
    return sku, spu, category, trademark, user, province


@query("order_enrich", sql("""
    SELECT o.detail_id, o.sku_key AS sku_id, p.item_name AS dim_sku_name, p.item_id % 100 AS spu_id,
           'spu_' || (p.item_id % 100) AS dim_spu_spu_name, p.category_id AS category3_id, 'Category ' || p.category_id AS dim_category3_name,
           p.brand_id AS tm_id, p.brand_name AS dim_tm_tm_name, u.user_name AS dim_user_name, u.user_level AS dim_user_user_level,
           v.province_name AS dim_province_name
    FROM (SELECT *, CASE WHEN detail_id % 53 = 0 THEN NULL WHEN detail_id % 59 = 0 THEN ' ' ELSE CAST(product_id AS VARCHAR) END AS sku_key,
                 user_id % 25 AS province FROM order_item) o
    LEFT JOIN dim_item p ON o.sku_key = CAST(p.item_id AS VARCHAR)
    LEFT JOIN dim_user u ON o.user_id = u.user_id LEFT JOIN dim_province v ON o.province = v.province_id"""))
def order_enrich(t):
    d = c("detail_id")
    key = F.when(d % 53 == 0, F.lit(None)).when(d % 59 == 0, F.lit(" ")).otherwise(c("product_id").cast("string"))
    orders = t.order_item.select("detail_id", key.alias("sku_id"), "user_id", (c("user_id") % 25).alias("province_id"))
    *parts, user, province = catalog(t)
    item = t.stored("item_dimension", lambda: J.item_dimension(*parts))
    return J.enrich_orders(orders, item, user, province).select(
        "detail_id", "sku_id", "dim_sku_name", "spu_id", "dim_spu_spu_name", "category3_id", "dim_category3_name", "tm_id",
        "dim_tm_tm_name", "dim_user_name", "dim_user_user_level", "dim_province_name")


@query("behavior_enrich", sql("""
    SELECT e.event_type, e.event_ts, e.sku_id, p.item_name AS sku_name, p.brand_id AS tm_id, u.user_name AS name FROM (
        SELECT 'start' AS event_type, uid, ts_ms AS event_ts, CAST(NULL AS VARCHAR) AS sku_id FROM good_log WHERE log_type = 'start'
        UNION ALL SELECT 'page', uid, ts_ms, item FROM good_log WHERE has_page
        UNION ALL SELECT 'display', uid, ts_ms, display_item FROM display
        UNION ALL SELECT 'action', uid, action_ts, action_item FROM action) e
    LEFT JOIN dim_item p ON e.sku_id = CAST(p.item_id AS VARCHAR) LEFT JOIN dim_user u ON e.uid = CAST(u.user_id AS VARCHAR)"""))
def behavior_enrich(t):
    sku, _, _, _, user, _ = catalog(t)
    return J.enrich_behaviour(R.behaviour(R.parse_log(t.log_text)), sku.select("id", "sku_name", "tm_id"), user.select("id", "name")).select(
        "event_type", "event_ts", "sku_id", "sku_name", "tm_id", "name")


@query("lookup_join", sql("""
    SELECT event_id, uid, coalesce(user_name, 'unknown') AS user_name, coalesce(user_level, 'none') AS user_level
    FROM log LEFT JOIN dim_user ON uid = CAST(dim_user.user_id AS VARCHAR)"""))
def lookup_join(t):
    dim = t.dim_user.select("user_id", "user_name", "user_level")
    return J.look_up_or_default(t.log.select("event_id", "uid"), dim, "uid", "user_id", {"user_name": "unknown", "user_level": "none"})


@query("interval_join", sql("""
    SELECT l.event_id, r.event_id AS info_event_id, l.user_id, r.value AS info_value
    FROM log l JOIN log r ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 30 MINUTE AND l.ts + INTERVAL 2 HOUR
    WHERE l.event_type = 'click' AND r.event_type = 'purchase'"""))
def interval_join(t):
    left = t.log.where(c("event_type") == "click").select("event_id", "user_id", "ts")
    right = t.log.where(c("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    return J.interval_join_batch(left, right, "user_id", "ts", "ts", 1800, 7200).select("event_id", "info_event_id", "user_id", "info_value")


def category_levels(t: Tables):
    size = t.dim_item.select("category_id").distinct()
    text = lambda x: x.cast("string")
    c3 = size.select(c("category_id").alias("category3_id"), F.concat(F.lit("c3_"), text(c("category_id"))).alias("category3_name"),
                     (c("category_id") % 10).alias("category2_id"))
    # the second level 7 has another id here, so third levels below it find none
    second = F.when(c("category_id") % 10 == 7, 107).otherwise(c("category_id") % 10)
    c2 = size.select(second.alias("category2_id")).distinct().select(
        "category2_id", F.concat(F.lit("c2_"), text(c("category2_id"))).alias("category2_name"), (c("category2_id") % 3).alias("category1_id"))
    c1 = size.select((c("category_id") % 3).alias("category1_id")).distinct().select(
        "category1_id", F.concat(F.lit("c1_"), text(c("category1_id"))).alias("category1_name"))
    return c3, c2, c1


PATH_SQL = """SELECT c3.category_id AS category3_id, 'c3_' || c3.category_id AS category3_name, c3.category_id % 10 AS category2_id,
    CASE WHEN c3.category_id % 10 <> 7 THEN 'c2_' || (c3.category_id % 10) END AS category2_name,
    CASE WHEN c3.category_id % 10 <> 7 THEN (c3.category_id % 10) % 3 END AS category1_id,
    CASE WHEN c3.category_id % 10 <> 7 THEN 'c1_' || ((c3.category_id % 10) % 3) END AS category1_name FROM dim_category c3"""


@query("activity_sku_wide", sql("""
    SELECT p.item_id % 30 AS activity_id, p.item_id AS sku_id, r.rule_id, 'act_' || (p.item_id % 30) AS activity_name,
           p.item_name AS sku_name, h.category1_id, h.category1_name, h.category2_id, h.category2_name, p.category_id AS category3_id,
           h.category3_name, p.brand_id AS tm_id, p.brand_name AS tm_name
    FROM dim_item p JOIN (SELECT DISTINCT item_id % 25 AS activity_id FROM dim_item) a ON p.item_id % 30 = a.activity_id
    LEFT JOIN (SELECT DISTINCT category_id AS rule_id, category_id % 20 AS activity_id FROM dim_category) r ON p.item_id % 30 = r.activity_id
    LEFT JOIN path h ON p.category_id = h.category3_id""", path=PATH_SQL))
def activity_sku_wide(t):
    item = t.dim_item
    link = item.select((c("item_id") % 30).alias("activity_id"), c("item_id").alias("sku_id"))
    # links go to 30 activities; 25 of them exist and 20 have rules
    activity = item.select((c("item_id") % 25).alias("activity_id")).distinct().withColumn(
        "activity_name", F.concat(F.lit("act_"), c("activity_id").cast("string")))
    rule = t.dim_category.select(c("category_id").alias("rule_id"), (c("category_id") % 20).alias("activity_id"))
    sku = item.select(c("item_id").alias("sku_id"), c("item_name").alias("sku_name"), c("category_id").alias("category3_id"), c("brand_id").alias("tm_id"))
    tm = item.select(c("brand_id").alias("tm_id"), c("brand_name").alias("tm_name")).distinct()
    return J.activity_sku_wide(link, activity, rule, sku, D.category_path(*category_levels(t)), tm)


@query("sku_snowflake", sql("""
    SELECT p.item_id AS sku_id, CAST(p.price AS DOUBLE) AS price, p.item_name AS sku_name, p.item_id % 100 AS spu_id, 'spu_' || (p.item_id % 100) AS spu_name,
           p.category_id AS category3_id, h.category3_name, h.category2_id, h.category2_name, h.category1_id, h.category1_name, k.keyword, coalesce(b.n, 0) AS buyer_count
    FROM dim_item p LEFT JOIN path h ON p.category_id = h.category3_id
    LEFT JOIN (SELECT DISTINCT k % 3 AS category1_id, 'kw' || (k % 10) AS keyword FROM log) k ON h.category1_id = k.category1_id
    LEFT JOIN (SELECT l_partkey AS sku_id, count(DISTINCT o_custkey) AS n FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1) b ON p.item_id = b.sku_id""",
    path=PATH_SQL))
def sku_snowflake(t):
    item = t.dim_item
    sku = item.select(c("item_id").alias("sku_id"), "price", c("item_name").alias("sku_name"), (c("item_id") % 100).alias("spu_id"),
                      c("category_id").alias("category3_id"))
    spu = item.select((c("item_id") % 100).alias("spu_id")).distinct().withColumn("spu_name", F.concat(F.lit("spu_"), c("spu_id").cast("string")))
    words = t.log.select((c("k") % 3).alias("category1_id"), (c("k") % 10).alias("word")).distinct().select(
        "category1_id", F.concat(F.lit("kw"), c("word").cast("string")).alias("keyword"))
    buyers = t.read("lineitem").select(c("l_partkey").alias("sku_id"), c("l_orderkey").alias("order_id")).join(
        t.order_info.select("order_id", "user_id"), "order_id", "left").drop("order_id")
    return D.sku_snowflake(sku, spu, D.category_path(*category_levels(t)), words, buyers)


@query("order_detail_user", sql("""
    SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, o_custkey AS user_id, l_partkey AS sku_id,
           CAST(l_quantity AS BIGINT) AS sku_num, CAST(l_extendedprice AS DOUBLE) AS split_final_amount
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""))
def order_detail_user(t):
    line = t.read("lineitem").select((c("l_orderkey") * 10 + c("l_linenumber")).alias("id"), c("l_orderkey").alias("order_id"),
                                     c("l_partkey").alias("sku_id"), c("l_quantity").cast("bigint").alias("sku_num"),
                                     c("l_extendedprice").alias("split_final_amount"))
    return line.join(t.order_info.select("order_id", "user_id"), "order_id", "left")


@query("payment_with_order", sql("""
    SELECT order_id + 1000000 AS id, order_id, user_id, strftime(pay_time, '%Y-%m-%d %H:%M:%S') AS callback_time,
           coalesce(strftime(pay_time, '%Y-%m-%d'), '9999-99-99') AS dt FROM order_info"""))
def payment_with_order(t):
    pay = t.order_info.select((c("order_id") + 1_000_000).alias("id"), "order_id", "user_id", c("pay_time").alias("callback_time"))
    return pay.join(t.order_info.select("order_id"), "order_id", "left").withColumn("dt", A.payment_day("callback_time"))


@query("paid_order_detail", sql("""
    SELECT order_id, detail_id AS item_id, user_id, sku_id, product_id, quantity, CAST(amount AS DOUBLE) AS amount,
           strftime(pay_time, '%Y-%m-%d %H:%M:%S') AS pay_time, strftime(pay_time, '%Y-%m-%d') AS dt
    FROM order_item WHERE status = 'PAID' AND pay_time IS NOT NULL"""))
def paid_order_detail(t):
    return paid_detail(t)


def paid_detail(t: Tables):
    line = t.read("lineitem").select(
        c("l_orderkey").alias("order_id"), (c("l_orderkey") * 10 + c("l_linenumber")).alias("item_id"),
        (c("l_partkey") * 10 + c("l_linenumber") % 3).alias("sku_id"), c("l_partkey").alias("product_id"),
        c("l_quantity").cast("bigint").alias("quantity"), c("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    head = t.order_info.select("order_id", "user_id", "status", "pay_time")
    return A.header_line(head, line).drop("status")


# ---- star joins ------------------------------------------------------------


def dim_method(t: Tables):
    return D.distinct_labelled(t.payment, "payment_method", X.method_name("payment_method"), "method_name")


def item_keyed(df):
    return df.withColumnRenamed("product_id", "item_id").withColumn("date_key", X.date_key(F.to_date("dt")))


DATE_KEY = "CAST(replace({}.dt, '-', '') AS BIGINT) AS date_key"
DEVICE = "CASE WHEN terminal = 'PC' THEN 'PC' ELSE 'Mobile' END"


@query("dwd_item_visit", sql(f"""
    SELECT v.log_id AS visit_id, v.user_id, v.product_id AS item_id, {DATE_KEY.format('v')}, v.dwell_seconds, v.terminal, {DEVICE} AS device,
           i.category_id, CAST(i.price AS DOUBLE) AS price FROM visit v JOIN dim_item i ON v.product_id = i.item_id"""))
def dwd_item_visit(t):
    fact = item_keyed(t.visit.drop("device_type")).withColumnRenamed("log_id", "visit_id")
    return A.star(A.labelled(fact, "terminal", device_type=X.device_type("terminal")), [(t.dim_item.select("item_id", "category_id", "price"), "item_id")]).select(
        "visit_id", "user_id", "item_id", "date_key", "dwell_seconds", "terminal", c("device_type").alias("device"), "category_id", "price")


ACTIVITY_ID = "CASE WHEN is_group_buy = 1 THEN 'JUHUASUAN' WHEN is_presale = 1 THEN 'PRESALE-' || presale_stage ELSE 'NORMAL' END"
METHOD_NAME = "CASE payment_method WHEN 'ALIPAY' THEN '支付宝' WHEN 'WECHAT' THEN '微信支付' WHEN 'CCB' THEN '建设银行' ELSE '其他支付' END"
STAGE_NAME = "CASE presale_stage WHEN 'DEPOSIT' THEN '定金阶段' WHEN 'FINAL' THEN '尾款阶段' ELSE '全款阶段' END"


@query("dwd_payment", sql(f"""
    SELECT p.payment_id, p.order_id, p.product_id AS item_id, p.user_id, {DATE_KEY.format('p')}, CAST(p.payment_amount AS DOUBLE) AS payment_amount,
           p.payment_method, {METHOD_NAME} AS method_name, {ACTIVITY_ID} AS activity_id,
           CASE WHEN is_group_buy = 1 THEN '聚划算' WHEN is_presale = 1 THEN '预售活动-' || {STAGE_NAME} ELSE '普通商品活动' END AS activity_name,
           i.category_id FROM payment p JOIN dim_item i ON p.product_id = i.item_id"""))
def dwd_payment(t):
    fact = A.with_activity(item_keyed(t.payment))
    return A.star(A.labelled(fact, "payment_method", method_name=X.method_name("payment_method")), [(t.dim_item.select("item_id", "category_id"), "item_id")]).select(
        "payment_id", "order_id", "item_id", "user_id", "date_key", "payment_amount", "payment_method", "method_name",
        "activity_id", "activity_name", "category_id")


@query("dwd_order", sql(f"""
    SELECT o.order_id, o.product_id AS item_id, o.user_id, {DATE_KEY.format('o')}, o.quantity, CAST(o.amount AS DOUBLE) AS order_amount,
           o.status AS order_status, i.category_id, CAST(i.price AS DOUBLE) AS price FROM order_item o JOIN dim_item i ON o.product_id = i.item_id"""))
def dwd_order(t):
    return A.star(item_keyed(t.order_item), [(t.dim_item.select("item_id", "category_id", "price"), "item_id")]).select(
        "order_id", "item_id", "user_id", "date_key", "quantity", c("amount").alias("order_amount"), c("status").alias("order_status"), "category_id", "price")


@query("dwd_fav", sql(f"""
    SELECT f.log_id AS fav_id, f.user_id, f.product_id AS item_id, {DATE_KEY.format('f')}, f.action_type, i.category_id
    FROM fav f JOIN dim_item i ON f.product_id = i.item_id"""))
def dwd_fav(t):
    return A.star(item_keyed(t.fav), [(t.dim_item.select("item_id", "category_id"), "item_id")]).select(
        c("log_id").alias("fav_id"), "user_id", "item_id", "date_key", "action_type", "category_id")


@query("dwd_cart", sql(f"""
    SELECT f.log_id AS cart_id, f.user_id, f.product_id AS item_id, {DATE_KEY.format('f')}, f.quantity, f.action_type, i.category_id,
           CAST(i.price AS DOUBLE) AS price FROM cart f JOIN dim_item i ON f.product_id = i.item_id"""))
def dwd_cart(t):
    return A.star(item_keyed(t.cart), [(t.dim_item.select("item_id", "category_id", "price"), "item_id")]).select(
        c("log_id").alias("cart_id"), "user_id", "item_id", "date_key", "quantity", "action_type", "category_id", "price")


@query("dwd_micro", sql(f"""
    SELECT f.log_id AS micro_id, f.user_id, f.product_id AS item_id, {DATE_KEY.format('f')}, f.duration_sec, f.terminal, {DEVICE} AS device_type,
           i.category_id FROM micro f JOIN dim_item i ON f.product_id = i.item_id"""))
def dwd_micro(t):
    return A.star(A.labelled(item_keyed(t.micro), "terminal", device_type=X.device_type("terminal")), [(t.dim_item.select("item_id", "category_id"), "item_id")]).select(
        c("log_id").alias("micro_id"), "user_id", "item_id", "date_key", "duration_sec", "terminal", "device_type", "category_id")


def dim_activity(t: Tables):
    """Activities that occur in the payments, with names and types."""
    return A.with_activity(t.payment).select("activity_id", "activity_name").distinct()


@query("dim_payment_method", sql(f"SELECT DISTINCT payment_method, {METHOD_NAME} AS method_name FROM payment"))
def dim_payment_method(t):
    return dim_method(t)


@query("dim_activity", sql(f"""
    SELECT DISTINCT {ACTIVITY_ID} AS activity_id,
           CASE WHEN is_group_buy = 1 THEN '聚划算' WHEN is_presale = 1 THEN '预售活动-' || {STAGE_NAME} ELSE '普通商品活动' END AS activity_name FROM payment"""))
def dim_activity_stage(t):
    return dim_activity(t)


@query("payment_activity", sql(f"""
    SELECT p.payment_id, p.order_id, p.product_id AS item_id, p.user_id, CAST(p.payment_amount AS DOUBLE) AS payment_amount,
           o.quantity, {METHOD_NAME} AS method_name, {ACTIVITY_ID} AS activity_id,
           CASE WHEN is_group_buy = 1 THEN NULL WHEN is_presale = 1 THEN '预售活动-' || {STAGE_NAME} ELSE '普通商品活动' END AS activity_name, i.category_id
    FROM payment p JOIN dim_item i ON p.product_id = i.item_id
    LEFT JOIN (SELECT order_id, product_id, CAST(sum(quantity) AS BIGINT) AS quantity FROM order_item GROUP BY ALL) o
      ON p.order_id = o.order_id AND p.product_id = o.product_id"""))
def payment_activity(t):
    t.share_lines()
    pay = t.payment.withColumnRenamed("product_id", "item_id").drop("quantity")
    lines = t.order_item.select("order_id", c("product_id").alias("item_id"), "quantity")
    # the dim has another id for one activity, so its payments find none
    known = t.stored("dim_activity", lambda: dim_activity(t))
    known = known.withColumn("activity_id", F.when(c("activity_id") == "JUHUASUAN", "JUHUASUAN_OLD").otherwise(c("activity_id")))
    return A.payment_activity(pay, t.dim_item.select("item_id", "category_id"), lines, known).select(
        "payment_id", "order_id", "item_id", "user_id", "payment_amount", "quantity", "method_name", "activity_id", "activity_name", "category_id")


@query("insert_if_absent", sql("""
    SELECT user_id, CASE WHEN user_id % 3 <> 0 THEN 'kept' ELSE user_name END AS user_name FROM dim_user"""))
def insert_if_absent(t):
    rows = t.dim_user.select("user_id", "user_name")
    target = rows.where(c("user_id") % 3 != 0).withColumn("user_name", F.lit("kept"))
    return J.insert_if_absent(target, rows, ["user_id"])


@query("search_item_attribution", sql("""
    SELECT v.item AS sku_id, w.item AS keyword, count(*) AS num FROM page_log v JOIN page_log w ON v.uid = w.uid AND v.dt = w.dt
    WHERE v.item_type = 'sku_id' AND w.item_type = 'keyword' AND w.last_page_id = 'search' GROUP BY ALL"""))
def search_item_attribution(t):
    return J.search_attribution(t.page_log)


@query("sensitive_words", sql("""
    SELECT conv_id, turn, text AS msg, CASE WHEN w.word IS NOT NULL THEN 1 ELSE 0 END::BIGINT AS is_violation,
           CASE WHEN w.word IS NOT NULL THEN 'P0' ELSE '' END AS violation_grade,
           CASE WHEN w.word IS NOT NULL THEN w.word ELSE '' END AS violation_msg
    FROM (SELECT conv_id, turn, text, list_extract(string_split(text, ','), -1) AS last FROM conversations) m
    LEFT JOIN (SELECT DISTINCT list_extract(string_split(text, ','), -1) AS word FROM conversations WHERE role = 'user') w ON m.last = w.word"""))
def sensitive_words(t):
    talk = t.read("conversations")
    words = talk.where(c("role") == "user").select(X.last_part("text").alias("word"))
    return J.sensitive_words(talk, words).select("conv_id", "turn", c("text").alias("msg"), "is_violation", "violation_grade", "violation_msg")
