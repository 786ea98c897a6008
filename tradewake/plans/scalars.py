"""Queries over scalar functions, calendars and versioned dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import dims as D
from tradewake.plans.oracle import percent, ratio, rounded, sql
from tradewake.plans.registry import query
from tradewake.sources.tables import AS_OF, Tables, log_text_view

c = F.col


@query("fn_json", sql("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS by_path, CAST(json_extract_string(props, '$.k') AS BIGINT) AS by_struct,
           '{"id":' || event_id || ',"kind":"' || event_type || '"}' AS built FROM events"""))
def fn_json(t):
    return t.read("events").select(
        "event_id", F.get_json_object("props", "$.k").cast("bigint").alias("by_path"), F.from_json("props", "k bigint")["k"].alias("by_struct"),
        F.to_json(F.struct(c("event_id").alias("id"), c("event_type").alias("kind"))).alias("built"))


@query("fn_epoch_date", sql("""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS second, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS date_key,
           epoch_us(date_trunc('second', ts)) // 1000 AS parsed FROM log"""))
def fn_epoch_date(t):
    ts = X.from_millis("ts_ms")
    return t.log.select("event_id", X.day_text(ts).alias("day"), X.time_text(ts).alias("second"), X.date_key(ts).alias("date_key"),
                        F.unix_millis(F.to_timestamp(X.time_text(ts))).alias("parsed"))


@query("fn_date_parts", sql("""
    SELECT o_orderkey AS id, year(o_orderdate)::BIGINT AS y, quarter(o_orderdate)::BIGINT AS q, month(o_orderdate)::BIGINT AS m, day(o_orderdate)::BIGINT AS d,
           weekofyear(o_orderdate)::BIGINT AS w, dayofweek(o_orderdate)::BIGINT + 1 AS dow, dayname(o_orderdate) AS day_name,
           strftime(o_orderdate, '%G%V') AS week_key FROM orders"""))
def fn_date_parts(t):
    d = c("o_orderdate").cast("date")
    return t.read("orders").select(c("o_orderkey").alias("id"), F.year(d).alias("y"), F.quarter(d).alias("q"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"),
                                   F.weekofyear(d).alias("w"), F.dayofweek(d).alias("dow"), F.date_format(d, "EEEE").alias("day_name"), X.week_key(d).alias("week_key"))


@query("fn_date_arith", sql("""
    SELECT order_id, strftime(CAST(order_time AS DATE) + 7, '%Y-%m-%d') AS later, strftime(CAST(order_time AS DATE) - 365, '%Y-%m-%d') AS year_before,
           strftime(order_time + INTERVAL 90 MINUTE, '%Y-%m-%d %H:%M:%S') AS shifted, CASE WHEN CAST(order_time AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-31' THEN 1 ELSE 0 END::BIGINT AS inside,
           epoch_us(order_time) // 1000000 AS unix, strftime(order_time, '%Y%m%d') AS day FROM order_info"""))
def fn_date_arith(t):
    d = c("order_time").cast("date")
    unix = F.unix_timestamp("order_time")
    return t.order_info.select("order_id", X.day_text(F.date_add(d, 7)).alias("later"), X.day_text(F.date_sub(d, 365)).alias("year_before"),
                               X.time_text(c("order_time") + F.expr("interval 90 minutes")).alias("shifted"), d.between("2024-01-10", "2024-01-31").cast("int").alias("inside"),
                               unix.alias("unix"), F.from_unixtime(unix, "yyyyMMdd").alias("day"))


@query("fn_conditional", sql("""
    SELECT order_id, CASE WHEN amount > 300000 THEN 'big' WHEN amount > 100000 THEN 'mid' ELSE 'small' END AS size, if(status = 'PAID', 1, 0)::BIGINT AS paid,
           coalesce(strftime(pay_time, '%Y-%m-%d'), 'open') AS paid_on, nullif(status, 'CREATED') AS moved FROM order_info"""))
def fn_conditional(t):
    return t.order_info.select("order_id", F.when(c("amount") > 300000, "big").when(c("amount") > 100000, "mid").otherwise("small").alias("size"),
                               F.when(c("status") == "PAID", 1).otherwise(0).alias("paid"), F.nvl(X.day_text("pay_time"), F.lit("open")).alias("paid_on"),
                               F.nullif(c("status"), F.lit("CREATED")).alias("moved"))


@query("fn_numeric", sql(f"""
    SELECT event_id, greatest(value, 10.0::DOUBLE) AS hi, least(value, 100.0::DOUBLE) AS lo, {rounded('value / 3', 2)} AS r, CAST(floor(value) AS BIGINT) AS f,
           CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS money FROM events"""))
def fn_numeric(t):
    return t.read("events").select("event_id", F.greatest("value", F.lit(10.0)).alias("hi"), F.least("value", F.lit(100.0)).alias("lo"),
                                   F.round(c("value") / 3, 2).alias("r"), F.floor("value").alias("f"), c("value").cast("decimal(18,2)").cast("string").alias("money"))


@query("fn_string", sql("""
    SELECT user_id, user_name || '-' || user_level AS joined, concat_ws('.', user_name, user_level) AS dotted, split_part(user_name, '#', 2) AS tail,
           upper(left(lower(user_level), 1)) || substr(lower(user_level), 2) AS capitalised, lower(left(user_level, 1)) || substr(user_level, 2) AS lowered,
           repeat('0', CAST(user_id % 5 AS BIGINT)) AS zeros, CASE WHEN trim(user_name) = '' THEN 1 ELSE 0 END::BIGINT AS blank FROM dim_user"""))
def fn_string(t):
    return t.dim_user.select("user_id", F.concat("user_name", F.lit("-"), "user_level").alias("joined"), F.concat_ws(".", "user_name", "user_level").alias("dotted"),
                             X.last_part("user_name", "#").alias("tail"), X.capitalise_first(F.lower("user_level")).alias("capitalised"),
                             X.lower_first("user_level").alias("lowered"), F.repeat(F.lit("0"), (c("user_id") % 5).cast("int")).alias("zeros"),
                             (~X.not_blank("user_name")).cast("int").alias("blank"))


@query("fn_sequence", sql("SELECT user_id, i - 1 AS pos, d AS recent_days FROM dim_user, (VALUES (1::BIGINT, 1::BIGINT), (2, 7), (3, 30)) AS p(i, d)"))
def fn_sequence(t):
    return t.dim_user.select("user_id", F.posexplode(F.array(F.lit(1), F.lit(7), F.lit(30))).alias("pos", "recent_days"))


@query("fn_nested", sql("SELECT event_id, mid, page_id, k FROM good_log WHERE has_page"))
def fn_nested(t):
    from tradewake.operators.routing import having, parse_log

    text = log_text_view(t.log, "k")
    rows = having(parse_log(text), "page").withColumn("m", F.create_map(F.lit("id"), c("event_id").cast("string")))
    return rows.select(c("m")["id"].cast("bigint").alias("event_id"), "rec.common.mid", "rec.page.page_id", "k")


@query("fn_ratio", sql(f"""
    SELECT product_id, {ratio('sum(CASE WHEN event_type = $$click$$ THEN 1 ELSE 0 END)', 'sum(CASE WHEN event_type = $$view$$ THEN 1 ELSE 0 END)')} AS ratio,
           {percent('sum(CASE WHEN event_type = $$click$$ THEN 1 ELSE 0 END)', 'sum(CASE WHEN event_type = $$view$$ THEN 1 ELSE 0 END)')} AS pct
    FROM log GROUP BY product_id""").replace("$$", "'"))
def fn_ratio(t):
    counts = t.log.groupBy("product_id").agg(
        F.sum((c("event_type") == "click").cast("int")).alias("a"), F.sum((c("event_type") == "view").cast("int")).alias("b"))
    return counts.select("product_id", X.ratio("a", "b").alias("ratio"), X.percent("a", "b").alias("pct"))


@query("dim_date", sql("""
    SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, strftime(d, '%Y-%m-%d') AS day, day(d)::BIGINT AS day_of_month, month(d)::BIGINT AS month, year(d)::BIGINT AS year,
           weekofyear(d)::BIGINT AS week_of_year, quarter(d)::BIGINT AS quarter, dayname(d) AS day_name, CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END::BIGINT AS is_weekend
    FROM (SELECT unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS d FROM orders)"""))
def dim_date(t):
    """Every day between the first and the last order."""
    span = t.read("orders").agg(F.min("o_orderdate").cast("date").alias("first"), F.max("o_orderdate").cast("date").alias("last"))
    return D.date_parts(span.select(F.explode(F.sequence("first", "last")).alias("day")), "day")


# ---- versioned dimensions ---------------------------------------------------------

VERSION = f"'{AS_OF}' AS effective_date, '9999-12-31' AS end_date, 'Y' AS current_flag"


@query("scd2_product", sql(f"SELECT row_number() OVER (ORDER BY item_id) AS product_key, item_id, item_name, category_id, brand_id, {VERSION} FROM dim_item"))
def scd2_product(t):
    return products(t)


def products(t: Tables):
    rows = t.dim_item.select("item_id", "item_name", "category_id", "brand_id")
    return D.initial_versions(rows, "item_id", "product_key", AS_OF)


@query("scd2_sku", sql(f"""
    SELECT row_number() OVER (ORDER BY s.sku_id) AS sku_key, s.sku_id, p.product_key, {VERSION}
    FROM (SELECT DISTINCT sku_id, product_id FROM order_item) s JOIN (SELECT row_number() OVER (ORDER BY item_id) AS product_key, item_id FROM dim_item) p ON s.product_id = p.item_id"""))
def scd2_sku(t):
    sku = t.order_item.select("sku_id", c("product_id").alias("item_id")).distinct()
    current = products(t).where(c("current_flag") == "Y").select("item_id", "product_key")
    return D.initial_versions(sku.join(current, "item_id").select("sku_id", "product_key"), "sku_id", "sku_key", AS_OF)


@query("scd2_vendor", sql(f"SELECT row_number() OVER (ORDER BY shop_id) AS vendor_key, shop_id AS vendor_id, shop_name AS vendor_name, {VERSION} FROM dim_shop"))
def scd2_vendor(t):
    return D.initial_versions(t.dim_shop.select(c("shop_id").alias("vendor_id"), c("shop_name").alias("vendor_name")), "vendor_id", "vendor_key", AS_OF)


@query("scd2_competitor", sql(f"""
    SELECT row_number() OVER (ORDER BY item_id) AS comp_product_key, item_id AS comp_product_id, item_name AS comp_name, CAST(price AS DOUBLE) AS comp_price, {VERSION}
    FROM dim_item"""))
def scd2_competitor(t):
    rows = t.dim_item.select(c("item_id").alias("comp_product_id"), c("item_name").alias("comp_name"), c("price").alias("comp_price"))
    return D.initial_versions(rows, "comp_product_id", "comp_product_key", AS_OF)


@query("scd2_user", sql(f"""
    SELECT user_key, user_id, user_level, '{AS_OF}' AS effective_date, CASE WHEN user_id % 10 = 0 THEN '2024-02-29' ELSE '9999-12-31' END AS end_date,
           CASE WHEN user_id % 10 = 0 THEN 'N' ELSE 'Y' END AS current_flag FROM keyed
    UNION ALL SELECT row_number() OVER (ORDER BY user_id) + (SELECT count(*) FROM keyed), user_id, 'VIP', '2024-03-01', '9999-12-31', 'Y' FROM keyed WHERE user_id % 10 = 0""",
    keyed="SELECT row_number() OVER (ORDER BY user_id) AS user_key, user_id, user_level FROM dim_user"))
def scd2_user(t):
    """First load, then a second one in which every tenth user has a new level."""
    rows = t.dim_user.select("user_id", "user_level")
    first = t.stored("dim_user_versions", lambda: D.initial_versions(rows, "user_id", "user_key", AS_OF))
    later = rows.withColumn("user_level", F.when(c("user_id") % 10 == 0, "VIP").otherwise(c("user_level")))
    return D.next_versions(first, later, "user_id", "user_key", ["user_level"], "2024-03-01")
