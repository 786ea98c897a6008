"""Queries over sources, sinks and dimension tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import cdc as C
from tradewake.operators import dims as D
from tradewake.operators.positions import first_n
from tradewake.plans.oracle import sql
from tradewake.plans.registry import query
from tradewake.session import fresh_path
from tradewake.sources import readers as R
from tradewake.sources import writers as W
from tradewake.sources.tables import MONEY, Tables, log_text_view, log_view, order_info_view
from tradewake.streaming import runner

c = F.col


def streamed_log(t: Tables):
    return log_text_view(log_view(t.stream("events")))


@query("src_stream_text_s", sql("SELECT event_id, 'topic_' || log_type AS topic FROM log"))
def src_stream_text_s(t):
    return runner.to_table(streamed_log(t).select("event_id", "topic"), "stream-text")


# ---- dimension tables --------------------------------------------------------------


@query("dim_copy", sql("""
    SELECT 'user' AS dim, CAST(user_id AS VARCHAR) AS row_key, user_level AS a, CAST(province_id AS VARCHAR) AS b FROM dim_user
    UNION ALL SELECT 'shop', CAST(shop_id AS VARCHAR), shop_name, CAST(province_id AS VARCHAR) FROM dim_shop
    UNION ALL SELECT 'item', CAST(item_id AS VARCHAR), item_name, CAST(price AS VARCHAR) FROM dim_item
    UNION ALL SELECT DISTINCT 'sku', CAST(sku_id AS VARCHAR), CAST(product_id AS VARCHAR), CAST(shop_id AS VARCHAR) FROM order_item"""))
def dim_copy(t):
    def copy(df, kind, key, a, b):
        return D.as_text(df, [key, a, b]).toDF("row_key", "a", "b").withColumn("dim", F.lit(kind))

    out = copy(t.dim_user, "user", "user_id", "user_level", "province_id")
    out = out.unionByName(copy(t.dim_shop, "shop", "shop_id", "shop_name", "province_id"))
    out = out.unionByName(copy(t.dim_item, "item", "item_id", "item_name", "price"))
    return out.unionByName(copy(t.order_item.select("sku_id", "product_id", "shop_id").distinct(), "sku", "sku_id", "product_id", "shop_id"))


@query("dim_category_distinct", sql("SELECT DISTINCT CAST(category_id AS VARCHAR) AS category_id, '类目_' || category_id AS category_name FROM dim_item"))
def dim_category_distinct(t):
    label = F.concat(F.lit("类目_"), c("category_id"))
    return D.distinct_labelled(D.as_text(t.dim_item, ["category_id"]), "category_id", label, "category_name")


@query("dim_scan_limit", sql("SELECT user_id, user_name FROM dim_user ORDER BY user_id LIMIT 50"))
def dim_scan_limit(t):
    return t.dim_user.select("user_id", "user_name").orderBy("user_id").limit(50)


@query("dim_row_count", sql("SELECT 'user' AS dim, count(*) AS n FROM dim_user UNION ALL SELECT 'item', count(*) FROM dim_item"))
def dim_row_count(t):
    return t.dim_user.select(F.lit("user").alias("dim")).unionByName(t.dim_item.select(F.lit("item").alias("dim"))).groupBy("dim").agg(F.count(F.lit(1)).alias("n"))


@query("dim_scan_grouped", sql("""
    SELECT province_id, user_id // 1000 AS chunk, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS ids FROM dim_user GROUP BY ALL"""))
def dim_scan_grouped(t):
    lists = D.grouped_rows(t.dim_user, "province_id", "user_id", ["user_name"])
    return lists.select("province_id", "chunk", F.array_join(F.transform("rows", lambda r: r["user_id"].cast("string")), ",").alias("ids"))


@query("dim_sync_columns", sql("SELECT user_id, user_name, user_level FROM dim_user WHERE user_id % 13 <> 0"))
def dim_sync_columns(t):
    rows = t.dim_user.withColumn("user_id", F.when(c("user_id") % 13 != 0, c("user_id")))
    return D.sync_table(rows, ["user_id", "user_name", "user_level"])


@query("preview_first_n", sql("""
    SELECT topic, event_id FROM (SELECT 'topic_' || log_type AS topic, event_id, row_number() OVER (PARTITION BY log_type ORDER BY event_id) AS rn FROM log) WHERE rn <= 10"""))
def preview_first_n(t):
    return first_n(t.log_text.select("topic", "event_id"), ["topic"], [c("event_id")], 10).drop("rn")


@query("src_rename_camel", sql("""SELECT c_custkey AS "cCustkey", c_name AS "cName", c_mktsegment AS "cMktsegment" FROM customer"""))
def src_rename_camel(t):
    return R.camel_columns(t.read("customer").select("c_custkey", "c_name", c("c_mktsegment").alias("C_MKTSEGMENT")))


# ---- files ------------------------------------------------------------------------


@query("src_json_lines", sql("SELECT user_id, user_name FROM dim_user"))
def src_json_lines(t):
    path = fresh_path(t.spark, "json-lines")
    t.dim_user.select("user_id", "user_name").write.json(path)
    return R.json_lines(t.spark, path, "user_id bigint, user_name string")


ORDER_TEXT = "SELECT order_id, user_id, CAST(amount AS DOUBLE) AS amount, status FROM order_info"


@query("src_delimited", sql(ORDER_TEXT))
def src_delimited(t):
    """A day's directory written over the old one, read back by schema."""
    path = fresh_path(t.spark, "delimited")
    rows = t.order_info.select("order_id", "user_id", "amount", "status")
    rows.limit(0).write.csv(path, sep="\t")
    rows.write.mode("overwrite").csv(path, sep="\t")
    return R.delimited(t.spark, path, f"order_id bigint, user_id bigint, amount {MONEY}, status string")


@query("src_raw_lines", sql("SELECT dt, count(*) AS lines FROM log GROUP BY dt"))
def src_raw_lines(t):
    path = fresh_path(t.spark, "raw-lines")
    t.log_text.select("value", "dt").write.partitionBy("dt").text(path)
    return R.raw_lines(t.spark, path).groupBy("dt").agg(F.count("line").alias("lines"))


@query("rt_orc", sql(ORDER_TEXT))
def rt_orc(t):
    return W.round_trip(t.order_info.select("order_id", "user_id", "amount", "status"), fresh_path(t.spark, "orc"), "orc")


@query("rt_parquet_partitioned", sql("SELECT order_id, user_id, status, dt FROM order_info"))
def rt_parquet_partitioned(t):
    rows = W.by_partition(t.order_info.select("order_id", "user_id", "status", "dt"), "dt")
    return W.round_trip(rows, fresh_path(t.spark, "parts"), "parquet", ["dt"])


@query("retention_180d", sql("SELECT order_id, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS ds FROM (SELECT o_orderkey AS order_id, o_orderdate FROM orders) WHERE CAST(o_orderdate AS DATE) > DATE '2001-08-02' - 180 AND CAST(o_orderdate AS DATE) <= DATE '2001-08-02'"))
def retention_180d(t):
    rows = t.read("orders").select(c("o_orderkey").alias("order_id"), c("o_orderdate").cast("date").alias("ds"))
    return W.retained(rows, "ds", "2001-08-02")


@query("write_dynamic_partition", sql("SELECT order_id, CASE WHEN dt = '2024-01-05' THEN 'redone' ELSE status END AS status, dt FROM order_info"))
def write_dynamic_partition(t):
    """First load of all days, then one day loaded again over its partition."""
    path = fresh_path(t.spark, "dynamic")
    rows = t.order_info.select("order_id", "status", "dt")
    W.overwrite_partitions(W.by_partition(rows, "dt"), path, ["dt"])
    W.overwrite_partitions(rows.where(c("dt") == "2024-01-05").withColumn("status", F.lit("redone")), path, ["dt"])
    return t.spark.read.parquet(path)


@query("write_static_partition", sql("SELECT order_id, CASE WHEN dt = '2024-01-05' THEN 'redone' ELSE status END AS status, dt FROM order_info"))
def write_static_partition(t):
    """All days, then the folder of one day dropped and written again."""
    path = fresh_path(t.spark, "static")
    rows = t.order_info.select("order_id", "status", "dt")
    W.overwrite_partitions(W.by_partition(rows, "dt"), path, ["dt"])
    W.drop_partitions(t.spark, path, "dt", ["2024-01-05"])
    W.write_partition(rows.where(c("dt") == "2024-01-05").withColumn("status", F.lit("redone")).drop("dt"), path, "dt", "2024-01-05")
    return t.spark.read.parquet(path).withColumn("dt", c("dt").cast("string"))


@query("write_append", sql("SELECT order_id, status, dt FROM order_info"))
def write_append(t):
    """Two batches appended to one table; the second runs twice and adds its rows once."""
    path = fresh_path(t.spark, "append")
    rows = t.order_info.select("order_id", "status", "dt")
    for batch, day in (("first", c("dt") < "2024-02-01"), ("second", c("dt") >= "2024-02-01"), ("second", c("dt") >= "2024-02-01")):
        W.append_batch(rows.where(day), path, batch)
    return W.appended(t.spark, path, rows.schema)


@query("retention_drop", sql("SELECT order_id, dt FROM order_info WHERE dt > '2024-02-10'"))
def retention_drop(t):
    """Daily folders older than the retention are dropped from the table."""
    path = fresh_path(t.spark, "retention")
    W.overwrite_partitions(W.by_partition(t.order_info.select("order_id", "dt"), "dt"), path, ["dt"])
    table = t.spark.read.schema("order_id bigint, dt string").parquet(path)
    W.drop_partitions(t.spark, path, "dt", [r["dt"] for r in W.expired_partitions(table, "dt", "2024-03-01", 20).collect()])
    return t.spark.read.schema("order_id bigint, dt string").parquet(path)


@query("src_first_line", sql("SELECT CAST(min(order_id) AS VARCHAR) || ',first' AS value FROM order_info"))
def src_first_line(t):
    """The first line of a file with the orders in order."""
    path = fresh_path(t.spark, "first-line")
    W.sorted_lines(t.order_info, "order_id", F.concat(c("order_id").cast("string"), F.lit(",first")), path)
    t.order_info.select(F.lit("later " * 9)).write.mode("append").text(path + "/zz-larger")
    return R.first_line(t.spark, path)


@query("sink_day_bucket", sql("""
    SELECT order_id, CASE WHEN order_id % 29 = 0 THEN 'error_bucket' ELSE 'day=' || strftime(order_time, '%Y%m%d') END AS bucket FROM order_info"""))
def sink_day_bucket(t):
    ms = F.unix_millis("order_time")
    epoch = F.when(c("order_id") % 29 == 0, "n/a").when(c("order_id") % 2 == 0, F.floor(ms / 1000).cast("string")).otherwise(ms.cast("string"))
    rows = t.order_info.select("order_id", W.day_bucket(epoch).alias("bucket"))
    return W.round_trip(W.by_partition(rows, "bucket"), fresh_path(t.spark, "buckets"), "parquet", ["bucket"])


@query("sink_dynamic_topic", sql("""
    SELECT CASE WHEN tbl = 'order_info' AND op IN ('c','r') THEN 'dwd_trade_order_detail' WHEN tbl = 'order_info' AND op = 'u' THEN 'dwd_trade_order_pay'
                WHEN tbl = 'payment_info' AND op IN ('c','r') THEN 'dwd_trade_pay_detail' WHEN tbl = 'user_info' AND op IN ('c','r') THEN 'dwd_user_register'
                ELSE 'dwd_dynamic_fallback' END AS topic, key AS position FROM cdc_op WHERE op <> 'd'"""))
def sink_dynamic_topic(t):
    routed = C.route(C.parse(t.cdc_text)).select("position", "sink_table", "after")
    out = W.to_topics(routed, c("sink_table")).withColumn("position", F.get_json_object("value", "$.position").cast("bigint"))
    return W.round_trip(W.by_partition(out, "topic"), fresh_path(t.spark, "topics"), "parquet", ["topic"]).select("topic", "position")


@query("sink_jdbc_rows", sql("SELECT order_id, user_id, CAST(amount AS DOUBLE) AS amount FROM order_info"))
def sink_jdbc_rows(t):
    return W.jdbc_rows(t.order_info, ["order_id", "user_id", "status", "amount"], skip=["status"])


@query("replace_by_version", sql("""
    SELECT dt, shop_id, item_id, value AS cart_cnt FROM (
        SELECT dt, product_id % 10 + 1 AS shop_id, product_id AS item_id, quantity AS value,
               row_number() OVER (PARTITION BY dt, product_id ORDER BY action_time DESC, quantity DESC) AS rn FROM cart) WHERE rn = 1"""))
def replace_by_version(t):
    rows = t.cart.select("dt", (c("product_id") % 10 + 1).alias("shop_id"), c("product_id").alias("item_id"), c("quantity").alias("cart_cnt"),
                         c("action_time").alias("updated_at"))
    return C.latest(rows, ["dt", "shop_id", "item_id"], ["updated_at"]).drop("updated_at")


@query("sink_upsert_latest", sql("""
    SELECT user_id, order_id, status, CAST(amount AS DOUBLE) AS amount FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY order_time DESC, order_id DESC) AS rn FROM order_info) WHERE rn = 1"""))
def sink_upsert_latest(t):
    rows = order_info_view(t.stream("orders")).select("user_id", "order_id", "status", "amount", "order_time")
    table = W.KeyedTable(fresh_path(t.spark, "upsert"), ["user_id"], ["order_time"])
    last = runner.each_batch(rows, "upsert", table.upsert, "append")
    return table.read(t.spark, last).drop("order_time")


# ---- streaming sinks -----------------------------------------------------------------


@query("sink_json_s", sql("SELECT event_id, mid, ts_ms FROM log"))
def sink_json_s(t):
    out = W.as_json(log_view(t.stream("events")).select("event_id", "mid", "ts_ms"))
    back = runner.to_table(out, "json-sink", fmt="text")
    return back.select(F.from_json("value", "event_id bigint, mid string, ts_ms bigint").alias("r")).select("r.*")


@query("sink_partition_commit_s", sql("SELECT event_id, event_type, dt FROM log"))
def sink_partition_commit_s(t):
    return runner.to_table(log_view(t.stream("events")).select("event_id", "event_type", "dt"), "commit", partition_by=["dt"])


@query("load_jsonpaths_s", sql("""
    SELECT event_id AS id, mid AS msid, CASE WHEN k % 9 <> 0 THEN k END AS datatype, props AS data, session_id AS vehicleno, k % 4 AS vehiclecolor, k AS vec1,
           k + 1 AS vec2, k + 2 AS vec3, value AS lon, value / 2 AS lat, event_id * 2 AS "msgId", strftime(ts, '%Y-%m-%d %H:%M:%S') AS "dateTime", dt AS ds, ts_ms AS ts
    FROM (SELECT l.*, e.props FROM log l JOIN events e USING (event_id))"""))
def load_jsonpaths_s(t):
    events = t.stream("events")
    log = log_view(events)
    k, e = c("k"), c("event_id")
    text = F.to_json(F.struct(
        e.alias("id"), c("mid").alias("msid"), F.when(k % 9 == 0, "bad").otherwise(k.cast("string")).alias("datatype"),
        F.concat(F.lit('{"k": '), k.cast("string"), F.lit("}")).alias("data"), c("session_id").alias("vehicleno"), (k % 4).alias("vehiclecolor"),
        k.alias("vec1"), (k + 1).alias("vec2"), (k + 2).alias("vec3"), c("value").alias("lon"), (c("value") / 2).alias("lat"), (e * 2).alias("msgId"),
        X.time_text("ts").alias("dateTime"), c("dt").alias("ds"), c("ts_ms").alias("ts")))
    rows = R.telemetry(log.select(text.alias("value")))
    path = fresh_path(t.spark, "telemetry")
    runner.each_batch(rows, "telemetry", lambda batch, i: batch.write.mode("overwrite").parquet(f"{path}/batch={i}"), "append")
    return t.spark.read.parquet(path).select("id", "msid", "datatype", "data", "vehicleno", "vehiclecolor", "vec1", "vec2", "vec3", "lon", "lat", "msgId",
                                             "dateTime", "ds", "ts")
