"""Queries over event time, state and deduplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import cdc as C
from tradewake.operators import state_tables as ST
from tradewake.plans import trade
from tradewake.plans.oracle import sql
from tradewake.plans.registry import query
from tradewake.plans.storage import streamed_log
from tradewake.session import fresh_path
from tradewake.sources.tables import FIRST_DAY, log_view, order_info_view
from tradewake.sources.writers import KeyedTable
from tradewake.streaming import dedup as U
from tradewake.streaming import outputs, runner, state
from tradewake.streaming import watermark as M

c = F.col


@query("wm_bounded_s", sql("""
    SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS stt, 'topic_' || log_type AS topic, count(*) AS n
    FROM log WHERE event_id % 97 <> 0 AND time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM log WHERE event_id % 97 <> 0) - INTERVAL 5 SECOND
    GROUP BY ALL
    UNION ALL SELECT '1970-01-01 00:00:00', 'topic_' || log_type, count(*) FROM log WHERE event_id % 97 = 0 GROUP BY ALL"""))
def wm_bounded_s(t):
    rows = M.bounded(streamed_log(t), "ts", "5 seconds")
    counts = rows.groupBy(F.window("event_time", "1 hour"), "topic").agg(F.count(F.lit(1)).alias("n"))
    return runner.to_table(counts.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("stt"), "topic", "n"), "wm")


FIX_IS_NEW = sql("""
    SELECT l.event_id, l.mid, CASE WHEN new_flag = '1' AND CAST(l.ts AS DATE) <> f.day THEN '0' ELSE new_flag END AS is_new
    FROM n l JOIN (SELECT mid, CASE WHEN new_flag = '1' THEN CAST(ts AS DATE) ELSE CAST(ts AS DATE) - 1 END AS day
                   FROM (SELECT *, row_number() OVER (PARTITION BY mid ORDER BY ts, event_id) AS rn FROM n) WHERE rn = 1) f ON l.mid = f.mid""",
    n="SELECT event_id, mid, ts, CASE WHEN k % 2 = 0 THEN '1' ELSE '0' END AS new_flag FROM log")


@query("fix_is_new", FIX_IS_NEW)
def fix_is_new(t):
    rows = t.log.select("event_id", "mid", "ts", F.when(c("k") % 2 == 0, "1").otherwise("0").alias("is_new"))
    return U.repaired_new_flag(rows, "mid", "is_new", "ts", ["ts", "event_id"]).select("event_id", "mid", "is_new")


ORDER_MERGE = sql("""
    SELECT order_detail_id, seq, event_type, ts, max(order_amount) OVER w AS order_amount, max(pay_amount) OVER w AS pay_amount,
           max(refund_amount) OVER w AS refund_amount
    FROM parts WINDOW w AS (PARTITION BY order_detail_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    parts="""
    SELECT order_id AS order_detail_id, order_id * 4 AS seq, 'order' AS event_type, epoch_us(order_time) // 1000 AS ts, CAST(amount AS DOUBLE) AS order_amount, NULL::DOUBLE AS pay_amount, NULL::DOUBLE AS refund_amount FROM order_info
    UNION ALL SELECT order_id, order_id * 4 + 1, 'pay', epoch_us(pay_time) // 1000, NULL, CAST(amount AS DOUBLE), NULL FROM order_info WHERE status <> 'CREATED'
    UNION ALL SELECT order_id, order_id * 4 + 2, 'refund', epoch_us(pay_time) // 1000, NULL, NULL, CAST(amount AS DOUBLE) FROM order_info WHERE status = 'REFUNDED'""")


def order_parts(orders: DataFrame) -> DataFrame:
    """Order, pay and refund messages of every order as partial details; one read serves all three."""

    def message(number: int, kind: str, when, created, called):
        image = F.struct(
            c("order_id").cast("string").alias("id"), c("order_id").cast("string").alias("order_detail_id"), c("order_id").cast("string").alias("order_id"),
            c("amount").cast("string").alias("total_amount"), created.cast("string").alias("create_time"), called.cast("string").alias("callback_time"))
        return F.when(when, F.struct((c("order_id") * 4 + number).alias("seq"), F.lit(kind).alias("event_type"), image.alias("after")))

    none, paid = F.lit(None).cast("bigint"), F.unix_millis("pay_time")
    messages = F.array_compact(F.array(
        message(0, "order", F.lit(True), F.unix_millis("order_time"), none), message(1, "pay", c("status") != "CREATED", none, paid),
        message(2, "refund", c("status") == "REFUNDED", paid, none)))
    rows = orders.select(F.inline(messages))
    return ST.partial_details(rows.withColumns({"data": F.lit(None).cast(rows.schema["after"].dataType), "ts": none}))


def merged_columns(df: DataFrame) -> DataFrame:
    return df.select(c("order_detail_id").cast("bigint").alias("order_detail_id"), "seq", "event_type", "ts", "order_amount", "pay_amount", "refund_amount")


@query("order_merge_latest", ORDER_MERGE)
def order_merge_latest(t):
    return merged_columns(ST.merge_details(order_parts(t.order_info)))


NEWER_TS = sql("""
    SELECT user_id, position, ts_ms FROM (
        SELECT *, max(ts_ms) OVER (PARTITION BY user_id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen
        FROM (SELECT user_id, event_id AS position, epoch_us(ts) // 1000 + (event_id * 7919) % 400000000 AS ts_ms FROM log)) WHERE seen IS NULL OR ts_ms > seen""")


@query("dedup_newer_ts", NEWER_TS)
def dedup_newer_ts(t):
    rows = t.log.select("user_id", c("event_id").alias("position"), (c("ts_ms") + (c("event_id") * 7919) % 400_000_000).alias("ts_ms"))
    return U.newer_only(rows, "user_id", "position", "ts_ms", span=2000)


@query("dedup_exact", sql("SELECT DISTINCT user_id, event_type, page_id FROM log"))
def dedup_exact(t):
    return U.exact(t.log.select("user_id", "event_type", "page_id"))


@query("dedup_order_ts", sql("SELECT DISTINCT order_id, ts_ms FROM (SELECT order_id, epoch_us(order_time) // 1000 AS ts_ms FROM order_item)"))
def dedup_order_ts(t):
    return U.within_watermark(t.order_item.select("order_id", F.unix_millis("order_time").alias("ts_ms")), ["order_id", "ts_ms"])


@query("first_seen", sql("""
    SELECT user_id, event_id, ts_ms, 1::BIGINT AS uv FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS rn FROM log) WHERE rn = 1"""))
def first_seen(t):
    return U.first_seen(t.log.select("user_id", "event_id", "ts_ms"), "user_id", ["ts_ms", "event_id"], "uv")


# ---- the same jobs as streams with keyed state --------------------------------------


@query("fix_is_new_s", FIX_IS_NEW)
def fix_is_new_s(t):
    rows = log_view(t.stream("events")).select("event_id", "mid", "ts", F.when(c("k") % 2 == 0, "1").otherwise("0").alias("is_new"))
    with state.running_to_end(t.spark):
        return runner.to_table(state.repair_new_flag(rows, order=["ts", "event_id"]), "new-flag").select("event_id", "mid", "is_new")


@query("dedup_newer_ts_s", NEWER_TS)
def dedup_newer_ts_s(t):
    rows = log_view(t.stream("events")).select("user_id", c("event_id").alias("position"), (c("ts_ms") + (c("event_id") * 7919) % 400_000_000).alias("ts_ms"))
    with state.running_to_end(t.spark):
        return runner.to_table(state.newer_only(rows, "user_id", "ts_ms", ["position"]), "newer-ts")


@query("order_merge_latest_s", ORDER_MERGE)
def order_merge_latest_s(t):
    parts = order_parts(order_info_view(t.stream("orders")))
    with state.running_to_end(t.spark):
        return merged_columns(runner.to_table(state.merge_parts(parts, "order_detail_id", ST.AMOUNTS, "seq"), "merge"))


# ---- late rows, and jobs over change streams that arrive in parts ----------------------


@query("late_dropped_s", sql("""
    SELECT strftime(slot, '%Y-%m-%d %H:%M:%S') AS stt, count(*) AS n FROM kept WHERE NOT late GROUP BY slot
    UNION ALL SELECT 'late', count(*) FROM kept WHERE late""",
    arrived=f"""SELECT ts, time_bucket(INTERVAL 1 HOUR, ts) AS slot,
        least(3, date_diff('day', DATE '{FIRST_DAY}', CAST(ts AS DATE)) // 8) + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS part FROM log""",
    marks="""SELECT p.part, date_trunc('millisecond', max(a.ts)) - INTERVAL 30 MINUTE AS mark
        FROM (SELECT unnest(range(5)) AS part) p LEFT JOIN arrived a ON a.part < p.part GROUP BY p.part""",
    kept="SELECT slot, coalesce(slot + INTERVAL 1 HOUR <= mark, false) AS late FROM arrived JOIN marks USING (part)"))
def late_dropped_s(t):
    """Events in five parts by eight days; one event in ten comes a part late, mostly after its window has closed."""
    slot = F.least(F.lit(3), F.floor(F.datediff("ts", F.lit(FIRST_DAY).cast("date")) / 8)) + F.when(c("event_id") % 10 == 0, 1).otherwise(0)
    log = t.log.select("event_id", "ts", slot.alias("part"))
    table = KeyedTable(fresh_path(t.spark, "late-windows"), ["window_start"], ["version"])

    def run(stream, checkpoint):
        counts = M.counted_windows(stream, "ts", "1 hour", delay="30 minutes")
        runner.each_batch(counts, "late", lambda rows, i: table.upsert(rows.withColumn("version", F.lit(i)), i), "update", checkpoint, [table])

    arrived = runner.arriving(t.spark, [log.where(c("part") == k).drop("part") for k in range(5)], "late-events", run)
    counted = table.read(t.spark)
    late = M.late_rows(arrived, counted).select(F.lit("late").alias("stt"), c("late").alias("n"))
    return counted.select(X.time_text("window_start").alias("stt"), "n").unionByName(late)


@query("order_wide_s", trade.ORDER_WIDE)
def order_wide_s(t):
    """Details and old headers come first, then new headers, payments and activities, then coupons and refunds of the same orders."""
    detail, info, activity, coupon, payment, refund = trade.change_logs(t)
    owner = F.floor(c("order_detail_id") / 10).alias("order_id")
    logs = {"detail": (detail, 0), "info": (info, 1), "activity": (activity.select("*", owner), 1), "coupon": (coupon.select("*", owner), 2), "payment": (payment, 1),
            "refund": (refund.withColumn("ts_ms", F.unix_millis("refund_create_time")), 2)}
    older = c("province_id") >= 100
    changes = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        df.withColumns({"kind": F.lit(kind), "part": F.when(older, 0).otherwise(part) if kind == "info" else F.lit(part)}) for kind, (df, part) in logs.items()])
    columns = {kind: df.columns for kind, (df, _) in logs.items()}
    split = lambda batch: {kind: batch.where(c("kind") == kind).select(*columns[kind]) for kind in outputs.WideOrders.KEYS}
    wide = outputs.WideOrders(fresh_path(t.spark, "wide-orders"), split, buckets=16)

    def run(stream, checkpoint):
        last = runner.each_batch(stream, "wide", wide, "append", checkpoint, wide.tables)
        wide.wide.fold(t.spark, last, 1)  # a part touches most orders: what it replaces goes

    runner.arriving(t.spark, [changes.where(c("part") == k).drop("part") for k in range(3)], "order-changes-in", run, keep=False)
    return wide.wide.read(t.spark).drop("version")


@query("snapshot_rows_s", sql("""
    SELECT tbl AS source_table, key AS position FROM cdc_op WHERE op = 'r'
    UNION ALL SELECT tbl, NULL FROM cdc_op GROUP BY tbl HAVING bool_or(op <> 'r')"""))
def snapshot_rows_s(t):
    """Snapshot rows, and for each table a row without position where its snapshot ended."""
    text = t.cdc_text.select("value", "position")
    out = fresh_path(t.spark, "snapshot-out")

    def run(stream, checkpoint):
        rows = C.parse(stream).select(c("source")["table"].alias("source_table"), "op", c("source")["snapshot"].alias("snapshot"), c("position").cast("string").alias("position"))
        query, _ = runner.start(state.snapshot_gate(rows, "source_table"), "snapshot", path=out, checkpoint=checkpoint)
        query.awaitTermination()

    with state.running_to_end(t.spark):
        runner.arriving(t.spark, [text.where(c("position") % 2 == k) for k in (0, 1)], "snapshot-in", run)
    rows = t.spark.read.schema("source_table string, op string, snapshot string, position string").parquet(out)
    return rows.select("source_table", c("position").cast("bigint").alias("position"))


@query("dim_route_by_config_s", trade.DIM_BY_CONFIG)
def dim_route_by_config_s(t):
    text = t.cdc_text.where(c("source_table").isin([row[0] for row in trade.CONFIG])).select("value", "position")
    table = KeyedTable(fresh_path(t.spark, "config-dims"), ["sink_table", "row_key"], ["ts_ms", "op"])
    write = outputs.dims_by_config(lambda spark: C.config_frame(spark, trade.CONFIG), table)
    run = lambda stream, checkpoint: runner.each_batch(stream, "dims", write, "append", checkpoint, [table])
    runner.arriving(t.spark, [text.where(c("position") % 2 == k) for k in (0, 1)], "config-in", run)
    state_rows = table.read(t.spark).where(c("op") != "d").withColumn("cells", F.map_from_entries("cells"))
    return trade.dim_columns(state_rows)
