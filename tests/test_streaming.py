"""Streams give what the same functions give on tables; state, restart, late rows."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tradewake.operators import shops as S
from tradewake.operators import wide as J
from tradewake.operators import windows as W
from tradewake.session import fresh_path
from tradewake.sources.writers import KeyedTable
from tradewake.streaming import dedup, runner, state

START = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def plain_state(spark):
    yield
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "true")
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def at(seconds):
    return START + timedelta(seconds=seconds)


def as_files(df, spark, parts):
    """Writes the frame as one file per value of ``part``, in that order of modification."""
    path = fresh_path(spark, "input")
    for i in range(parts):
        df.where(F.col("part") == i).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.fixture
def log(frame):
    rows = [(i % 3, at(i * 2), f"u{i % 4}", "v1", "c1", "a1", "1") for i in range(60)]
    return frame(rows, "part int, ts timestamp, uid string, vc string, ch string, ar string, is_new string")


def test_exact_visitors_in_windows_match_the_table(spark, log, rows):
    want = W.labelled(W.pv_uv(log))
    stream = as_files(log, spark, 3).withWatermark("ts", "10 minutes")
    got = runner.to_table(W.labelled(W.pv_uv(stream)), "pv")
    assert got.count() == 0  # nothing is closed yet under a ten-minute delay
    closing = log.unionByName(log.limit(1).withColumn("ts", F.lit(at(7200))).withColumn("part", F.lit(2)))
    stream = as_files(closing, spark, 3).withWatermark("ts", "10 minutes")
    got = runner.to_table(W.labelled(W.pv_uv(stream)), "pv")
    assert rows(got) == rows(want)


def trade_rows(frame):
    data = []
    for i in range(40):
        for kind in ("order", "payment", "refund")[: 1 + i % 3]:
            data.append((i % 2, kind, at(i * 5), i % 3, 1, 1, i % 5, float(i), float(i), float(i)))
    data.append((1, "order", at(9000), 99, 1, 1, 1, 1.0, 1.0, 1.0))
    data.append((1, "payment", at(9000), 99, 1, 1, 1, 1.0, 1.0, 1.0))
    data.append((1, "refund", at(9000), 99, 1, 1, 1, 1.0, 1.0, 1.0))
    return frame(data, "part int, event_type string, ts timestamp, sku_id int, category3_id int, tm_id int, user_id int, "
                       "order_amount double, payment_amount double, refund_amount double")


def test_joined_trade_windows_match_the_table(spark, frame, rows):
    events = trade_rows(frame)
    table = W.labelled(W.joined_stats(W.order_stats(events), W.payment_stats(events), W.refund_stats(events)))
    once = W.labelled(W.trade_windows(events))
    assert rows(once, *table.columns) == rows(table)
    s = as_files(events, spark, 2).withWatermark("ts", "10 minutes")
    joined = W.labelled(W.joined_stats(W.order_stats(s), W.payment_stats(s), W.refund_stats(s)))
    got = runner.to_table(joined, "joined")
    assert rows(got) == rows(table.where("sku_id <> 99"))


def test_full_outer_item_days_on_a_stream(spark, frame, rows):
    day = 86_400
    page = frame([(0, 1, 1, 7, at(10)), (0, 1, 1, 8, at(20)), (0, 1, 1, 8, at(9 * day))],
                 "part int, shop_id int, item_id int, user_id int, event_time timestamp")
    order = frame([(0, 1, 2, 7, at(10)), (0, 1, 2, 7, at(9 * day))], "part int, shop_id int, item_id int, buyer_id int, order_time timestamp")
    pay = frame([(0, 1, 1, 7, "SUCCESS", 5, True, False, at(30)), (0, 1, 1, 9, "failed", 50, True, True, at(30)), (0, 1, 1, 7, "success", 5, False, True, at(9 * day))],
                "part int, shop_id int, item_id int, buyer_id int, pay_status string, pay_amount int, is_presale_tail_paid boolean, is_zero_order_afterpay boolean, pay_time timestamp")
    refund = frame([(0, 1, 1, "success", 9, at(50)), (0, 1, 1, "success", 9, at(9 * day))],
                   "part int, shop_id int, item_id int, refund_status string, refund_amount int, refund_time timestamp")
    cols = ["dt", "shop_id", "item_id", "pv", "uv", "order_buyer_cnt", "pay_buyer_cnt", "gross_pay_amt", "refund_amt", "net_pay_amt", "presale_tail_pay_cnt"]
    whole = S.dated(S.item_days(page, order, pay, refund)).where("dt = '2024-01-01'")
    joined = S.dated(S.combine_items(S.page_items(page), S.order_items(order), S.pay_items(pay), S.refund_items(refund))).where("dt = '2024-01-01'")
    assert rows(whole, *cols) == rows(joined, *cols)
    streams = [as_files(d, spark, 1).withWatermark(ts, "30 minutes") for d, ts in
               ((page, "event_time"), (order, "order_time"), (pay, "pay_time"), (refund, "refund_time"))]
    p, o, y, r = streams
    got = runner.to_table(S.dated(S.combine_items(S.page_items(p), S.order_items(o), S.pay_items(y), S.refund_items(r))), "items")
    assert rows(got, *cols) == rows(whole, *cols)


def test_interval_join_stream_and_table_agree(spark, frame, rows):
    left = frame([(0, i, i % 2, at(i * 600)) for i in range(12)], "part int, id int, user_id int, ts timestamp")
    right = frame([(0, i, i % 2, at(i * 900 + 7)) for i in range(12)], "part int, id int, user_id int, ts timestamp")
    table = J.interval_join_batch(left, right, "user_id", "ts", "ts", 300, 1200)
    brute = left.alias("l").join(right.alias("r"), F.expr("l.user_id = r.user_id and r.ts >= l.ts - interval 300 seconds and r.ts <= l.ts + interval 1200 seconds"))
    assert rows(table, "id", "info_id") == rows(brute, "l.id", "r.id")
    ls = as_files(left, spark, 1).withWatermark("ts", "1 minute")
    rs = as_files(right, spark, 1).withWatermark("ts", "1 minute")
    got = runner.to_table(J.interval_join(ls, rs, "user_id", "ts", "ts", "300 seconds", "1200 seconds").select("id", "info_id"), "interval")
    assert rows(got) == rows(table, "id", "info_id")


def test_restart_continues_from_the_checkpoint(spark, frame, rows):
    path, out, mark = (fresh_path(spark, n) for n in ("in", "out", "mark"))
    schema = "id int, v int"
    frame([(1, 1)], schema).write.mode("append").parquet(path)
    table = KeyedTable(out, ["id"], ["v"])
    read = lambda: spark.readStream.schema(schema).parquet(path)
    assert runner.each_batch(read(), "a", table.upsert, "append", mark) == 0
    frame([(1, 5), (2, 2)], schema).write.mode("append").parquet(path)
    assert runner.each_batch(read(), "a", table.upsert, "append", mark) == 1
    assert rows(table.read(spark, 1), "id", "v") == [(1, 5), (2, 2)]
    table.upsert(frame([(1, 5), (2, 2)], schema), 1)  # the same batch again
    assert rows(table.read(spark, 1), "id", "v") == [(1, 5), (2, 2)]


def test_dedup_within_watermark(spark, frame, rows):
    df = frame([(0, 1, at(1)), (0, 1, at(1)), (1, 1, at(2)), (1, 2, at(1))], "part int, order_id int, ts timestamp")
    stream = as_files(df, spark, 2).withWatermark("ts", "1 hour")
    got = runner.to_table(dedup.within_watermark(stream, ["order_id", "ts"]).select("order_id", "ts"), "dedup")
    assert rows(got) == rows(dedup.within_watermark(df, ["order_id", "ts"]), "order_id", "ts")


def test_new_flag_state(spark, frame, rows):
    state.configure(spark, run_to_end=True)
    data = [(0, "m1", "1", at(0)), (0, "m1", "1", at(90_000)), (0, "m2", "0", at(0)), (1, "m2", "1", at(10)), (1, "m1", "1", at(20))]
    df = frame(data, "part int, mid string, is_new string, ts timestamp")
    got = runner.to_table(state.repair_new_flag(as_files(df, spark, 2)), "new")
    want = dedup.repaired_new_flag(df, "mid", "is_new", "ts", ["part", "ts"])
    assert rows(got, "mid", "ts", "is_new") == rows(want, "mid", "ts", "is_new")
    assert ("m1", at(90_000), "0") in rows(got, "mid", "ts", "is_new")


def test_newer_only_state(spark, frame, rows):
    state.configure(spark, run_to_end=True)
    df = frame([(0, 1, 5, 0), (1, 1, 7, 3), (1, 1, 4, 1), (1, 1, 9, 2), (1, 2, 1, 0), (1, 1, 11, 4)], "part int, user_id int, ts_ms bigint, position int")
    got = runner.to_table(state.newer_only(as_files(df, spark, 2), "user_id", "ts_ms", ["position"]), "newer")
    assert rows(got, "user_id", "ts_ms") == [(1, 11), (1, 5), (1, 9), (2, 1)]


def test_state_takes_rows_in_order_however_they_are_cut(spark, frame, rows):
    """One Arrow batch per row, and rows of a micro-batch in reverse."""
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        with state.running_to_end(spark):
            money = frame([(0, "d", 3 - i, None if i % 2 else f"{i}.10") for i in range(4)], "part int, id string, seq bigint, m string")
            money = money.withColumn("m", F.col("m").cast("decimal(18,2)"))
            got = runner.to_table(state.merge_parts(as_files(money, spark, 1), "id", ["m"], "seq"), "cut")
            assert [(r["seq"], str(r["m"])) for r in got.orderBy("seq").collect()] == [(0, "None"), (1, "2.10"), (2, "2.10"), (3, "0.10")]
            newer = frame([(0, 1, 9 - i, 9 - i) for i in range(9)], "part int, user_id int, ts_ms bigint, position int")
            assert runner.to_table(state.newer_only(as_files(newer, spark, 1), "user_id", "ts_ms", ["position"]), "cut").count() == 9
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)


def test_merge_state(spark, frame, rows):
    state.configure(spark, run_to_end=True)
    df = frame([(0, "d1", 1, 10.0, None), (1, "d1", 2, None, 8.0), (1, "d2", 1, None, 3.0)], "part int, id string, seq bigint, order_amount double, pay_amount double")
    got = runner.to_table(state.merge_parts(as_files(df, spark, 2), "id", ["order_amount", "pay_amount"], "seq"), "merge")
    assert rows(got, "id", "seq", "order_amount", "pay_amount") == [("d1", 1, 10.0, None), ("d1", 2, 10.0, 8.0), ("d2", 1, None, 3.0)]


def test_snapshot_gate(spark, frame, rows):
    state.configure(spark, run_to_end=True)
    df = frame([(0, "t", "r", "true", "1"), (1, "t", "u", "false", "2"), (1, "t", "r", "true", "3")], "part int, tbl string, op string, snapshot string, id string").withColumn("part", F.col("part").cast("int"))
    stream = as_files(df, spark, 2).drop("part")
    got = runner.to_table(state.snapshot_gate(stream, "tbl"), "gate")
    assert rows(got, "op", "id") == [("end", None), ("r", "1"), ("r", "3")]


def test_keyed_table_merges_deltas_and_compacts(spark, frame, rows):
    table = KeyedTable(fresh_path(spark, "keyed"), ["id"], ["v"])
    assert table.read(spark) is None
    table.upsert(frame([(1, 1), (2, 2)], "id int, v int"), 0)
    table.upsert(frame([(1, 3)], "id int, v int"), 1)
    table.compact(spark, 1)
    table.upsert(frame([(2, 9), (3, 1)], "id int, v int"), 2)
    assert rows(table.read(spark), "id", "v") == [(1, 3), (2, 9), (3, 1)]
    assert rows(table.read(spark, 1), "id", "v") == [(1, 3), (2, 2)]


def test_log_parts_are_written_per_batch(spark, frame):
    from tradewake.streaming.outputs import split_logs

    out = fresh_path(spark, "parts")
    line = '{"common":{"mid":"m"},"page":{"page_id":"home"},"displays":[{"item":"1"}],"err":{"error_code":"1"},"ts":1}'
    split_logs(out)(frame([(line,), ("{bad",)], "value string"), 0)
    count = lambda name: spark.read.parquet(f"{out}/{name}").count()
    assert [count(n) for n in ("dirty", "err", "start", "display", "action", "page")] == [1, 1, 0, 1, 0, 1]


def test_dims_follow_config_changes_between_batches(spark, frame, rows):
    from tradewake.operators.cdc import config_frame
    from tradewake.streaming.outputs import dim_rows, dims_by_config

    config = [("user", "dim_user", "id", "info", "id")]
    table = KeyedTable(fresh_path(spark, "dims"), ["sink_table", "row_key"], ["ts_ms", "op"])
    write = dims_by_config(lambda s: config_frame(s, config), table)
    env = lambda op, i, name, ts: ('{"op":"%s","after":{"id":"%s","name":"%s"},"before":{"id":"%s"},"source":{"table":"user"},"ts_ms":%d}' % (op, i, name, i, ts),)
    write(frame([env("c", 1, "a", 1), env("c", 2, "b", 1)], "value string"), 0)
    config[0] = ("user", "dim_user", "id,name", "info", "id")
    write(frame([env("u", 1, "z", 2), env("d", 2, "b", 2)], "value string"), 1)
    got = dim_rows(table.read(spark), "dim_user").select("row_key", F.to_json("cells"))
    assert rows(got) == [("1", '{"id":"1","name":"z"}')]


def test_wide_orders_follow_later_changes(spark, frame, rows):
    from tradewake.streaming.outputs import WideOrders

    schema = "kind string, order_detail_id int, order_id int, ts_ms int, refund_id int, refund_create_time int, amount double, province_id int"

    def split(batch):
        pick = lambda kind, *cols: batch.where(F.col("kind") == kind).select(*cols, "order_id", "ts_ms")
        return {
            "detail": pick("detail", "order_detail_id"), "info": pick("info", "province_id"),
            "activity": pick("activity", "order_detail_id", F.col("province_id").alias("activity_id")),
            "coupon": pick("coupon", "order_detail_id", F.col("province_id").alias("coupon_id")),
            "payment": pick("payment", F.col("amount").alias("pay_amount")),
            "refund": pick("refund", "refund_id", "refund_create_time", F.col("amount").alias("refund_amount")),
        }

    wide = WideOrders(fresh_path(spark, "wide"), split)
    wide(frame([("detail", 1, 10, 1, None, None, None, None), ("detail", 2, 20, 1, None, None, None, None), ("info", None, 10, 1, None, None, None, 5)], schema), 0)
    assert rows(wide.wide.read(spark), "order_detail_id", "event_type", "province_id") == [(1, "order", 5), (2, "order", None)]
    wide(frame([("payment", None, 10, 2, None, None, 3.0, None), ("info", None, 20, 2, None, None, None, 6)], schema), 1)
    wide(frame([("refund", None, 10, 3, 1, 9, 2.0, None)], schema), 2)
    assert rows(wide.wide.read(spark), "order_detail_id", "event_type", "province_id") == [(1, "refund", 5), (2, "order", 6)]


def test_merge_state_keeps_many_keys_of_a_bucket_apart(spark, frame, rows):
    """One bucket, several micro-batches: each key, null included, has its own values, and a call serves all keys."""
    data = [(p, f"k{k}" if k else None, 10 * p + s, 1.0 * k if (p + s + k) % 3 == 0 else None, f"{p}.{s}0" if (k + s) % 2 else None)
            for p in range(3) for s in range(2) for k in range(40) if (k + p) % 4]
    df = frame(data, "part int, id string, seq bigint, a double, m string").withColumn("m", F.col("m").cast("decimal(18,2)"))
    with state.running_to_end(spark):
        got = runner.to_table(state.merge_parts(as_files(df, spark, 3), "id", ["a", "m"], "seq", buckets=1), "merge-many")
    want, known = [], {}
    for p, key, seq, a, m in sorted(data, key=lambda r: r[2]):
        old = known.get(key, (None, None))
        known[key] = (old[0] if a is None else a, old[1] if m is None else m)
        want.append((key, seq, *known[key]))
    assert sorted(rows(got.select("id", "seq", "a", F.col("m").cast("string").alias("m")), "id", "seq", "a", "m"), key=str) == sorted(want, key=str)


def test_merge_state_forgets_after_its_time(monkeypatch):
    import pandas as pd
    from pyspark.sql import types as T

    class State:
        """What Spark gives to the function of a bucket."""

        hasTimedOut, exists, now, get = False, False, 0, None

        def getCurrentProcessingTimeMs(self):
            return self.now

        def update(self, value):
            self.get, self.exists = value, True

        def setTimeoutDuration(self, ms):
            self.ms = ms

    merge = state.MergeParts("id", ["a"], ["seq"], 100, T.StructType().add("id", "long").add("seq", "long").add("a", "double"))
    take = lambda now, *data: (setattr(s, "now", now), next(merge((0,), iter([pd.DataFrame(list(data), columns=["id", "seq", "a"])]), s)))[1]["a"].tolist()
    s = State()
    assert take(0, (1, 1, 5.0), (2, 1, 6.0)) == [5.0, 6.0]
    assert take(99, (1, 2, None)) == [5.0]
    assert [str(v) for v in take(150, (1, 3, None), (2, 4, None))] == ["5.0", "nan"]  # key 2 was last seen at 0
