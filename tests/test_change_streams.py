"""Late rows, bucketed state tables, folding of deltas, appends and first lines."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tradewake.session import fresh_path
from tradewake.sources import readers, writers
from tradewake.sources.writers import KeyedTable, versions
from tradewake.streaming import runner
from tradewake.streaming import watermark as M
from tradewake.streaming.outputs import WideOrders

START = datetime(2024, 1, 1)


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_late_rows_are_dropped_and_counted(spark, frame, rows):
    """Hours of 60 minutes, 30 minutes of patience: minute 10 is late once minute 95 was seen, minute 65 is not."""
    schema = "ts timestamp, k string"
    parts = [[(at(5), "a"), (at(50), "a")], [(at(95), "a"), (at(40), "b")], [(at(10), "a"), (at(11), "a"), (at(65), "b"), (at(200), "a")], [(at(100), "a"), (None, "a")]]
    table, dropped = KeyedTable(fresh_path(spark, "counts"), ["window_start", "k"], ["version"]), []

    def run(stream, checkpoint):
        counts = M.counted_windows(stream, "ts", "1 hour", ["k"], "30 minutes")
        query = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(
            lambda b, i: table.upsert(b.withColumn("version", F.lit(i)), i)).start()
        query.awaitTermination()
        dropped.append(runner.dropped_rows(query))

    arrived = runner.arriving(spark, [frame(p, schema) for p in parts], "late", run)
    counted = table.read(spark)
    assert rows(counted, "window_start", "k", "n") == [(at(0), "a", 2), (at(0), "b", 1), (at(60), "a", 1), (at(60), "b", 1), (at(180), "a", 1)]
    assert M.late_rows(arrived, counted).first()["late"] == 4  # minutes 10, 11 and 100, and the row without a time
    assert dropped[:2] == [0, 0] and dropped[2] > 0 and dropped[3] > 0
    assert M.late_rows(arrived.limit(0), counted.limit(0)).first()["late"] == 0


SCHEMA = "kind string, order_detail_id int, order_id int, ts_ms int, refund_id int, refund_create_time int, amount double, province_id int"


def split(batch):
    pick = lambda kind, *cols: batch.where(F.col("kind") == kind).select(*cols, "order_id", "ts_ms")
    return {
        "detail": pick("detail", "order_detail_id"), "info": pick("info", "province_id"),
        "activity": pick("activity", "order_detail_id", F.col("province_id").alias("activity_id")),
        "coupon": pick("coupon", "order_detail_id", F.col("province_id").alias("coupon_id")),
        "payment": pick("payment", F.col("amount").alias("pay_amount")),
        "refund": pick("refund", "refund_id", "refund_create_time", F.col("amount").alias("refund_amount")),
    }


def test_wide_orders_read_only_touched_buckets(spark, frame, rows):
    details = [("detail", 10 * k, k, 1, None, None, None, None) for k in range(40)]
    wide = WideOrders(fresh_path(spark, "wide"), split, buckets=8)
    every = [("info", None, 9, 0, None, None, None, 1), ("activity", 90, 9, 0, None, None, None, 1), ("coupon", 90, 9, 0, None, None, None, 1), ("refund", None, 9, 0, 1, 1, 1.0, None)]
    wide(frame(details + every, SCHEMA), 0)
    wide(frame([("payment", None, 7, 2, None, None, 3.0, None), ("detail", None, None, 2, None, None, None, None)], SCHEMA), 1)
    got = {r["order_id"]: r["event_type"] for r in wide.wide.read(spark).collect()}
    assert got == {k: {7: "payment", 9: "refund"}.get(k, "order") for k in range(40)}
    touched = frame([(7,)], "order_id int")
    for name, side in wide.sides(touched, 1).items():
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0], name
        assert side.count() == (1 if name in ("detail", "payment") else 0)


def test_runner_folds_deltas(spark, frame, rows):
    for bucket in (None, "id"):
        table = KeyedTable(fresh_path(spark, "folded"), ["id"], ["seq"], bucket, 4)
        run = lambda stream, checkpoint: runner.each_batch(stream, "fold", table.upsert, "append", checkpoint, [table], fold_every=4)  # noqa: B023, E731
        runner.arriving(spark, [frame([(k % 3, k, f"v{k}"), (100 + k, k, "own")], "id int, seq int, v string") for k in range(10)], "fold-in", run)
        deltas, bases = (versions(spark, f"{table.path}/_kind={kind}") for kind in ("delta", "base"))
        assert len(deltas) < 4 and len(bases) == 1 and all(d > bases[0] for d in deltas)
        want = sorted([(0, 9, "v9"), (1, 7, "v7"), (2, 8, "v8")] + [(100 + k, k, "own") for k in range(10)])
        assert sorted(rows(table.read(spark), "id", "seq", "v")) == want
        table.upsert(frame([(0, 9, "v9"), (109, 9, "own")], "id int, seq int, v string"), 9)  # the last batch again
        table.fold(spark, 9, 4)
        assert sorted(rows(table.read(spark), "id", "seq", "v")) == want
        fresh = KeyedTable(table.path, ["id"], ["seq"], bucket, 4)  # as after a restart
        assert sorted(rows(fresh.read(spark), "id", "seq", "v")) == want


def test_keyed_table_takes_empty_batches(spark, frame):
    table = KeyedTable(fresh_path(spark, "empty"), ["id"], ["seq"], "id", 4)
    table.upsert(frame([], "id int, seq int"), 0)
    assert table.read(spark).count() == 0 and table.read(spark, only=[1]).count() == 0


def test_first_line_is_that_of_the_first_file(spark, tmp_path):
    for k, lines in enumerate([0, 1, 5, 2000, 3]):
        (tmp_path / f"file{k}.txt").write_text("".join(f"file{k} line{i}\n" for i in range(lines)))
    assert [r["value"] for r in readers.first_line(spark, str(tmp_path)).collect()] == ["file1 line0"]
    assert [r["value"] for r in readers.first_line(spark, str(tmp_path / "file3.txt")).collect()] == ["file3 line0"]
    assert readers.first_line(spark, str(tmp_path / "file0.txt")).collect() == []


def test_first_line_of_a_file_of_many_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i:06d}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        assert [r["value"] for r in readers.first_line(spark, str(tmp_path)).collect()] == ["line 000000"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_appends_do_not_double(spark, frame, rows):
    path = fresh_path(spark, "append")
    one, two = frame([(1, "a"), (1, "a")], "id int, v string"), frame([(2, "b")], "id int, v string")
    for df, batch in ((one, "1"), (two, "2"), (two, "2"), (one.limit(0), "3")):
        writers.append_batch(df, path, batch)
    assert rows(writers.appended(spark, path, one.schema)) == [(1, "a"), (1, "a"), (2, "b")]


def test_wide_orders_in_pieces_leave_no_shuffles_or_parts(spark, frame, rows, monkeypatch):
    from pathlib import Path

    from tradewake.session import shared_dir
    from tradewake.sources import writers

    monkeypatch.setattr(writers, "PIECE", 1, raising=False)  # every bucket is a piece
    details = [("detail", 10 * k, k, 1, None, None, None, None) for k in range(12)]
    paid = [("payment", None, k, 2, None, None, 3.0, None) for k in (3, 7)]
    parts = [frame(p, SCHEMA).repartition(1) for p in (details, paid)]
    wide, plans = WideOrders(fresh_path(spark, "wide"), split, buckets=4), []

    def run(stream, checkpoint):
        last = runner.each_batch(stream, "wide", wide, "append", checkpoint, wide.tables)
        plans.append(wide.wide.read(spark)._jdf.queryExecution().executedPlan().toString())
        wide.wide.fold(spark, last, 1)

    runner.arriving(spark, parts, "pieces-in", run, keep=False)
    want = [(10 * k, "payment" if k in (3, 7) else "order") for k in range(12)]
    assert sorted(rows(wide.wide.read(spark), "order_detail_id", "event_type")) == want
    assert "Exchange" not in plans[0]  # one delta needs no merging
    assert "Exchange" not in wide.wide.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert versions(spark, f"{wide.wide.path}/_kind=base") == [1] and not versions(spark, f"{wide.wide.path}/_kind=delta")
    (folder,) = Path(shared_dir(spark)).glob("pieces-in-" + "[0-9a-f]" * 32)
    assert not list(folder.glob("part-*"))  # what was taken is gone
