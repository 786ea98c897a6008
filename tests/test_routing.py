"""Log records: cleaning, splitting, flattening."""

import json

import pytest
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import cdc as C
from tradewake.operators import routing as R
from tradewake.sources import readers as RD
from tradewake.sources import writers as W


def record(**parts):
    return json.dumps({"common": {"mid": "m1", "uid": "7", "ch": "c"}, "ts": 1_704_067_200_000, **parts})


@pytest.fixture
def lines(frame):
    data = [
        ("page", record(page={"page_id": "home"}, displays=[{"item": "1"}, {"item": "2"}], actions=[{"item": "3", "ts": 5}], err={"error_code": "9"})),
        ("start", record(start={"entry": "icon"}, err={"error_code": "8"})),
        ("empty", record(page={"page_id": "cart"}, displays=[], actions=[])),
        ("broken", '{"common": {"mid"'),
        ("object", "{}"),
        ("null", None),
        ("blank", "  "),
    ]
    return frame(data, "id string, value string")


def test_blank_messages_leave(lines, rows):
    assert "null" not in dict(rows(R.drop_blank(lines), "id", "value")) and R.drop_blank(lines).count() == 5


def test_dirty_rows_carry_text_and_reason(lines, rows):
    got = rows(R.dirty(R.drop_blank(lines)), "raw", "error")
    assert got == [("{}", "empty"), ('{"common": {"mid"', "malformed")] or sorted(got) == sorted([("{}", "empty"), ('{"common": {"mid"', "malformed")])
    assert sorted(r[0] for r in rows(R.clean(R.drop_blank(lines)), "id")) == ["empty", "page", "start"]


def test_overlapping_split_gives_every_part(lines, rows):
    got = rows(R.overlapping(R.parse_log(lines)), "id", "part")
    assert [p for i, p in got if i == "page"] == ["action", "display", "error", "page"]
    assert [p for i, p in got if i == "start"] == ["error", "start"]
    assert [p for i, p in got if i == "empty"] == ["action", "display", "page"]


def test_exclusive_split(lines, rows):
    p = R.parse_log(lines)
    assert rows(R.split_err(p), "id", "err.error_code") == [("page", "9"), ("start", "8")]
    start = R.split_start(p)
    assert rows(start, "id") == [("start",)] and "err" not in start.schema["rec"].dataType.names
    assert rows(R.split_display(p), "id", "display.item") == [("page", "1"), ("page", "2")]
    assert rows(R.split_action(p), "id", "action.item") == [("page", "3")]
    assert rows(R.split_page(p), "id", "rec.page.page_id") == [("empty", "cart"), ("page", "home")]


def test_behaviour_takes_action_time(lines, rows):
    got = rows(R.behaviour(R.parse_log(lines)), "event_type", "event_ts")
    assert ("action", 5) in got and len(got) == 6


def test_amounts_that_cannot_be_read(frame, rows):
    df = frame([("1.5", "2"), ("x", "2"), (None, "y")], "order_price string, pay_amount string")
    assert rows(R.normalise_amounts(df), "order_amount", "payment_amount", "cast_error") == [(1.5, 2.0, None), (None, 2.0, "x"), (None, None, "y")]


def envelope(op, table, after=None, before=None, ts=1, snapshot="false"):
    return (json.dumps({"op": op, "after": after, "before": before, "source": {"table": table, "snapshot": snapshot}, "ts_ms": ts}),)


def test_routes(frame, rows):
    df = C.parse(frame([envelope("r", "order_info", {"id": "1"}), envelope("u", "order_info", {"id": "2"}), envelope("d", "order_info", None, {"id": "3"}),
                        envelope("c", "other", {"id": "4"}), ("broken",)], "value string"))
    got = rows(C.route(df).withColumn("id", F.col("after")["id"]), "id", "sink_table")
    assert got == [("1", "dwd_trade_order_detail"), ("2", "dwd_trade_order_pay"), ("4", "dwd_dynamic_fallback")]


def test_config_image_of_deletes(frame, rows):
    df = C.config_image(C.parse(frame([envelope("d", "t", None, {"id": "1"}), envelope("c", "t", {"id": "2"})], "value string")))
    assert rows(df.withColumn("id", F.col("image")["id"]), "op", "id") == [("c", "2"), ("d", "1")]


def test_dims_follow_newest_config_and_deletes(spark, frame, rows):
    config = C.current_config(C.parse(frame([
        envelope("c", "cfg", {"source_table": "user", "sink_table": "old", "sink_columns": "id", "sink_row_key": "id"}, ts=1),
        envelope("u", "cfg", {"source_table": "user", "sink_table": "dim_user", "sink_columns": "id, name", "sink_row_key": "id"}, ts=2),
        envelope("c", "cfg", {"source_table": "gone", "sink_table": "dim_gone", "sink_columns": "id", "sink_row_key": "id"}, ts=1),
        envelope("d", "cfg", None, {"source_table": "gone", "sink_table": "dim_gone"}, ts=3)], "value string")))
    changes = C.parse(frame([envelope("c", "user", {"id": "1", "name": "a", "x": "z"}, ts=1), envelope("u", "user", {"id": "1", "name": "b"}, ts=2),
                             envelope("c", "user", {"id": "2", "name": "c"}, ts=1), envelope("d", "user", None, {"id": "2"}, ts=5),
                             envelope("c", "gone", {"id": "3"}, ts=1)], "value string"))
    writes = C.route_dims(changes, config)
    got = rows(C.dim_state(writes).withColumn("c", F.to_json("cells")), "sink_table", "row_key", "c")
    assert got == [("dim_user", "1", '{"id":"1","name":"b"}')]
    assert len(rows(C.dim_state(writes, apply_deletes=False))) == 2


def test_latest_breaks_ties_by_the_other_columns(frame, rows):
    df = frame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, 1, None)], "k int, ts int, v string")
    assert rows(C.latest(df, ["k"], ["ts"])) == [(1, 5, "b"), (2, 1, None)]


def test_telemetry_bad_values_become_null(frame, rows):
    df = RD.json_paths(frame([('{"id": 1, "lon": "x"}',), ('{"id": "2", "lon": 3.5}',)], "value string"), {"id": "bigint", "lon": "double"})
    assert rows(df) == [(1, None), (2, 3.5)]


def test_day_buckets(frame, rows):
    df = frame([("1704067200",), ("1704067200000",), ("abc",), (None,)], "e string").withColumn("b", W.day_bucket("e"))
    assert [r[1] for r in rows(df)] == ["day=20240101", "day=20240101", "error_bucket", "error_bucket"]


def test_buckets_and_names(frame, rows):
    key = next(iter(X.BUCKET_OVERRIDES))
    df = frame([(key,), ("abc",)], "a string").select(X.hash_bucket("a", 128, X.BUCKET_OVERRIDES).alias("b"))
    assert sorted(r[0] for r in rows(df)) == sorted(["9001", f"{int('f72', 16) % 128:04d}"])
    assert X.camel_name("ORDER_DETAIL_ID") == "orderDetailId"
