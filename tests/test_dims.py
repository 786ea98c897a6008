"""Versioned dimensions with nulls, day bounds that reach the scan, and report order."""

import datetime as dt

from pyspark.sql import functions as F

from tradewake.operators import dims as D
from tradewake.operators import paths, products
from tradewake.sources.tables import Tables


def test_surrogate_keys_number_every_row(frame):
    got = D.surrogate_keys(frame([(30, "c"), (None, "n"), (10, "a"), (20, "b")], "id int, v string"), "id", "key").collect()
    assert sorted((r["key"], r["id"]) for r in got) == [(1, None), (2, 10), (3, 20), (4, 30)]
    assert D.surrogate_keys(frame([], "id int"), "id", "key").collect() == []


def test_changes_between_null_and_value_are_changes(frame):
    first = D.initial_versions(frame([(1, "x", None), (2, None, None), (None, "p", None), (4, "k", "k")], "id int, a string, b string"), "id", "key", "2024-01-01")
    later = frame([(1, None, "x"), (2, None, None), (None, "q", None), (4, "k", "k"), (5, None, None)], "id int, a string, b string")
    got = D.next_versions(first, later, "id", "key", ["a", "b"], "2024-02-01").collect()
    versions = sorted(((r["id"] or 0, r["a"], r["b"], r["current_flag"]) for r in got), key=str)
    assert versions == sorted([(1, "x", None, "N"), (1, None, "x", "Y"), (2, None, None, "Y"), (0, "p", None, "N"), (0, "q", None, "Y"), (4, "k", "k", "Y"), (5, None, None, "Y")], key=str)
    assert len({r["key"] for r in got}) == 7
    assert {r["end_date"] for r in got if r["current_flag"] == "N"} == {dt.date(2024, 1, 31)}


def test_day_bounds_are_pushed_to_the_scan(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    rows = products.trailing(t.visit, "2024-01-31", 7)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(rows._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_reports_come_in_order(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    pv = [r["pv"] for r in paths.url_ranks(t.page_log).collect()]
    assert pv == sorted(pv, reverse=True)
    payment = t.order_info.select(F.col("user_id").cast("string").alias("uid"), "dt", "amount")
    visitors = [r["visitor_count"] for r in paths.path_shares(t.page_log, payment).collect()]
    assert visitors == sorted(visitors, reverse=True)


def test_sources_come_from_the_data(frame):
    visit = frame([("d", 1, 7), ("d", 2, 8)], "dt string, product_id int, user_id int")
    source = frame([("d", 7, "new one"), ("d", 9, "other"), ("d", 9, None)], "dt string, user_id int, source_type string")
    pay = frame([("d", 1, 7)], "dt string, product_id int, user_id int")
    got = sorted((r["product_id"], r["source_type"], r["uv_count"], r["pay_user_count"]) for r in products.traffic_sources(visit, source, pay).collect())
    assert got == [(1, "new one", 1, 1), (1, "other", 0, 0), (2, "new one", 0, 0), (2, "other", 0, 0)]
