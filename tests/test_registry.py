"""The registry is complete, and a sample of it agrees with DuckDB."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry
from tradewake.plans.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
SAMPLE = ["win_pv_uv", "log_unified", "cdc_route", "order_wide", "dwd_payment", "shop_item_daily", "buyer_type", "traffic_daily",
          "price_percentile", "path_share", "fix_is_new", "dim_category_tree", "scd2_user", "src_stream_text_s", "sink_upsert_latest"]


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) >= 190
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("key", SAMPLE)
def test_matches_duckdb(spark, key):
    assert differences(entry.queries()[key](spark, FOLDER), duck(FOLDER), entry.oracle_sql()[key]) == []


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
