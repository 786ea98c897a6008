"""Facts, metrics, scores and dimensions on small frames."""

from datetime import date, datetime

from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators import dims as D
from tradewake.operators import facts as A
from tradewake.operators import items as I
from tradewake.operators import paths as P
from tradewake.operators import products as R
from tradewake.operators import scoring as S
from tradewake.operators import wide as J
from tradewake.streaming import dedup as U


def test_ratio_of_zero_is_null(frame, rows):
    df = frame([(1, 0), (1, 2), (None, 2)], "a int, b int")
    assert sorted(rows(df.select(X.ratio("a", "b").alias("r"), X.percent_text("a", "b").alias("p"))), key=str) == [(0.5, "50.0%"), (None, None), (None, None)]


def test_bands_and_levels(frame, rows):
    df = frame([(50.0,), (50.01,), (200.0,), (201.0,)], "p double")
    assert [r[1] for r in sorted(df.select("p", X.price_band("p")).collect())] == ["0-50", "51-100", "101-200", "201+"]
    levels = frame([(0.2,), (0.41,), (1.0,), (None,)], "p double").select(X.price_level("p").alias("l"))
    assert sorted(r[0] for r in levels.collect()) == [1, 1, 3, 5]


def test_grade_borders_and_cap(frame, rows):
    sides = []
    for name, values in zip(S.SCORES, [(100, 70, 50, 49.99), (100, 70, 50, 50), (0, 70, 50, 50), (50, 70, 50, 50), (100, 70, 50, 50)]):
        sides.append(frame([(i, date(2024, 1, 1), float(v)) for i, v in enumerate(values)], f"product_id int, date_key date, {name} double")
                     .withColumn(name, F.col(name).cast(S.SCORE)))
    got = rows(S.evaluation(*sides), "product_id", "total_score", "grade")
    assert [(i, float(t), g) for i, t, g in got] == [(0, 85.0, "A"), (1, 70.0, "B"), (2, 50.0, "C"), (3, 50.0, "D")]
    capped = S.service_score(frame([(1, 5000, 5000)], "product_id int, pic_review_count int, positive_review_count int"))
    assert float(capped.first()["service_score"]) == 100.0


def test_week_keys_at_year_ends(frame):
    df = frame([(date(2020, 12, 31),), (date(2021, 1, 3),), (date(2021, 1, 4),)], "d date").select(X.week_key("d").alias("w"))
    assert [r[0] for r in df.collect()] == ["202053", "202053", "202101"]


def test_calendar_has_every_day(spark):
    cal = D.calendar(spark, "2024-02-27", "2024-03-01")
    assert [r["date_key"] for r in cal.orderBy("date_key").collect()] == [20240227, 20240228, 20240229, 20240301]


def test_lookups_pass_missing_and_blank_keys(frame, rows):
    orders = frame([(1, "5"), (2, " "), (3, None), (4, "9")], "id int, sku string")
    dim = frame([(5, "five")], "key int, name string")
    assert rows(J.look_up(orders, dim, "sku", "key", "dim_"), "id", "dim_name") == [(1, "five"), (2, None), (3, None), (4, None)]


def test_order_wide_uses_newest_rows_and_event_type(frame, rows):
    detail = frame([(1, 10, 5), (2, 11, 5), (3, 12, 5)], "order_detail_id int, order_id int, ts_ms int")
    info = frame([(10, 1, 1), (10, 2, 9), (11, 1, 1)], "order_id int, province_id int, ts_ms int")
    link = frame([(1, 7, 1)], "order_detail_id int, activity_id int, ts_ms int")
    coupon = frame([(1, 8, 1)], "order_detail_id int, coupon_id int, ts_ms int")
    pay = frame([(10, 3.0, 1), (11, 4.0, 1)], "order_id int, pay_amount double, ts_ms int")
    refund = frame([(11, 1, 2.0, 5), (11, 2, 9.0, 4)], "order_id int, refund_id int, refund_amount double, refund_create_time int")
    got = rows(J.order_wide(detail, info, link, coupon, pay, refund), "order_detail_id", "province_id", "event_type", "refund_amount")
    assert got == [(1, 2, "payment", None), (2, 1, "refund", 2.0), (3, None, "order", None)]


def test_activities_with_several_rules_and_none(frame, rows):
    wide = J.activity_sku_wide(
        frame([(1, 10), (2, 10), (3, 10)], "activity_id int, sku_id int"), frame([(1, "a"), (2, "b")], "activity_id int, activity_name string"),
        frame([(5, 1), (6, 1)], "rule_id int, activity_id int"), frame([(10, 100, 200)], "sku_id int, category3_id int, tm_id int"),
        frame([(100, "c")], "category3_id int, category3_name string"), frame([(201, "t")], "tm_id int, tm_name string"))
    assert rows(wide, "activity_id", "rule_id", "tm_name") == [(1, 5, None), (1, 6, None), (2, None, None)]


def test_carts_do_not_set_the_favourite_flag_and_removals_do_not_count(frame):
    base = "date_key int, item_id int, user_id int"
    none = frame([], f"{base}, visit_id bigint, dwell_seconds bigint")
    facts = I.conform(
        none, frame([], f"{base}, fav_id bigint, action_type string"),
        frame([(20240101, 1, 1, 1, "ADD", 2), (20240101, 1, 1, 2, "REMOVE", 5)], f"{base}, cart_id bigint, action_type string, quantity bigint"),
        frame([], f"{base}, order_id bigint, quantity bigint, order_amount double"),
        frame([], f"{base}, payment_id bigint, order_id bigint, quantity bigint, payment_amount double"),
        frame([], f"{base}, micro_id bigint, duration_sec bigint"))
    row = I.user_item_days(facts).first()
    assert (row["is_fav_add"], row["is_cart_add"], row["cart_add_quantity"]) == (0, 1, 2)
    day = I.item_days(facts, frame([(1, "n", 3, 1.0)], "item_id int, item_name string, category_id int, price double"),
                      frame([(4, "x")], "category_id int, category_name string")).first()
    assert (day["bounce_count"], day["cart_add_quantity"], day["cart_remove_count"], day["category_name"]) == (0, 2, 1, None)


def test_latest_prices_keep_ties(frame, rows):
    change = frame([(1, "2024-01-01", 5), (1, "2024-01-02", 7), (1, "2024-01-02", 8)], "product_id int, dt string, new_price int")
    assert rows(R.latest_prices(change)) == [(1, 7), (1, 8)]


def test_open_payments_share_a_partition(frame):
    df = frame([(None,), (datetime(2024, 1, 2),)], "t timestamp").select(A.payment_day("t").alias("d"))
    assert sorted(r[0] for r in df.collect()) == ["2024-01-02", "9999-99-99"]


def test_new_flag_repair(frame, rows):
    d = lambda n: datetime(2024, 1, n)
    df = frame([("a", "1", d(1), 1), ("a", "1", d(2), 2), ("b", "0", d(1), 3), ("b", "1", d(1), 4), ("c", "1", d(3), 5), ("c", "1", d(3), 6)],
               "mid string, is_new string, ts timestamp, id int")
    got = rows(U.repaired_new_flag(df, "mid", "is_new", "ts", ["ts", "id"]), "id", "is_new")
    assert got == [(1, "1"), (2, "0"), (3, "0"), (4, "0"), (5, "1"), (6, "1")]


def test_first_seen_and_full_record_dedup(frame, rows):
    df = frame([(1, 5), (1, 3), (2, 9), (2, 9)], "user_id int, ts int")
    assert rows(U.first_seen(df, "user_id", ["ts"], "uv")) == [(1, 3, 1), (2, 9, 1)]
    assert U.exact(df).count() == 3


def test_grouped_rows_are_whole_and_bounded(frame):
    df = frame([(1, i, f"n{i}") for i in range(2500)] + [(2, 1, "x")], "k int, id int, n string")
    lists = D.grouped_rows(df, "k", "id", ["n"], chunk=1000).collect()
    assert sum(len(r["rows"]) for r in lists) == 2501 and max(len(r["rows"]) for r in lists) == 1000


def test_versions_close_and_reopen(frame, rows):
    first = D.initial_versions(frame([(1, "a"), (2, "b")], "id int, v string"), "id", "key", "2024-01-01")
    later = D.next_versions(first, frame([(1, "a"), (2, "c"), (3, "d")], "id int, v string"), "id", "key", ["v"], "2024-02-01")
    assert rows(later.select("key", "id", "v", "current_flag", F.date_format("end_date", "yyyy-MM-dd"))) == [
        (1, 1, "a", "Y", "9999-12-31"), (2, 2, "b", "N", "2024-01-31"), (3, 2, "c", "Y", "9999-12-31"), (4, 3, "d", "Y", "9999-12-31")]


def test_next_page_crosses_slots_and_ends_in_null(frame, rows):
    t = lambda m: datetime(2024, 1, 1, 0, m)
    log = frame([("a", t(0), 1, "trade", "d"), ("a", t(45), 2, "payment", "d"), ("a", t(46), 3, "home", "d"), ("b", t(1), 4, "trade", "d")],
                "mid string, ts timestamp, event_id int, page_id string, dt string")
    assert rows(P.next_pages(log), "event_id", "next_page_id") == [(1, "payment"), (2, "home"), (3, None), (4, None)]


def test_channel_without_name(frame, rows):
    log = frame([(None, "1", None), ("c", "1", "home"), ("c", "2", None)], "ch string, uid string, last_page_id string")
    assert rows(P.channel_bounces(log)) == sorted([("c", 2, 50.0), (P.UNKNOWN_CHANNEL, 1, 100.0)], key=lambda r: tuple((False, str(v)) for v in r))


def test_empty_inputs_give_empty_results(frame):
    pay = frame([], "product_id int, dt string, sku_id int, item_id int, amount double, quantity int, user_id int")
    assert R.sku_sales(pay).count() == 0 and R.sku_days(pay, "2024-01-31").count() == 0


def test_scores_of_one_row_are_those_of_joined_sides(frame, rows):
    inputs = [c for w in (S.TRAFFIC, S.CONVERSION, S.ENGAGEMENT, S.ACQUISITION, S.SERVICE) for c in w]
    data = [(i, date(2024, 1, 1 + i % 2), *[float((i * 7 + k * 3) % 11) for k in range(len(inputs))]) for i in range(9)] + [(9, None, *[None] * len(inputs))]
    df = frame(data, "product_id int, date_key date, " + ", ".join(f"{c} double" for c in inputs))
    one = S.all_scores(df)
    sides = [getattr(S, f)(df) for f in ("traffic_score", "conversion_score", "engagement_score", "acquisition_score", "service_score")]
    cols = [*S.KEYS, *S.SCORES, "total_score", "grade"]
    assert rows(one.where("product_id < 9"), *cols) == rows(S.evaluation(*sides), *cols)


def test_competitors_rank_nulls_last_and_share_ties(frame, rows):
    score = S.SCORE
    data = [(i, date(2024, 1, 1) if i < 5 else None, f"n{i}", "c" if i != 2 else None, "A", *[v] * 5, 1.0, 2.0) for i, v in enumerate([9.0, 9.0, 7.0, None, 3.0, 1.0])]
    df = frame(data, "product_id int, date_key date, product_name string, category_name string, grade string, " + ", ".join(f"{s} double" for s in S.SCORES) + ", total_score double, market_avg_score double")
    df = df.withColumns({s: F.col(s).cast(score) for s in S.SCORES})
    got = {r["product_id"]: r for r in S.competitors(df).collect()}
    assert {k: r["service_rank"] for k, r in got.items()} == {0: 1, 1: 1, 2: 1, 3: 4, 4: 3, 5: 1}
    assert all(r["traffic_rank"] == r["service_rank"] and r["product_name"] == f"n{k}" and r["total_score_diff"] == -1.0 for k, r in got.items())


def test_rank_plans_stay_short(frame):
    """At most eight shuffles for numbering rows, and one read of the rows per side."""
    df = frame([(1, "A", date(2024, 1, 1), 5.0)], "product_id int, grade string, date_key date, total_score double")
    plan = S.grade_ranks(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 8


def trade_frames(frame):
    day = lambda d: f"2024-01-{d:02d}"
    at = lambda d, h=1: datetime(2024, 1, d, h)
    visit = frame([(1, 7, day(20), at(20)), (1, 7, day(20), at(20, 2)), (2, 7, day(3), at(3)), (None, 8, day(20), at(20))], "product_id int, user_id int, dt string, event_time timestamp")
    micro = frame([(2, 7, day(20), at(20)), (3, 7, day(21), at(21)), (4, 1, day(20), at(20))], "product_id int, user_id int, dt string, event_time timestamp")
    stay = frame([(1, "PRODUCT_DETAIL", 10.0, 1, day(20), at(20)), (1, "LIST", 99.0, 1, day(20), at(20))], "product_id int, page_type string, stay_seconds double, is_bounce int, dt string, entry_time timestamp")
    cart = frame([(1, 7, "ADD", day(20), at(20)), (4, 7, "REMOVE", day(22), at(22)), (2, 9, "REMOVE", day(20), at(20))], "product_id int, user_id int, action_type string, dt string, action_time timestamp")
    lines = frame([(1, 7, 10.0, "PAID", at(23), day(20)), (1, 8, 5.0, "CREATED", None, day(20)), (3, 8, 5.0, "PAID", at(1), day(1))],
                  "product_id int, user_id int, amount double, status string, pay_time timestamp, dt string")
    return visit, micro, stay, cart, lines


def test_product_days_need_known_products_and_open_days(frame):
    visit, micro, stay, cart, lines = trade_frames(frame)
    trade = R.trade_events(lines, "2024-01-31", 14)
    assert {(r["kind"], r["dt"], r["user_id"]) for r in trade.collect()} == {("order", "2024-01-20", 7), ("pay", "2024-01-23", 7), ("order", "2024-01-20", 8)}
    known = R.known_products(visit, cart, lines)
    got = {(r["product_id"], r["dt"]): r for r in R.product_days(visit, micro, stay, cart, trade, known, "2024-01-31", 14).collect()}
    # day 21 has micro views only; product 2 is known from a visit before the range, product 4 from a removal
    assert set(got) == {(1, "2024-01-20"), (1, "2024-01-23"), (2, "2024-01-20"), (4, "2024-01-20")}
    row = got[1, "2024-01-20"]
    assert (row["visit_cnt"], row["browse_cnt"], row["cart_add_cnt"], row["order_user_cnt"], float(row["order_amount"]), row["pay_cnt"]) == (1, 2, 1, 2, 15.0, 0)
    assert (float(row["avg_stay_duration"]), float(row["bounce_rate"])) == (10.0, 100.0) and got[1, "2024-01-23"]["pay_user_cnt"] == 1


def test_latest_prices_and_priced_products(frame, rows):
    change = frame([(1, "2024-01-01", 5.0), (1, "2024-01-02", 6.0), (1, "2024-01-02", 8.0), (2, None, 3.0), (3, "2024-01-01", None)], "product_id int, dt string, new_price double")
    change = change.withColumn("new_price", F.col("new_price").cast("decimal(18,2)"))
    assert [(p, v and float(v)) for p, v in rows(R.latest_prices(change))] == [(1, 6.0), (1, 8.0), (3, None)]
    product = frame([(1, 10), (2, 10), (3, 10), (4, None)], "product_id int, third_cat_id int")
    got = {r["product_id"]: (r["price_force_level"], float(r["current_price"]), float(r["market_price"])) for r in R.priced_products(change, product).collect()}
    assert got == {1: (1, 8.0, 7.0), 2: (1, 0.0, 7.0), 3: (4, 0.0, 7.0), 4: (1, 0.0, 0.0)}


def test_activities_count_things_once(frame):
    payment = frame([(1, "a", 100, 5, 7, 1, 3.0), (1, "a", 100, 5, 7, 1, 2.0), (1, "a", 101, 6, 7, 2, 4.0), (1, "b", 102, None, None, 2, 1.0)],
                    "date_key int, activity_id string, payment_id int, order_id int, item_id int, user_id int, payment_amount double")
    order = frame([(5, 7, 50.0), (5, 7, 1.0)], "order_id int, item_id int, order_amount double")
    refund = frame([(100, 1, 9.0), (100, 1, 1.0), (100, 2, 1.0)], "payment_id int, refund_id int, refund_amount double")
    activity = frame([("a", "A"), ("b", "B"), ("none", "N")], "activity_id string, activity_name string")
    got = {r["activity_id"]: r for r in I.activity_effect(activity, payment, order, refund).collect()}
    pick = lambda r: (r["payment_count"], r["item_count"], r["payment_user_count"], r["order_count"], r["total_order_amount"], r["payment_amount"], r["refund_count"], r["refund_amount"])
    assert pick(got["a"]) == (2, 1, 2, 1, 51.0, 9.0, 2, 11.0)
    assert pick(got["b"]) == (1, 0, 1, 0, 0.0, 1.0, 0, 0.0) and pick(got["none"]) == (0,) * 4 + (0.0, 0.0, 0, 0.0)


def test_next_pages_of_a_range(frame, rows):
    at = lambda d, h: datetime(2024, 1, d, h)
    log = frame([("m", at(1, 1), 1, "home"), ("m", at(5, 1), 2, "trade"), ("m", at(9, 1), 3, "payment"), ("m", at(9, 2), 4, "mine"), ("n", at(5, 2), 5, "trade")],
                "mid string, ts timestamp, event_id int, page_id string").withColumn("dt", F.date_format("ts", "yyyy-MM-dd"))
    assert rows(P.next_pages(log, "2024-01-04", "2024-01-06"), "event_id", "next_page_id") == [(2, "payment"), (5, None)]
    assert rows(P.next_pages(log), "event_id", "next_page_id") == [(1, "trade"), (2, "payment"), (3, "mine"), (4, None), (5, None)]


def test_item_dimension_is_looked_up_once(frame, rows):
    sku, spu = frame([("1", 5, 6, 7, "s")], "id string, spu_id int, category3_id int, tm_id int, sku_name string"), frame([(5, "p")], "id int, spu_name string")
    category, mark = frame([(6, "c")], "id int, name string"), frame([], "id int, tm_name string")
    item = J.item_dimension(sku, spu, category, mark)
    people, places = frame([(1, "u")], "id int, name string"), frame([(2, "v")], "id int, name string")
    orders = frame([("1", 1, 2), ("9", 1, None)], "sku_id string, user_id int, province_id int")
    got = J.enrich_orders(orders, item, people, places)
    cols = ["sku_id", "dim_sku_name", "spu_id", "dim_spu_spu_name", "dim_category3_name", "dim_tm_tm_name", "dim_user_name", "dim_province_name"]
    assert rows(got, *cols) == [("1", "s", 5, "p", "c", None, "u", "v"), ("9", None, None, None, None, None, "u", None)]


def test_items_dealt_out_once_count_as_before(spark, frame, rows, monkeypatch):
    kinds = [("visit", None), ("fav", "ADD"), ("fav", "REMOVE"), ("cart", "ADD"), ("cart", "REMOVE"), ("order", None), ("payment", "JUHUASUAN"), ("payment", None), ("micro", None), ("refund", None)]
    data = []
    for k in range(400):
        kind, action = kinds[k * 7 % 10]
        item = None if k % 31 == 0 else 1 if k % 3 else k % 9
        user = None if kind == "refund" or k % 29 == 0 else k % 7
        order = k % 20 if kind in ("order", "payment") else None
        data.append((20240101 + k % 2, item, user, kind, k % 50, order, action, k % 6, k % 4, f"{k % 9}.25"))
    facts = frame(data, "date_key bigint, item_id bigint, user_id bigint, kind string, fact_id bigint, order_id bigint, action string, dwell bigint, quantity bigint, amount string")
    facts = facts.withColumn("amount", F.col("amount").cast(I.MONEY))
    item = frame([(i, f"i{i}", i % 3, 5.0) for i in range(8)], "item_id bigint, item_name string, category_id bigint, price double")
    category = frame([(0, "a"), (1, "b")], "category_id bigint, category_name string")
    spread = I.item_measures(facts, item, category)
    columns = sorted(spread.columns)
    want = sorted(rows(spread, *columns), key=str)
    assert len(want) >= 8
    for hot in ([], [1], [1, 5, 77]):
        assert sorted(rows(I.item_measures(facts, item, category, hot), *columns), key=str) == want
    plan = I.item_overview(I.item_measures(facts, item, category, []))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(date_key" not in plan and plan.count("hashpartitioning(item_id") <= 2  # the facts and, if not broadcast, the items
    assert I.hot_items(facts) == []
    monkeypatch.setattr(I, "HOT_ROWS", 100)
    assert I.hot_items(facts) == [1]


def test_item_action_days_are_planned_with_one_shuffle_of_the_facts(spark):
    from tradewake.plans import items
    from tradewake.sources.tables import Tables

    plan = items.item_action_dd(Tables(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(date_key" not in plan
