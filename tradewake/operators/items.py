"""Item dashboard: item, user, category, activity and buyer summaries per day.

All summaries start from one conformed list of facts with a ``kind`` column, so
each needs one full shuffle; later groupings work on shrinking data.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.positions import running_total
from tradewake.session import freed

MONEY = "decimal(18,2)"
BOUNCE_SECONDS = 3


def conform(visit: DataFrame, fav: DataFrame, cart: DataFrame, order: DataFrame, payment: DataFrame, micro: DataFrame, refund: DataFrame | None = None) -> DataFrame:
    """Six facts as rows of (date_key, item_id, user_id, kind, fact_id, order_id, action, dwell, quantity, amount).

    The action of a payment is its activity, where it has one. Refunds, if given, are rows without a user: they make nobody a visitor.
    """
    none_id, none_text = F.lit(None).cast("bigint"), F.lit(None).cast("string")

    def rows(df, kind, fact_id, order_id=none_id, action=none_text, dwell=None, quantity=None, amount=None):
        pick = lambda c: F.lit(0) if c is None else F.col(c)
        return df.select(
            "date_key", "item_id", "user_id", F.lit(kind).alias("kind"), F.col(fact_id).alias("fact_id"),
            order_id.alias("order_id"), action.alias("action"), pick(dwell).cast("bigint").alias("dwell"),
            pick(quantity).cast("bigint").alias("quantity"), pick(amount).cast(MONEY).alias("amount"),
        )

    parts = [
        rows(visit, "visit", "visit_id", dwell="dwell_seconds"),
        rows(fav, "fav", "fav_id", action=F.col("action_type")),
        rows(cart, "cart", "cart_id", action=F.col("action_type"), quantity="quantity"),
        rows(order, "order", "order_id", F.col("order_id"), quantity="quantity", amount="order_amount"),
        rows(payment, "payment", "payment_id", F.col("order_id"), F.col("activity_id") if "activity_id" in payment.columns else none_text, quantity="quantity", amount="payment_amount"),
        rows(micro, "micro", "micro_id", dwell="duration_sec"),
    ]
    if refund is not None:
        parts.append(rows(refund.withColumn("user_id", none_id), "refund", "refund_id", amount="refund_amount"))
    return reduce(DataFrame.unionByName, parts)


def _sum_if(cond, c: str):
    return F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))


def _kind(*kinds: str):
    return F.col("kind").isin(*kinds)


def _action(kind: str, action: str):
    return (F.col("kind") == kind) & (F.col("action") == action)


def item_days(facts: DataFrame, item: DataFrame, category: DataFrame, hot: list[int] | None = None) -> DataFrame:
    """19 measures per item and day."""
    return item_measures(facts, item, category, hot).drop(*EXTRA)


#: Facts of an item that one task may take, and groups of items that are counted first.
HOT_ROWS, CELLS = 4_000_000, 4096


def hot_items(facts: DataFrame) -> list[int]:
    """Items with more facts than one task should take: there can be few of them.

    Facts are counted by cells of items first; only items of cells with too many facts are counted themselves.
    """
    cell = F.pmod(F.xxhash64("item_id"), F.lit(CELLS))
    with freed(facts.sparkSession):
        full = [r["cell"] for r in facts.groupBy(cell.alias("cell")).count().where(F.col("count") > HOT_ROWS).collect()]
        if not full:
            return []
        counts = facts.where(cell.isin(full) & F.col("item_id").isNotNull()).groupBy("item_id").count()
        return [r["item_id"] for r in counts.where(F.col("count") > HOT_ROWS).collect()]


#: Measures of the overview beside those of an item day.
EXTRA = ["cart_uv", "refund_amt", "jhs_pay_amt"]


def item_measures(facts: DataFrame, item: DataFrame, category: DataFrame, hot: list[int] | None = None) -> DataFrame:
    """The measures of an item day, cart users, refunds and group-buy amounts.

    Facts of items outside ``hot`` (``hot_items``) are dealt out once, by item, and all groupings, the item's names and
    later windows over an item stay where they are; those of hot items, and all facts without ``hot``, are spread over their
    users first and shuffled for every level.
    """
    named = item.select("item_id", "item_name", "category_id", "price").join(
        category.select("category_id", "category_name"), "category_id", "left"
    )
    if hot is None:
        return _item_totals(facts).join(named, "item_id")
    once = facts.where(F.col("item_id").isNotNull())
    rows = once.where(~F.col("item_id").isin(hot)) if hot else once
    out = _item_totals(rows.repartition("item_id")).join(named, "item_id")
    return out.unionByName(_item_totals(once.where(F.col("item_id").isin(hot))).join(named, "item_id")) if hot else out


def _item_totals(facts: DataFrame) -> DataFrame:
    """Measures by item and day.

    Distinct counts over visits, users, orders, payments and micro views are
    taken level by level: fact, user, item. A day with refunds only is no item day.
    """
    per_fact = facts.groupBy("date_key", "item_id", "user_id", "kind", "action", "fact_id", "order_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("dwell").alias("dwell"),
        F.sum(F.when(_kind("visit") & (F.col("dwell") < BOUNCE_SECONDS), 1).otherwise(0)).alias("bounces"),
        F.sum("quantity").alias("quantity"),
        F.sum("amount").alias("amount"),
    )
    distinct = lambda kind: F.count(F.when(_kind(kind), 1))
    per_user = per_fact.groupBy("date_key", "item_id", "user_id").agg(
        distinct("visit").alias("visit_count"),
        F.sum("dwell").alias("total_dwell_seconds"),
        F.sum("bounces").alias("bounce_count"),
        _sum_if(_action("fav", "ADD"), "n").alias("fav_add_count"),
        _sum_if(_action("fav", "REMOVE"), "n").alias("fav_remove_count"),
        _sum_if(_action("cart", "ADD"), "n").alias("cart_add_count"),
        _sum_if(_action("cart", "REMOVE"), "n").alias("cart_remove_count"),
        _sum_if(_action("cart", "ADD"), "quantity").alias("cart_add_quantity"),
        F.countDistinct("order_id").alias("order_count"),
        _sum_if(_kind("order"), "quantity").alias("order_quantity"),
        _sum_if(_kind("order"), "amount").alias("order_amount"),
        distinct("payment").alias("payment_count"),
        _sum_if(_kind("payment"), "quantity").alias("payment_quantity"),
        _sum_if(_kind("payment"), "amount").alias("payment_amount"),
        distinct("micro").alias("micro_detail_count"),
        F.max(F.when(_kind("order"), F.col("user_id"))).alias("order_user"),
        F.max(F.when(_kind("payment"), F.col("user_id"))).alias("payment_user"),
        F.max(F.when(_kind("micro"), F.col("user_id"))).alias("micro_user"),
        F.max(F.when(_action("cart", "ADD"), F.col("user_id"))).alias("cart_user"),
        _sum_if(_kind("refund"), "amount").alias("refund_amt"),
        _sum_if(_action("payment", "JUHUASUAN"), "amount").alias("jhs_pay_amt"),
        F.max(F.when(~_kind("refund"), 1)).alias("_facts"),
    )
    sums = ["visit_count", "total_dwell_seconds", "bounce_count", "fav_add_count", "fav_remove_count", "cart_add_count",
            "cart_remove_count", "cart_add_quantity", "order_count", "order_quantity", "order_amount", "payment_count",
            "payment_quantity", "payment_amount", "micro_detail_count", "refund_amt", "jhs_pay_amt"]
    return per_user.groupBy("date_key", "item_id").agg(
        F.count("user_id").alias("visitor_count"),
        F.count("order_user").alias("order_user_count"),
        F.count("payment_user").alias("payment_user_count"),
        F.count("micro_user").alias("micro_detail_user_count"),
        F.count("cart_user").alias("cart_uv"),
        F.max("_facts").alias("_facts"),
        *[F.sum(c).alias(c) for c in sums],
    ).where("_facts = 1").drop("_facts")


def user_item_days(facts: DataFrame) -> DataFrame:
    """What each user did with each item on each day: flags and sums."""
    flag = lambda cond: F.max(F.when(cond, 1).otherwise(0))
    return facts.groupBy("date_key", "user_id", "item_id").agg(
        flag(_kind("visit")).alias("is_visit"),
        flag(_action("fav", "ADD")).alias("is_fav_add"),
        flag(_action("cart", "ADD")).alias("is_cart_add"),
        flag(F.col("order_id").isNotNull()).alias("is_order"),
        flag(_kind("payment")).alias("is_payment"),
        flag(_kind("micro")).alias("is_micro_detail"),
        F.sum("dwell").alias("visit_dwell_seconds"),
        _sum_if(_action("cart", "ADD"), "quantity").alias("cart_add_quantity"),
        _sum_if(_kind("order"), "quantity").alias("order_quantity"),
        _sum_if(_kind("order"), "amount").alias("order_amount"),
        _sum_if(_kind("payment"), "amount").alias("payment_amount"),
    )


FLAGS = {"is_visit": "visitor", "is_fav_add": "fav_user", "is_cart_add": "cart_user", "is_order": "order_user",
         "is_payment": "payment_user"}
ITEM_FLAGS = {"is_visit": "visited_item", "is_order": "ordered_item", "is_payment": "paid_item"}


def category_days(user_item: DataFrame, item: DataFrame, category: DataFrame) -> DataFrame:
    """Users and items per category and day, by what was done."""
    keys = ["date_key", "category_id"]
    joined = user_item.join(item.select("item_id", "category_id"), "item_id")
    by_user = joined.groupBy(*keys, "user_id").agg(
        *[F.max(f).alias(f) for f in FLAGS], F.sum("payment_amount").alias("payment_amount")
    )
    users = by_user.groupBy(*keys).agg(
        *[F.sum(f).alias(f"{name}_count") for f, name in FLAGS.items()], F.sum("payment_amount").alias("payment_amount")
    )
    by_item = joined.groupBy(*keys, "item_id").agg(*[F.max(f).alias(f) for f in ITEM_FLAGS])
    items = by_item.groupBy(*keys).agg(*[F.sum(f).alias(f"{name}_count") for f, name in ITEM_FLAGS.items()])
    return users.join(items, keys).join(category, "category_id")


def activity_effect(activity: DataFrame, payment: DataFrame, order: DataFrame, refund: DataFrame) -> DataFrame:
    """Orders, payments and refunds per activity and day; activities without payments stay.

    Order and refund amounts are summed per payment side before the join, so
    nothing is counted twice. A payment brings one row for each thing to be counted, its
    amounts with the first: one grouping makes the things distinct, a second counts and sums.
    """
    order_side = order.groupBy("order_id", "item_id").agg(F.sum("order_amount").alias("order_amount"))
    refund_side = refund.groupBy("payment_id").agg(
        F.countDistinct("refund_id").alias("refunds"), F.sum("refund_amount").alias("refund_amount")
    )
    paid = payment.groupBy("date_key", "activity_id", "payment_id", "order_id", "item_id", "user_id").agg(
        F.sum("payment_amount").alias("payment_amount")
    )
    linked = paid.join(order_side, ["order_id", "item_id"], "left").join(refund_side, "payment_id", "left")
    keys, amounts = ["date_key", "activity_id"], ["order_amount", "payment_amount", "refunds", "refund_amount"]
    things = {"payment_count": F.col("payment_id"), "item_count": F.col("item_id"), "payment_user_count": F.col("user_id"),
              "order_count": F.when(F.col("order_amount").isNotNull(), F.col("order_id"))}
    sums = F.struct(*amounts)
    thing = lambda name, thing_id: F.struct(
        F.lit(name).alias("thing"), thing_id.cast("bigint").alias("id"), F.when(F.lit(name == "payment_count"), sums).alias("a"))
    rows = linked.select(*keys, F.inline(F.array(*[thing(n, i) for n, i in things.items()])))
    once = rows.groupBy(*keys, "thing", "id").agg(*[F.sum(f"a.{c}").alias(c) for c in amounts])
    none = lambda name: (F.col("thing") == name) & F.col("id").isNotNull()
    out = once.groupBy(*keys).agg(
        *[F.count(F.when(none(n), 1)).alias(n) for n in things], F.sum("order_amount").alias("total_order_amount"), F.sum("payment_amount").alias("payment_amount"),
        F.sum("refunds").alias("refund_count"), F.sum("refund_amount").alias("refund_amount"),
    )
    out = activity.join(out, "activity_id", "left")
    counts = [*things, "refund_count", "total_order_amount", "payment_amount", "refund_amount"]
    filled = out.select("date_key", "activity_id", "activity_name", *[X.zero(c).alias(c) for c in counts])
    return filled.withColumn("visitor_count", F.col("payment_user_count")).withColumn(
        "paid_order_amount", F.col("total_order_amount")
    )


def user_periods(user_item: DataFrame, user: DataFrame) -> DataFrame:
    """Week and month totals per user, with the new-buyer flag."""
    sums = {"is_fav_add": "fav_add_count", "is_cart_add": "cart_add_count", "is_order": "order_count",
            "is_payment": "payment_count", "order_amount": "total_order_amount", "payment_amount": "total_payment_amount"}
    days = user_item.groupBy("user_id", "date_key").agg(F.max("is_visit").alias("visited"), *[F.sum(c).alias(n) for c, n in sums.items()])
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    periods = F.array(
        F.struct(F.lit("WEEK").alias("period_type"), X.week_key("day").alias("period_key")),
        F.struct(F.lit("MONTH").alias("period_type"), X.month_key("day").alias("period_key")),
    )
    spread = days.withColumn("day", day).withColumn("p", F.explode(periods))
    totals = spread.groupBy("p.period_type", "p.period_key", "user_id").agg(
        F.min("day").alias("start_day"), F.sum("visited").alias("visit_count"), *[F.sum(n).alias(n) for n in sums.values()]
    )
    return (
        totals.join(user.select("user_id", "last_payment_date"), "user_id")
        .withColumn("is_new_buyer", X.is_new_buyer("last_payment_date", "start_day").cast("int"))
        .drop("last_payment_date", "start_day")
    )


def buyer_types(payment: DataFrame, user: DataFrame) -> DataFrame:
    """New and old buyers and their amounts per item and day."""
    day = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    rows = payment.join(user.select("user_id", "last_payment_date"), "user_id").withColumn(
        "new", X.is_new_buyer("last_payment_date", day)
    )
    new, old = F.col("new"), ~F.col("new")
    return rows.groupBy("date_key", "item_id").agg(
        F.sum(new.cast("int")).alias("new_buyer_count"),
        F.sum(old.cast("int")).alias("old_buyer_count"),
        _sum_if(new, "payment_amount").alias("new_buyer_amt"),
        _sum_if(old, "payment_amount").alias("old_buyer_amt"),
    )


def with_ytd(item_day: DataFrame) -> DataFrame:
    """Paid amount from the start of the year to each day beside the rows of an item."""
    rows = item_day.withColumn("_year", F.floor(F.col("date_key") / 10_000))
    return running_total(rows, ["item_id", "_year"], "date_key", "payment_amount", "ytd_pay_amt").drop("_year")


def ytd_amounts(item_day: DataFrame) -> DataFrame:
    return with_ytd(item_day.select("item_id", "date_key", "payment_amount")).select("item_id", "date_key", "ytd_pay_amt")


def item_overview(measures: DataFrame) -> DataFrame:
    """Item day totals with rates, refunds, group-buy and year-to-date amounts."""
    d = with_ytd(measures).withColumn("cart_uv", F.when(F.col("cart_uv") > 0, F.col("cart_uv")))
    uv, c = F.col("visitor_count"), F.col
    return d.select(
        "date_key", "item_id", "category_id", uv.alias("uv"), c("visit_count").alias("pv"),
        (uv > 0).cast("int").alias("visited_items"), c("total_dwell_seconds").alias("total_dwell_sec"), "bounce_count",
        c("micro_detail_user_count").alias("micro_uv"), c("fav_add_count").alias("fav_uv"), c("cart_add_quantity").alias("cart_qty"),
        "cart_uv", c("order_user_count").alias("order_uv"), c("payment_user_count").alias("pay_uv"),
        c("order_quantity").alias("order_qty"), c("order_amount").alias("order_amt"), c("payment_quantity").alias("pay_qty"),
        c("payment_amount").alias("pay_amt"), (c("payment_quantity") > 0).cast("int").alias("paid_items"),
        X.zero("refund_amt").alias("refund_amt"), X.zero("jhs_pay_amt").alias("jhs_pay_amt"), X.zero("ytd_pay_amt").alias("ytd_pay_amt"),
        X.ratio("total_dwell_seconds", uv, 2).alias("avg_stay_sec"), X.ratio("bounce_count", uv, 4).alias("bounce_rate"),
        X.ratio("fav_add_count", uv, 4).alias("fav_conversion_rate"), X.ratio("cart_uv", uv, 4).alias("cart_conversion_rate"),
        X.ratio("order_user_count", uv, 4).alias("order_conversion_rate"), X.ratio("payment_user_count", uv, 4).alias("pay_conversion_rate"),
        X.ratio("payment_amount", "payment_user_count", 2).alias("atv"), X.ratio("payment_amount", uv, 2).alias("visitor_value"),
    )


def item_bands(overview: DataFrame, item: DataFrame, buyers: DataFrame) -> DataFrame:
    """Sold items per day, category and band of price, quantity and amount."""
    sold = overview.where(F.col("pay_qty") > 0).select("date_key", "item_id", "pay_qty", "pay_amt")
    rows = (
        sold.join(item.select("item_id", "category_id", "price"), "item_id")
        .join(buyers, ["date_key", "item_id"], "left")
        .withColumn("price_band", X.price_band("price"))
        .withColumn("pay_qty_band", X.quantity_band("pay_qty"))
        .withColumn("pay_amt_band", X.amount_band("pay_amt"))
    )
    out = rows.groupBy("date_key", "category_id", "price_band", "pay_qty_band", "pay_amt_band").agg(
        F.countDistinct("item_id").alias("sale_item_count"),
        F.sum("pay_amt").alias("total_pay_amt"),
        F.sum("pay_qty").alias("total_pay_qty"),
        F.sum(X.zero("new_buyer_count")).alias("new_buyer_count"),
        F.sum(X.zero("new_buyer_amt")).alias("new_buyer_amt"),
    )
    return out.withColumn("avg_item_price", X.ratio("total_pay_amt", "total_pay_qty"))


def activity_types(payment: DataFrame) -> DataFrame:
    """Activity types that occur in payments, with labels."""
    kind = F.when(F.col("is_group_buy") == 1, "JUHUASUAN").when(F.col("is_presale") == 1, "PRESALE").otherwise("NORMAL")
    label = F.when(F.col("activity_type") == "NORMAL", "普通活动").when(F.col("activity_type") == "PRESALE", "预售活动").otherwise("聚划算")
    return payment.select(kind.alias("activity_type")).distinct().withColumn("type_name", label)
