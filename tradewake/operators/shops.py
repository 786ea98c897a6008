"""Shop and item day metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.windows import windowed

DAY = "1 day"
AMOUNT = "decimal(20,2)"


def _success(status: str):
    return F.lower(F.col(status)) == "success"


def page_items(page: DataFrame) -> DataFrame:
    return windowed(page, "event_time", DAY, ["shop_id", "item_id"], "user_id", "pv", "uv")


def page_shops(page: DataFrame) -> DataFrame:
    return windowed(page, "event_time", DAY, ["shop_id"], "user_id", "pv", "uv")


def order_items(order: DataFrame) -> DataFrame:
    out = windowed(order, "order_time", DAY, ["shop_id", "item_id"], "buyer_id", "_rows", "order_buyer_cnt")
    return out.drop("_rows")


def pay_items(pay: DataFrame) -> DataFrame:
    """Buyers, amount and flagged payments; only successful ones count."""
    ok = _success("pay_status")
    marked = pay.withColumn("_buyer", F.when(ok, F.col("buyer_id")))
    sums = {
        "gross_pay_amt": F.when(ok, F.col("pay_amount")).otherwise(F.lit(0).cast(AMOUNT)),
        "presale_tail_pay_cnt": F.when(ok & F.col("is_presale_tail_paid"), 1).otherwise(0),
        "afterpay_pay_cnt": F.when(ok & F.col("is_zero_order_afterpay"), 1).otherwise(0),
    }
    out = windowed(marked, "pay_time", DAY, ["shop_id", "item_id"], "_buyer", "_rows", "pay_buyer_cnt", sums)
    return out.drop("_rows")


def refund_items(refund: DataFrame) -> DataFrame:
    amount = F.when(_success("refund_status"), F.col("refund_amount")).otherwise(F.lit(0).cast(AMOUNT))
    return refund.groupBy(F.window("refund_time", DAY), "shop_id", "item_id").agg(F.sum(amount).alias("refund_amt"))


def combine_items(page: DataFrame, order: DataFrame, pay: DataFrame, refund: DataFrame) -> DataFrame:
    """Four aggregates side by side per window, shop and item, missing sides 0.

    Full outer joins on the shared keys; on streams they run in append mode.
    """
    on = ["window", "shop_id", "item_id"]
    joined = reduce(lambda a, b: a.join(b, on, "full_outer"), [page, order, pay, refund])
    counts = ["pv", "uv", "order_buyer_cnt", "pay_buyer_cnt", "presale_tail_pay_cnt", "afterpay_pay_cnt"]
    amounts = ["gross_pay_amt", "refund_amt"]
    filled = joined.select(
        *on, *[X.zero(c).alias(c) for c in counts], *[F.coalesce(c, F.lit(0)).cast(AMOUNT).alias(c) for c in amounts]
    )
    net = F.greatest(F.col("gross_pay_amt") - F.col("refund_amt"), F.lit(0)).cast(AMOUNT)
    return filled.withColumn("net_pay_amt", net)


def item_days(page: DataFrame, order: DataFrame, pay: DataFrame, refund: DataFrame) -> DataFrame:
    """The same rows from the raw facts in one pass: union, per user, per item.

    One full shuffle in place of four aggregates and three outer joins.
    """
    ok_pay = _success("pay_status")
    zero = F.lit(0).cast(AMOUNT)

    def rows(df, ts, user, kind, amount=zero, tail=F.lit(0), after=F.lit(0)):
        return df.select(
            F.window(ts, DAY).alias("window"), "shop_id", "item_id", F.lit(kind).alias("kind"), user.alias("user"),
            amount.cast(AMOUNT).alias("amount"), tail.alias("tail"), after.alias("after"),
        )

    facts = [
        rows(page, "event_time", F.col("user_id"), "page"),
        rows(order, "order_time", F.col("buyer_id"), "order"),
        rows(pay, "pay_time", F.when(ok_pay, F.col("buyer_id")), "pay", F.when(ok_pay, F.col("pay_amount")).otherwise(zero),
             F.when(ok_pay & F.col("is_presale_tail_paid"), 1).otherwise(0),
             F.when(ok_pay & F.col("is_zero_order_afterpay"), 1).otherwise(0)),
        rows(refund, "refund_time", F.lit(None).cast("bigint"), "refund",
             F.when(_success("refund_status"), F.col("refund_amount")).otherwise(zero)),
    ]
    keys = ["window", "shop_id", "item_id"]
    per_user = reduce(DataFrame.unionByName, facts).groupBy(*keys, "kind", "user").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.sum("tail").alias("tail"), F.sum("after").alias("after")
    )
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    out = per_user.groupBy(*keys).agg(
        F.coalesce(F.sum(of("page", "n")), F.lit(0)).alias("pv"),
        F.count(of("page", "user")).alias("uv"),
        F.count(of("order", "user")).alias("order_buyer_cnt"),
        F.count(of("pay", "user")).alias("pay_buyer_cnt"),
        F.coalesce(F.sum("tail"), F.lit(0)).alias("presale_tail_pay_cnt"),
        F.coalesce(F.sum("after"), F.lit(0)).alias("afterpay_pay_cnt"),
        F.coalesce(F.sum(of("pay", "amount")), F.lit(0)).cast(AMOUNT).alias("gross_pay_amt"),
        F.coalesce(F.sum(of("refund", "amount")), F.lit(0)).cast(AMOUNT).alias("refund_amt"),
    )
    return out.withColumn("net_pay_amt", F.greatest(F.col("gross_pay_amt") - F.col("refund_amt"), F.lit(0)).cast(AMOUNT))


def shop_days(items: DataFrame, page: DataFrame) -> DataFrame:
    """Shop totals of the item rows; visitors come from the pages, as they do not add up."""
    sums = ["pv", "order_buyer_cnt", "pay_buyer_cnt", "gross_pay_amt", "refund_amt", "net_pay_amt"]
    totals = items.groupBy("window", "shop_id").agg(*[F.sum(c).alias(c) for c in sums])
    return totals.join(page_shops(page).select("window", "shop_id", "uv"), ["window", "shop_id"], "left")


def rollup_shops(items: DataFrame) -> DataFrame:
    """Item-day rows summed to shop days, from first start to last end."""
    sums = ["pv", "uv", "order_buyer_cnt", "pay_buyer_cnt", "gross_pay_amt", "refund_amt", "net_pay_amt"]
    return items.groupBy("dt", "shop_id").agg(
        F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"), *[F.sum(c).alias(c) for c in sums]
    )


def dated(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.to_date("window.start").alias("dt"), F.col("window.start").alias("window_start"),
                     F.col("window.end").alias("window_end"), *rest)


def keyed_totals(df: DataFrame, value: str) -> DataFrame:
    """Running total per shop and item (update mode on streams)."""
    return df.groupBy("shop_id", "item_id").agg(F.sum(value).alias("value"))


def net_payments(pay: DataFrame, refund: DataFrame) -> DataFrame:
    """Payment rows and negative refund rows in one list."""
    paid = pay.select("shop_id", "item_id", F.col("pay_amount").alias("amount"))
    back = refund.select("shop_id", "item_id", (-F.col("refund_amount")).alias("amount"))
    return paid.unionByName(back)


def top_items(totals: DataFrame, n: int = 50) -> DataFrame:
    """The n largest totals, ties by shop and item."""
    return totals.orderBy(F.col("value").desc(), "shop_id", "item_id").limit(n)


def metric_json(df: DataFrame, metric: str) -> DataFrame:
    return df.withColumn(
        "json",
        F.to_json(F.struct(F.lit(metric).alias("metric"), F.col("shop_id").cast("string").alias("shopId"),
                           F.col("item_id").cast("string").alias("itemId"), F.col("value").alias("value"))),
    )
