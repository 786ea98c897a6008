"""Product ranking warehouse: daily facts, traffic, search, price force, trailing metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.cdc import latest
from tradewake.operators.positions import cumulative_share
from tradewake.session import store

RATE = "decimal(18,4)"
MONEY = "decimal(18,2)"


#: Time columns of the facts; ``dt`` is their day.
TIMES = ("event_time", "entry_time", "visit_time", "search_time", "action_time", "order_time", "pay_time")


def trailing(df: DataFrame, as_of: str, first: int, last: int = 0) -> DataFrame:
    """Rows whose day lies in [as_of - first, as_of - last).

    A fact's own time is bounded too: unlike the day's text, that bound reaches the scan.
    """
    day = F.lit(as_of).cast("date")
    bound = lambda n: F.date_format(F.date_sub(day, n), "yyyy-MM-dd")
    for time in (c for c in TIMES if c in df.columns):
        kind = df.schema[time].dataType
        df = df.where((F.col(time) >= F.date_sub(day, first).cast(kind)) & (F.col(time) < F.date_sub(day, last).cast(kind)))
    return df.where((F.col("dt") >= bound(first)) & (F.col("dt") < bound(last)))


def _fixed(rate: Column) -> Column:
    """Rates as four-digit decimals, so that averages of them do not depend on row order."""
    return rate.cast(RATE)


def trade_events(lines: DataFrame, as_of: str, days: int) -> DataFrame:
    """Each order line as an event of its order day and, once paid, as one of its payment day; one read serves both.

    Lines of neither day in range leave before the join that may lie below.
    """
    recent = lambda day: (day >= F.date_format(F.date_sub(F.lit(as_of).cast("date"), days), "yyyy-MM-dd")) & (day < as_of)
    paid = (F.col("status") == "PAID") & F.col("pay_time").isNotNull()
    pay_day = X.day_text("pay_time")
    event = lambda kind, day: F.struct(F.lit(kind).alias("kind"), day.alias("dt"))
    events = F.array(event("order", F.col("dt")), F.when(paid, event("pay", pay_day)))
    return lines.where(recent(F.col("dt")) | (paid & recent(pay_day))).select("product_id", "user_id", "amount", F.inline(F.array_compact(events)))


def known_products(*facts: DataFrame) -> DataFrame:
    """The products that occur in any of the facts, whenever it was."""
    return reduce(DataFrame.unionByName, [d.select("product_id") for d in facts]).distinct()


# The names of the measures.
def product_days(visit: DataFrame, micro: DataFrame, stay: DataFrame, cart: DataFrame, trade: DataFrame, known: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Thirteen measures per product and day.

    ``trade`` holds order and pay events. The skeleton of all products times all days, from which empty rows would be
    dropped again, is never built: the rows that remain are those with at least one measure, which a union and one
    grouping give. Products must be ``known`` (``known_products`` of visits, payments and carts), and a day must have a
    visit, a payment or a cart of any product; the days are read off the rows themselves, at most ``days`` of them.
    """

    def rows(df, kind, user=F.lit(None).cast("bigint"), amount=F.lit(0), stay_s=F.lit(0), bounce=F.lit(0)):
        return trailing(df, as_of, days).select("product_id", "dt", kind.alias("kind"), user.alias("user"), amount.cast(MONEY).alias("amount"),
                         stay_s.cast(MONEY).alias("stay"), bounce.cast("bigint").alias("bounce"))

    user = F.col("user_id")
    facts = reduce(DataFrame.unionByName, [
        rows(visit, F.lit("visit"), user),
        rows(micro, F.lit("micro"), user),
        rows(stay.where(F.col("page_type") == "PRODUCT_DETAIL"), F.lit("stay"), stay_s=F.col("stay_seconds"), bounce=F.col("is_bounce")),
        rows(cart, F.when(F.col("action_type") == "ADD", "cart").otherwise("uncart"), user),
        rows(trade, F.col("kind"), user, F.col("amount")),
    ])
    per_user = facts.groupBy("product_id", "dt", "kind", "user").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"), F.sum("stay").alias("stay"), F.sum("bounce").alias("bounce")
    )
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    users = lambda kind: F.count(of(kind, "user"))
    total = lambda kind, c: F.coalesce(F.sum(of(kind, c)), F.lit(0))
    out = per_user.groupBy("product_id", "dt").agg(
        users("visit").alias("visit_cnt"), users("micro").alias("micro_visit_cnt"), total("visit", "n").alias("browse_cnt"),
        total("stay", "n").alias("_stays"), total("stay", "stay").alias("_stay"), total("stay", "bounce").alias("_bounces"),
        users("cart").alias("cart_add_cnt"), users("order").alias("order_user_cnt"), total("order", "n").alias("order_cnt"),
        total("order", "amount").alias("order_amount"), users("pay").alias("pay_user_cnt"), total("pay", "n").alias("pay_cnt"),
        total("pay", "amount").alias("pay_amount"), F.count(F.when(F.col("kind").isin("visit", "pay", "cart", "uncart"), 1)).alias("_open"),
    )
    out = out.withColumn("avg_stay_duration", F.coalesce(_fixed(X.ratio("_stay", "_stays", 4)), F.lit(0).cast(RATE)))
    out = out.withColumn("bounce_rate", F.coalesce(_fixed(X.percent("_bounces", "_stays", 4)), F.lit(0).cast(RATE)))
    activity = sum((F.col(c) for c in ("micro_visit_cnt", "avg_stay_duration", "cart_add_cnt", "order_user_cnt", "pay_user_cnt")), F.col("visit_cnt"))
    out = store(out, "product-days")  # read twice below
    open_days = out.where("_open > 0").agg(F.collect_set("dt")).scalar()
    return (
        out.where(activity > 0)
        .where(F.array_contains(open_days, F.col("dt")))
        .drop("_stays", "_stay", "_bounces", "_open")
        .join(known, "product_id", "left_semi")
    )


SUMMED = ["visit_cnt", "micro_visit_cnt", "browse_cnt", "cart_add_cnt", "order_user_cnt", "order_cnt", "order_amount",
          "pay_user_cnt", "pay_cnt", "pay_amount"]


def core_metrics(product_day: DataFrame, as_of: str, days: int) -> DataFrame:
    """Trailing totals per product with averages of stay and bounce and the pay conversion."""
    out = trailing(product_day, as_of, days).groupBy("product_id").agg(
        *[F.sum(c).alias(c) for c in SUMMED],
        *[X.mean(F.sum(c), F.count(c)).alias(c) for c in ("avg_stay_duration", "bounce_rate")],
    )
    return (
        out.withColumn("dt", F.lit(as_of))
        .withColumn("period_type", F.lit(f"{days}DAYS"))
        .withColumn("pay_conversion", X.percent("pay_user_cnt", "visit_cnt"))
    )


def core_metrics_daily(product_day: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return (
        trailing(product_day, as_of, days)
        .withColumn("period_type", F.lit("DAILY"))
        .withColumn("pay_conversion", X.percent("pay_user_cnt", "visit_cnt"))
    )


# ---- traffic -------------------------------------------------------------------


def traffic_days(visit: DataFrame, source: DataFrame, pay: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Visitors and payers per product, day and traffic source of the session."""
    sessions = trailing(source, as_of, days).select("session_id", "dt", "source_type").distinct()
    payers = trailing(pay, as_of, days).select("product_id", "dt", "user_id").distinct().withColumn("paid", F.lit(1))
    seen = trailing(visit, as_of, days).select("product_id", "dt", "user_id", "session_id").distinct()
    sourced = (
        seen.join(sessions, ["session_id", "dt"], "left")
        .withColumn("source_type", F.coalesce("source_type", F.lit("UNKNOWN")))
        .select("product_id", "dt", "user_id", "source_type")
        .distinct()
    )
    return sourced.join(payers, ["product_id", "dt", "user_id"], "left").groupBy("product_id", "dt", "source_type").agg(
        F.count("user_id").alias("visit_cnt"), F.count("paid").alias("pay_user_cnt")
    )


def traffic_trailing(traffic_day: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    out = trailing(traffic_day, as_of, days).groupBy("product_id", "source_type").agg(
        F.sum("visit_cnt").alias("visit_cnt"), F.sum("pay_user_cnt").alias("pay_user_cnt")
    )
    return (
        out.withColumn("dt", F.lit(as_of))
        .withColumn("period_type", F.lit(f"{days}DAYS"))
        .withColumn("pay_conversion", X.percent("pay_user_cnt", "visit_cnt"))
    )


def source_dim(source: DataFrame) -> DataFrame:
    """The traffic sources that occur, named by themselves."""
    return source.select("source_type").where(F.col("source_type").isNotNull()).distinct().withColumn("source_name", F.col("source_type"))


def traffic_sources(visit: DataFrame, source: DataFrame, pay: DataFrame) -> DataFrame:
    """Every visited product and day with each source that occurs, figures 0 where none.

    The sources are grouped into one array, which is exploded per row; sides are made
    distinct before they meet, so a busy user brings a row per source and product.
    """
    known = source_dim(source).agg(F.sort_array(F.collect_set("source_type"))).scalar()
    skeleton = visit.select("dt", "product_id").distinct().withColumn("source_type", F.explode(known))
    came = source.select("user_id", "dt", "source_type").distinct()
    saw = visit.select("user_id", "dt", "product_id").distinct()
    paid = pay.select("user_id", "dt", "product_id").distinct().withColumn("paid", F.lit(1))
    stats = (
        saw.join(paid, ["user_id", "dt", "product_id"], "left")
        .join(came, ["user_id", "dt"])
        .groupBy("dt", "product_id", "source_type")
        .agg(F.count(F.lit(1)).alias("uv_count"), F.count("paid").alias("pay_user_count"))
    )
    joined = skeleton.join(stats, ["dt", "product_id", "source_type"], "left")
    return joined.select("dt", "product_id", "source_type", F.col("source_type").alias("source_name"),
                         X.zero("uv_count").alias("uv_count"), X.zero("pay_user_count").alias("pay_user_count"))


# ---- search --------------------------------------------------------------------


def search_days(search: DataFrame, pay: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Searchers, clicks and the day's payers per clicked product and keyword."""
    clicked = trailing(search, as_of, days).where(F.col("clicked_product_id").isNotNull()).withColumnRenamed("clicked_product_id", "product_id")
    by_user = clicked.groupBy("product_id", "dt", "search_keyword", "user_id").agg(F.count("log_id").alias("n"))
    words = by_user.groupBy("product_id", "dt", "search_keyword").agg(
        F.count("user_id").alias("visit_cnt"), F.sum("n").alias("click_cnt")
    )
    payers = trailing(pay, as_of, days).select("product_id", "dt", "user_id").distinct().groupBy("product_id", "dt").agg(F.count("user_id").alias("pay_user_cnt"))
    return words.join(payers, ["product_id", "dt"], "left").withColumn("pay_user_cnt", X.zero("pay_user_cnt"))


def search_trailing(search_day: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    out = trailing(search_day, as_of, days).groupBy("product_id", "search_keyword").agg(
        *[F.sum(c).alias(c) for c in ("visit_cnt", "click_cnt", "pay_user_cnt")]
    )
    return out.withColumn("dt", F.lit(as_of)).withColumn("period_type", F.lit(f"{days}DAYS"))


def search_click_rate(search: DataFrame) -> DataFrame:
    out = search.groupBy("dt", F.col("clicked_product_id").alias("product_id"), "search_keyword").agg(
        F.count(F.lit(1)).alias("search_count"), F.count("clicked_product_id").alias("click_count")
    )
    return out.withColumn("click_rate", X.ratio("click_count", "search_count", 4))


# ---- sales ---------------------------------------------------------------------


def sku_days(pay: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return trailing(pay, as_of, days).groupBy("product_id", "sku_id", "dt").agg(
        F.count("item_id").alias("pay_cnt"), F.sum("amount").alias("pay_amount")
    )


def sku_sales(pay: DataFrame) -> DataFrame:
    return pay.groupBy("dt", "product_id", "sku_id").agg(F.sum("quantity").alias("sale_qty"), F.sum("amount").alias("sale_amount"))


def goods_sales(pay: DataFrame, visit: DataFrame, product: DataFrame) -> DataFrame:
    """Quantity, amount, payers, visitors and pay rate per product and day."""
    by_user = pay.groupBy("dt", "product_id", "user_id").agg(F.sum("quantity").alias("q"), F.sum("amount").alias("a"))
    sold = by_user.groupBy("dt", "product_id").agg(
        F.sum("q").alias("sale_qty"), F.sum("a").alias("sale_amount"), F.count("user_id").alias("pay_user_count")
    )
    uv = visit.select("dt", "product_id", "user_id").distinct().groupBy("dt", "product_id").agg(F.count("user_id").alias("uv_count"))
    out = sold.join(uv, ["dt", "product_id"], "left").join(product, "product_id")
    return out.withColumn("pay_rate", X.ratio("pay_user_count", "uv_count", 4))


def latest_stock(inventory: DataFrame) -> DataFrame:
    return latest(inventory, ["sku_id"], ["snapshot_time"]).select("sku_id", "inventory_qty")


def sku_stock(sku_day: DataFrame, inventory: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Trailing sales per SKU with the newest stock and the days it lasts."""
    sold = trailing(sku_day, as_of, days).groupBy("product_id", "sku_id").agg(
        F.sum("pay_cnt").alias("pay_cnt"), F.sum("pay_amount").alias("pay_amount"), F.count(F.lit(1)).alias("_days")
    )
    out = sold.join(latest_stock(inventory), "sku_id", "left").withColumn("inventory_qty", X.zero("inventory_qty"))
    per_day = X.ratio("pay_cnt", "_days")
    return (
        out.withColumn("stock_days", F.try_divide(F.col("inventory_qty").cast("double"), per_day) * days)
        .withColumn("dt", F.lit(as_of))
        .withColumn("period_type", F.lit(f"{days}DAYS"))
        .drop("_days")
    )


# ---- price force -----------------------------------------------------------------


def latest_prices(change: DataFrame) -> DataFrame:
    """Prices set on the last change day of each product; all of them when there are several."""
    by_day = change.groupBy("product_id", "dt").agg(F.collect_list(F.struct("new_price")).alias("prices"))
    return by_day.groupBy("product_id").agg(F.max_by("prices", "dt").alias("prices")).select("product_id", F.inline("prices"))


def current_prices(change: DataFrame, product: DataFrame) -> DataFrame:
    return latest_prices(change).join(product.select("product_id", "third_cat_id"), "product_id")


def price_percentiles(current: DataFrame, width: float = 10.0) -> DataFrame:
    """Share of the category's products priced at or below each product."""
    return cumulative_share(current, ["third_cat_id"], "new_price", width, "price_rank")


def priced_products(change: DataFrame, product: DataFrame) -> DataFrame:
    """One row per product: its current price, the market price of its category, and its price level (lowest without a price)."""
    current = current_prices(change, product)
    own = price_percentiles(current).groupBy("product_id").agg(F.max("price_rank").alias("price_rank"), F.max("new_price").alias("_price"))
    market = current.groupBy("third_cat_id").agg(X.ratio(F.sum("new_price"), F.count("new_price"), 2).cast(MONEY).alias("_market"))
    out = product.select("product_id", "third_cat_id").join(own, "product_id", "left").join(market, "third_cat_id", "left")
    return out.select("product_id", X.price_level("price_rank").alias("price_force_level"), X.zero("_price").cast(MONEY).alias("current_price"),
                      X.zero("_market").cast(MONEY).alias("market_price"))


def price_force_days(pay: DataFrame, visit: DataFrame, priced: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Price level, market price and conversion per paid product and day; payments and visits are one union, grouped by user first."""
    none = F.lit(None).cast(MONEY)
    paid = trailing(pay, as_of, days).select("product_id", "dt", "user_id", F.lit(1).alias("_paid"), F.col("item_id").isNotNull().cast("int").alias("_line"), F.col("amount").cast(MONEY).alias("amount"))
    seen = trailing(visit, as_of, days).select("product_id", "dt", "user_id", F.lit(0).alias("_paid"), F.lit(0).alias("_line"), none.alias("amount"))
    users = paid.unionByName(seen).groupBy("product_id", "dt", "user_id").agg(
        F.max("_paid").alias("_paid"), F.max(F.when(F.col("_paid") == 0, 1)).alias("_saw"), F.sum("_line").alias("n"), F.sum("amount").alias("a"))
    known = F.col("user_id").isNotNull()
    out = users.groupBy("product_id", "dt").agg(
        F.sum("a").alias("pay_amount"), F.sum("n").alias("pay_cnt"), F.max("_paid").alias("_any"),
        F.count(F.when(known & (F.col("_paid") == 1), 1)).alias("_payers"), F.count(F.when(known, F.col("_saw"))).alias("_uv"))
    out = out.where("_any = 1").join(priced, "product_id", "left")
    zero = lambda name: F.coalesce(name, F.lit(0).cast(MONEY))
    return out.select(
        "product_id", "dt", F.coalesce("price_force_level", X.price_level(F.lit(None).cast("double"))).alias("price_force_level"),
        zero("current_price").alias("current_price"), zero("market_price").alias("market_price"),
        F.coalesce(X.percent("_payers", "_uv", 2).cast(MONEY), F.lit(0).cast(MONEY)).alias("pay_conversion"), "pay_amount", "pay_cnt",
    )


def price_warnings(price_day: DataFrame, product_day: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Trailing price force; warns when conversion is under 0.8 of the overall mean and under the product's week before."""
    figures = ["product_id", "price_force_level", "current_price", "market_price"]
    rows = trailing(price_day, as_of, days).groupBy(*figures).agg(
        X.mean(F.sum("pay_conversion"), F.count("pay_conversion")).alias("pay_conversion"),
        F.sum("pay_amount").alias("pay_amount"), F.sum("pay_cnt").alias("pay_cnt"),
    )
    rate = _fixed(X.ratio("pay_user_cnt", "visit_cnt", 4))
    daily = product_day.select("product_id", "dt", rate.alias("rate"))
    average = lambda: X.mean(F.sum("rate"), F.count("rate")) * 100
    overall = trailing(daily, as_of, days).agg(average().alias("overall")).scalar()
    before = trailing(daily, as_of, 2 * days, days).groupBy("product_id").agg(average().alias("_before"))
    out = rows.join(before, "product_id", "left")
    low = (F.col("pay_conversion") < overall * 0.8) & (F.col("pay_conversion") < F.coalesce("_before", F.lit(0.0)))
    return (
        out.withColumn("is_warning", F.when(low, 1).otherwise(0))
        .withColumn("warning_type", F.when(F.col("is_warning") == 1, "LOW_PRODUCT_FORCE"))
        .withColumn("dt", F.lit(as_of))
        .withColumn("period_type", F.lit(f"{days}DAYS"))
        .drop("_before")
    )
