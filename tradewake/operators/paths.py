"""Page paths: next page, transitions, page-type shares, channels, addresses."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.cdc import latest
from tradewake.operators.positions import following

NAMED_SOURCES = (*X.STORE_PAGES, X.DETAIL_PAGE)
UNKNOWN_CHANNEL = "未知渠道"
SLOT = "10 minutes"


def next_pages(log: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Each page record with the page the same device opens next; of the days from ``first`` to ``last``, if given.

    Days before the range are not read. Of what follows it, every device brings only its next record.
    """
    slot = F.window("ts", SLOT)["start"]
    rows = log.select("mid", "ts", "event_id", "page_id", "dt")
    at = lambda day, after=0: F.date_add(F.lit(day).cast("date"), after).cast(log.schema["ts"].dataType)
    if first is not None:
        rows = rows.where(F.col("ts") >= at(first))
    if last is not None:
        later = rows.where(F.col("ts") >= at(last, 1)).groupBy("mid").agg(F.min(F.struct("ts", "event_id", "page_id", "dt")).alias("_next"))
        rows = rows.where(F.col("ts") < at(last, 1)).unionByName(later.select("mid", "_next.*"))
    found = following(rows, ["mid"], ["ts", "event_id"], "page_id", "next_page_id", slot)
    return found if last is None else found.where(F.col("ts") < at(last, 1))


def before_payment(log: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Visits per day and page group, and how many led straight to payment."""
    group = X.page_group("page_id")
    rows = next_pages(log, first, last).withColumn("page_group", group).where(F.col("page_group").isNotNull())
    return rows.groupBy("dt", "page_group").agg(
        F.count(F.lit(1)).alias("views"),
        F.coalesce(F.sum(F.when(F.col("next_page_id") == "payment", 1)), F.lit(0)).alias("payments"),
    )


def shares_by_period(log: DataFrame, as_of: str, periods: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """Page-group shares and payment conversion over the last n days, as percent text.

    Rows are counted per day first; periods are exploded over those few rows.
    """
    day, ref = F.to_date("dt"), F.lit(as_of).cast("date")
    start = (date.fromisoformat(as_of) - timedelta(days=max(periods) - 1)).isoformat()
    spread = before_payment(log, start, as_of).withColumn("recent_days", F.explode(F.array(*[F.lit(n) for n in periods])))
    inside = spread.where((day > F.date_sub(ref, F.col("recent_days"))) & (day <= ref))
    per = lambda g, c: F.coalesce(F.sum(F.when(F.col("page_group") == g, F.col(c))), F.lit(0))
    names = {"trade": "trade", "good_detail": "detail", "other": "other"}
    sums = inside.groupBy("recent_days").agg(
        *[per(g, "views").alias(f"{n}_count") for g, n in names.items()],
        *[per(g, "payments").alias(f"{n}_payment") for g, n in names.items()],
    )
    views = sum((F.col(f"{n}_count") for n in list(names.values())[1:]), F.col("trade_count"))
    payments = sum((F.col(f"{n}_payment") for n in list(names.values())[1:]), F.col("trade_payment"))
    out = sums
    for n in names.values():
        out = (
            out.withColumn(f"{n}_ratio", X.percent_text(f"{n}_count", views))
            .withColumn(f"{n}_payment_ratio", X.percent_text(f"{n}_payment", payments))
            .withColumn(f"{n}_conversion", X.percent_text(f"{n}_payment", f"{n}_count"))
        )
    return out


def latest_page_types(log: DataFrame) -> DataFrame:
    """The item type last seen on each page, with the page's class."""
    newest = latest(log.select("page_id", "ts", "event_id", "item_type"), ["page_id"], ["ts", "event_id"])
    return newest.select("page_id", F.col("item_type").alias("page_item_type"), X.page_type("page_id").alias("page_type"))


def page_type_ranks(log: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Views, visitors and mean stay per page class from day ``first`` to day ``last``, ranked by visitors.

    The class depends on the page alone. The ranking window has no partition: its input is one row per page class.
    """
    for day, inside in ((first, F.col("dt") >= first), (last, F.col("dt") <= last)):
        log = log if day is None else log.where(inside)
    rows = log.where(F.col("page_id").isNotNull()).withColumn("page_type", X.page_type("page_id"))
    by_user = rows.groupBy("page_type", "mid").agg(F.count(F.lit(1)).alias("n"), F.sum("during_time").alias("t"), F.count("during_time").alias("tn"))
    out = by_user.groupBy("page_type").agg(
        F.sum("n").alias("pv"), F.count("mid").alias("uv"), X.ratio(F.sum("t"), F.sum("tn") * 1000, 2).alias("avg_stay_duration_seconds")
    )
    return out.withColumn("rank", F.row_number().over(W.orderBy(F.col("uv").desc(), "page_type")))


def path_shares(log: DataFrame, payment: DataFrame, other_sources_only: bool = False) -> DataFrame:
    """Distinct visitors and payment totals per day and page transition, with shares of the day, most visitors first.

    A visitor's payments of the day count on every transition record; records
    are counted per visitor before the payments are joined.
    """
    hops = log.where(F.col("last_page_id").isNotNull())
    if other_sources_only:
        hops = hops.where(~F.col("last_page_id").isin(*NAMED_SOURCES))
    hops = hops.groupBy("dt", "uid", "mid", F.col("last_page_id").alias("source_page"), F.col("page_id").alias("target_page")).agg(
        F.count(F.lit(1)).alias("n")
    )
    paid = payment.groupBy("uid", "dt").agg(F.sum("amount").alias("paid"))
    keys = ["dt", "source_page", "target_page"]
    by_visitor = hops.join(paid, ["uid", "dt"], "left").groupBy(*keys, "mid").agg(F.sum(X.zero("paid") * F.col("n")).alias("paid"))
    stats = by_visitor.groupBy(*keys).agg(F.count("mid").alias("visitor_count"), F.sum("paid").alias("total_payment_amount"))
    totals = stats.groupBy("dt").agg(F.sum("visitor_count").alias("_v"), F.sum("total_payment_amount").alias("_p"))
    return (
        stats.join(totals, "dt")
        .withColumn("visitor_percentage", X.percent("visitor_count", "_v", 2))
        .withColumn("payment_percentage", X.percent("total_payment_amount", "_p", 2))
        .drop("_v", "_p")
        .orderBy(F.col("visitor_count").desc(), *keys)
    )


def channel_bounces(log: DataFrame, n: int = 20) -> DataFrame:
    """Visitors and landings per hundred visitors of each channel; the n highest."""
    by_user = log.groupBy("ch", "uid").agg(F.sum(F.when(F.col("last_page_id").isNull(), 1).otherwise(0)).alias("landings"))
    out = by_user.groupBy("ch").agg(F.count("uid").alias("uv"), F.sum("landings").alias("l"))
    out = out.select(F.coalesce("ch", F.lit(UNKNOWN_CHANNEL)).alias("ch"), "uv", X.percent("l", "uv", 2).alias("bounce_rate"))
    return out.orderBy(F.col("bounce_rate").desc(), "ch").limit(n)


def url_ranks(log: DataFrame) -> DataFrame:
    """Views, visitors and mean stay per page address, most views first."""
    rows = log.where(F.col("page_id").isNotNull()).withColumn("url", X.page_url("page_id"))
    by_user = rows.groupBy("url", "mid").agg(F.count(F.lit(1)).alias("n"), F.sum("during_time").alias("t"), F.count("during_time").alias("tn"))
    out = by_user.groupBy("url").agg(
        F.sum("n").alias("pv"), F.count("mid").alias("uv"), X.ratio(F.sum("t"), F.sum("tn") * 1000, 2).alias("during_time")
    )
    return out.orderBy(F.col("pv").desc(), "url")
