"""Product diagnosis: five scores, total, grades, ranks, overview."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X
from tradewake.operators.positions import numbered, ranked

KEYS = ["product_id", "date_key"]
SCORE = "decimal(5,2)"

# Weight of each input in its score, and of each score in the total.
TRAFFIC = {"total_uv": "0.00003", "hand_search_uv": "0.00002", "group_buy_uv": "0.00001", "direct_car_uv": "0.00001"}
CONVERSION = {"pay_conversion_rate": "12", "cart_conversion_rate": "9", "uv_value": "0.06", "collect_conversion_rate": "3"}
ENGAGEMENT = {"content_guide_uv": "0.03", "content_collect_rate": "20", "content_cart_rate": "20",
              "content_pay_amount": "0.0002", "content_pay_buyers": "0.2"}
ACQUISITION = {"new_buyer_ratio": "5", "new_buyer_amount_ratio": "5", "refund_rate": "-3"}
SERVICE = {"pic_review_count": "0.06", "positive_review_count": "0.06"}
TOTAL = {"traffic_score": "0.35", "conversion_score": "0.30", "engagement_score": "0.10", "acquisition_score": "0.10", "service_score": "0.15"}
SCORES = list(TOTAL)


def weighted(weights: dict[str, str]) -> Column:
    """Weighted sum in decimals, so that scores on a rounding or grade border come out exactly."""
    terms = [F.col(c).cast("decimal(18,4)") * F.lit(w).cast("decimal(7,5)") for c, w in weights.items()]
    return reduce(lambda a, b: a + b, terms)


def _score(df: DataFrame, name: str, value: Column) -> DataFrame:
    return df.withColumn(name, F.round(X.capped(value), 2).cast(SCORE))


def traffic_score(df: DataFrame) -> DataFrame:
    return _score(df, "traffic_score", weighted(TRAFFIC) * 100)


def conversion_score(df: DataFrame) -> DataFrame:
    return _score(df, "conversion_score", weighted(CONVERSION))


def engagement_score(df: DataFrame) -> DataFrame:
    return _score(df, "engagement_score", weighted(ENGAGEMENT))


def acquisition_score(df: DataFrame) -> DataFrame:
    return _score(df, "acquisition_score", weighted(ACQUISITION))


def service_score(df: DataFrame) -> DataFrame:
    return _score(df, "service_score", weighted(SERVICE))


def graded(scores: DataFrame) -> DataFrame:
    """Total and grade beside the five scores of a row; the grade is taken from the uncapped sum."""
    total = weighted(TOTAL)
    return scores.withColumn("grade", X.grade(total)).withColumn("total_score", F.round(X.capped(total), 2).cast(SCORE))


def all_scores(inputs: DataFrame) -> DataFrame:
    """The five scores, total and grade of rows that hold all inputs: columns of one row, no join."""
    scored = service_score(acquisition_score(engagement_score(conversion_score(traffic_score(inputs)))))
    return graded(scored)


def evaluation(traffic: DataFrame, conversion: DataFrame, engagement: DataFrame, acquisition: DataFrame, service: DataFrame) -> DataFrame:
    """The scores of five tables of their own side by side, with total and grade.

    All joins share the keys, so each side is shuffled once. Where the inputs are one table, ``all_scores`` needs no join.
    """
    sides = [d.select(*KEYS, s) for d, s in zip((traffic, conversion, engagement, acquisition, service), SCORES)]
    return graded(reduce(lambda a, b: a.join(b, KEYS), sides))


def _avg(c: str) -> Column:
    return X.mean(F.sum(c), F.count(c))


def with_market(evaluated: DataFrame, product: DataFrame) -> DataFrame:
    """Adds names and the mean total of the category on that day."""
    named = evaluated.join(product, "product_id")
    market = named.groupBy("date_key", "category_name").agg(X.ratio(F.sum("total_score"), F.count("total_score"), 2).cast(SCORE).alias("market_avg_score"))
    return named.join(market, ["date_key", "category_name"])


def diagnosis(evaluated: DataFrame) -> DataFrame:
    """Gaps to the market and the main inputs beside the scores; ``evaluated`` holds the inputs and the market score."""
    market = F.col("market_avg_score")
    return evaluated.select(
        *KEYS, *SCORES, "total_score", "grade", "product_name", "category_name", "brand_name", "market_avg_score", F.col("total_uv").alias("uv_count"),
        "pay_conversion_rate", "cart_conversion_rate", "new_buyer_ratio", "refund_rate", "pic_review_count",
        (F.col("traffic_score") - market).alias("traffic_score_diff"), (F.col("conversion_score") - market).alias("conversion_score_diff"),
    )


def grade_ranks(diagnosed: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Position of each product inside its grade and day, best first, ties by product; from day ``first`` to ``last``."""
    if first is not None:
        diagnosed = diagnosed.where(F.col("date_key") >= F.lit(first).cast("date"))
    if last is not None:
        diagnosed = diagnosed.where(F.col("date_key") <= F.lit(last).cast("date"))
    return numbered(diagnosed, ["grade", "date_key"], "total_score", "product_id", 10_000, "rk")


def grade_top(diagnosed: DataFrame) -> DataFrame:
    """Best product per grade and day: the maximum, no ranking needed."""
    best = F.max(F.struct("total_score", (-F.col("product_id")).alias("neg"), "product_name")).alias("b")
    return diagnosed.groupBy("grade", "date_key").agg(best).select(
        "grade", "date_key", (-F.col("b.neg")).alias("top_product_id"), F.col("b.product_name").alias("top_product_name"),
        F.col("b.total_score").alias("top_score"),
    )


def grade_days(diagnosed: DataFrame) -> DataFrame:
    """Mean scores per grade and day with the best product."""
    keys = ["grade", "date_key"]
    averages = diagnosed.groupBy(*keys).agg(
        *[_avg(s).alias(f"avg_{s}") for s in SCORES], _avg("total_score").alias("avg_total_score"),
        F.countDistinct("product_id").alias("product_count"), _avg("market_avg_score").alias("market_avg_score"),
    )
    out = averages.withColumn("avg_score_diff", F.col("avg_total_score") - F.col("market_avg_score"))
    return out.join(grade_top(diagnosed), keys)


def competitors(diagnosed: DataFrame) -> DataFrame:
    """Rank of each score inside category and day; ties share the best rank.

    A product has a row for each measure; one histogram of scores serves all measures. The product's own columns travel
    with its first row, so ranks meet them again in one grouping.
    """
    own = ["product_name", "category_name", "grade", *SCORES, "total_score", "market_avg_score"]
    row = lambda s: F.struct(
        F.lit(s).alias("measure"), F.col(s).alias("score"), F.when(F.lit(s == SCORES[0]), F.struct(*[c for c in own if c != "category_name"])).alias("own"))
    long = diagnosed.select(*KEYS, "category_name", F.inline(F.array(*map(row, SCORES))))
    ranks = ranked(long, ["date_key", "category_name", "measure"], "score").groupBy(*KEYS, "category_name").agg(
        F.max("own").alias("own"), *[F.max(F.when(F.col("measure") == s, F.col("rank"))).alias(s.replace("_score", "_rank")) for s in SCORES]
    )
    places = [s.replace("_score", "_rank") for s in SCORES]
    out = ranks.select(*KEYS, *[F.col(c) if c == "category_name" else F.col(f"own.{c}") for c in own], *places)
    return out.withColumn("total_score_diff", F.col("total_score") - F.col("market_avg_score"))


OVERVIEW = ["date_key", "analysis_dimension", "grade", "product_count", "product_ratio", "total_amount", "avg_price", "total_sales",
            "total_uv", "uv_sales_ratio", "avg_total_score"]


def overview(diagnosed: DataFrame, order_item: DataFrame) -> DataFrame:
    """Score, price and visitor views stacked in one layout.

    Order lines are summed per product before they meet the product days.
    """
    products = F.countDistinct("product_id").alias("product_count")
    by_grade = diagnosed.groupBy("date_key", "grade").agg(
        products, F.sum("uv_count").alias("total_uv"), _avg("total_score").alias("avg_total_score")
    )
    per_day = by_grade.groupBy("date_key").agg(F.sum("product_count").alias("_all"))
    score = by_grade.join(per_day, "date_key").withColumn("product_ratio", X.percent("product_count", "_all", 2))
    sales = order_item.groupBy("product_id").agg(
        F.sum("amount").alias("amount"), F.sum("quantity").alias("quantity"), F.sum("price").alias("price"), F.count("price").alias("prices")
    )
    sold = diagnosed.select(*KEYS, "uv_count").join(sales, "product_id")
    days = sold.groupBy("date_key").agg(
        products, F.sum("amount").alias("total_amount"), F.sum("quantity").alias("total_sales"), F.sum("uv_count").alias("total_uv"),
        X.ratio(F.sum("price"), F.sum("prices")).alias("avg_price"),
    )
    price = days.drop("total_uv")
    visitor = days.drop("total_amount", "avg_price").withColumn("uv_sales_ratio", X.ratio("total_sales", "total_uv", 4))

    def laid_out(df, dimension):
        have = df.withColumn("analysis_dimension", F.lit(dimension))
        if "grade" not in df.columns:
            have = have.withColumn("grade", F.lit(""))
        return have.select(*[F.col(c) if c in have.columns else F.lit(0).alias(c) for c in OVERVIEW])

    parts = [laid_out(score, "score"), laid_out(price, "price"), laid_out(visitor, "visitor")]
    kinds = {"total_amount": "decimal(38,2)", "avg_price": "double", "uv_sales_ratio": "double", "product_ratio": "double",
             "avg_total_score": "double", "total_sales": "bigint", "total_uv": "bigint", "product_count": "bigint"}
    typed = [p.select(*[F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in OVERVIEW]) for p in parts]
    return reduce(DataFrame.unionByName, typed)
