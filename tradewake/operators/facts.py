"""Detail facts: star joins, header/line joins, attribution of payments to activities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewake.functions import exprs as X


def labelled(fact: DataFrame, key: str, **labels: Column) -> DataFrame:
    """Fact INNER JOIN a dimension of fixed values whose fields follow from its key: the fields as expressions, rows without a key leave.

    The fact stays where it is; a join on a key of few values would send it to as many tasks.
    """
    return fact.where(F.col(key).isNotNull()).withColumns(labels)


def star(fact: DataFrame, dims: list[tuple[DataFrame, str]]) -> DataFrame:
    """Fact INNER JOIN each (dim, key)."""
    for dim, key in dims:
        fact = fact.join(dim, key)
    return fact


def header_line(header: DataFrame, line: DataFrame) -> DataFrame:
    """Paid order lines with their header, and the payment day."""
    paid = header.where((F.col("status") == "PAID") & F.col("pay_time").isNotNull())
    return line.join(paid, "order_id").withColumn("dt", X.day_text("pay_time"))


def with_activity(payment: DataFrame) -> DataFrame:
    flags = ("is_group_buy", "is_presale", "presale_stage")
    return payment.withColumn("activity_id", X.activity_id(*flags)).withColumn("activity_name", X.activity_name(*flags))


def payment_activity(payment: DataFrame, item: DataFrame, order_line: DataFrame, activity: DataFrame) -> DataFrame:
    """Payments with their method, ordered quantity (1 when unknown) and the activity behind the flags.

    ``activity`` should be a stored table: Spark then knows that it is small, and sends it to the payments.
    """
    quantity = order_line.groupBy("order_id", "item_id").agg(F.sum("quantity").alias("quantity"))
    keyed = payment.withColumn("activity_id", X.activity_id("is_group_buy", "is_presale", "presale_stage"))
    return (
        labelled(keyed, "payment_method", method_name=X.method_name("payment_method"))
        .join(item, "item_id").join(quantity, ["order_id", "item_id"], "left").join(activity, "activity_id", "left")
        .withColumn("quantity", F.coalesce("quantity", F.lit(1)))
    )


def payment_day(callback: Column | str) -> Column:
    """Day of the payment callback; open payments go to one fixed partition."""
    return F.coalesce(X.day_text(callback), F.lit("9999-99-99"))
