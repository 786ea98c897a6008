"""Bucketed ranks, neighbours and running values against plain windows, with one hot group."""

import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradewake.operators import positions as P


@pytest.fixture
def skewed(frame):
    rng = random.Random(7)
    data = [(1 if rng.random() < 0.5 else rng.randint(2, 6), rng.randint(0, 40), i, rng.choice(["a", "b", None])) for i in range(400)]
    return frame(data, "g int, v int, id int, t string")


def test_ranked(skewed, rows):
    want = skewed.withColumn("rank", F.rank().over(W.partitionBy("g").orderBy(F.col("v").desc())))
    assert rows(P.ranked(skewed, ["g"], "v", 7.0), "g", "id", "rank") == rows(want, "g", "id", "rank")
    assert rows(P.ranked(skewed, ["g"], "v"), "g", "id", "rank") == rows(want, "g", "id", "rank")


def test_cumulative_share(skewed, rows):
    want = skewed.withColumn("share", F.cume_dist().over(W.partitionBy("g").orderBy("v")))
    assert rows(P.cumulative_share(skewed, ["g"], "v", 7.0), "g", "id", "share") == rows(want, "g", "id", "share")


def test_numbered(skewed, rows):
    want = skewed.withColumn("rank", F.row_number().over(W.partitionBy("g").orderBy(F.col("v").desc(), "id")))
    assert rows(P.numbered(skewed, ["g"], "v", "id", 50), "g", "id", "rank") == rows(want, "g", "id", "rank")


def test_following(skewed, rows):
    want = skewed.withColumn("n", F.lead("t").over(W.partitionBy("g").orderBy("id")))
    assert rows(P.following(skewed, ["g"], ["id"], "t", "n", F.floor(F.col("id") / 9)), "id", "n") == rows(want, "id", "n")


def test_running_last(skewed, rows):
    want = skewed.withColumn("t", F.last("t", ignorenulls=True).over(W.partitionBy("g").orderBy("id").rowsBetween(W.unboundedPreceding, 0)))
    assert rows(P.running_last(skewed, ["g"], ["id"], ["t"], F.floor(F.col("id") / 9)), "id", "t") == rows(want, "id", "t")


def test_above_earlier(skewed, rows):
    best = F.max("v").over(W.partitionBy("g").orderBy("id").rowsBetween(W.unboundedPreceding, -1))
    want = skewed.withColumn("b", best).where("b is null or v > b")
    assert rows(P.above_earlier(skewed, ["g"], ["id"], "v", F.floor(F.col("id") / 9)), "id") == rows(want, "id")


def test_first_n(skewed, rows):
    got = P.first_n(skewed, ["g"], [F.col("v").desc(), F.col("id")], 2)
    want = skewed.withColumn("rn", F.row_number().over(W.partitionBy("g").orderBy(F.col("v").desc(), "id"))).where("rn <= 2")
    assert rows(got, "g", "id") == rows(want, "g", "id")
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


NULLS = [("a", 3, "x"), ("a", None, "y"), (None, 2, "z"), (None, None, "w"), ("a", 3, "v"), (None, 2, None)]


def test_no_row_is_lost_to_nulls(frame, rows):
    df = frame(NULLS, "g string, v int, id string")
    got = rows(P.ranked(df, ["g"], "v", 1.0))
    window = rows(df.withColumn("rank", F.rank().over(W.partitionBy("g").orderBy(F.col("v").desc_nulls_last()))))
    assert got == window and len(got) == 6
    share = rows(P.cumulative_share(df, ["g"], "v", 1.0))
    assert share == rows(df.withColumn("share", F.cume_dist().over(W.partitionBy("g").orderBy(F.col("v").asc_nulls_first()))))
    number = P.numbered(df.withColumn("t", F.length("id")), ["g"], "v", "t", 10)
    assert number.count() == 6


def test_neighbours_of_null_keys(frame, rows):
    df = frame([(None, 1, "a"), (None, 25, "b"), ("k", 2, "c"), ("k", 90, None), (None, 70, "d")], "k string, t int, v string")
    bucket = F.floor(F.col("t") / 10)
    assert rows(P.following(df, ["k"], ["t"], "v", "nxt", bucket)) == rows(df.withColumn("nxt", F.lead("v").over(W.partitionBy("k").orderBy("t"))))
    assert rows(P.running_last(df, ["k"], ["t"], ["v"], bucket)) == rows(
        df.withColumn("v", F.last("v", ignorenulls=True).over(W.partitionBy("k").orderBy("t"))))
    assert len(P.above_earlier(df, ["k"], ["t"], "t", bucket).collect()) == 5
