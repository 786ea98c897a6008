import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewake.llm.toxicity import features, fit, held_out, score, train

SF = "/root/testdata/sf0.1"


def test_features_are_words_and_beginnings():
    assert features("Abcdefg ab! 12 ab") == {"abcdefg", "ab", "abc-", "abcd-", "abcde-", "abcdef-"}
    assert features(None) == features("") == set()


def test_fit_learns_from_positive_and_unlabelled_texts():
    rng = random.Random(1)
    clean = lambda: {f"w{rng.randrange(300)}" for _ in range(40)}
    toxic = lambda: clean() | {rng.choice(["bad", "worse", "worst"])}
    weights = fit([toxic() for _ in range(150)], [toxic() if k % 10 == 0 else clean() for k in range(1500)], 0.1)
    value = lambda row: sum(weights.get(f, 0) for f in (*row, ""))
    assert np.mean([value(toxic()) > value(clean()) for _ in range(400)]) > 0.98
    assert fit([], [{"a"}], 0.25) == pytest.approx({"": np.log(1 / 3)})


def test_held_out_accuracy_and_labels_that_must_not_matter(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/labels.parquet")
    models = train(docs, labels)
    got = score(docs, models).join(labels, "doc_id").where(held_out("doc_id")).select("score", "toxic").toPandas()
    toxic, clean = (got.loc[got["toxic"] == k, "score"].to_numpy() for k in (1, 0))
    assert (toxic[:, None] > clean[None, :]).mean() > 0.97
    assert (toxic >= 0.3).mean() > 0.85 and (clean >= 0.3).mean() < 0.05
    turned = labels.withColumn("toxic", F.when(held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert train(docs, turned) == models


def test_edges(frame):
    docs = frame([(k, "some words here" if k % 2 else "foul words here", 0.5) for k in range(60)] + [(None, "foul", 0.1), (61, None, 0.2), (62, "", 0.3)] * 2,
                 "doc_id long, text string, score double")
    labels = frame([(k, 1 - k % 2) for k in range(60)] + [(None, 1), (3, None), (5, 7), (2, 0)], "doc_id long, toxic int")
    got = score(docs, train(docs, labels))
    assert got.columns == ["doc_id", "text", "score"] and got.count() == 66
    rows = got.collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    empty = train(docs.limit(0), labels.limit(0))
    assert score(docs, empty).select("score").distinct().count() == 1
    assert score(docs.limit(0), empty).collect() == []
