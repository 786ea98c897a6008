import collections

import numpy as np
import pytest

from tradewake.llm import lm_score
from tradewake.llm.words import WordHashes, words


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels.where("quality = 1").select("doc_id")


def test_probabilities_sum_to_one_and_counts_are_exact(spark, tables):
    docs, good = tables
    share = 1e-4
    model = lm_score.train(docs, good, least_share=share)
    uni, bi, known = collections.Counter(), collections.Counter(), WordHashes()
    for r in docs.collect():
        w = words(r["text"])
        uni.update(w)
        bi.update(zip([None, *w], w))
    least = share * sum(uni.values())
    assert set(model.word.tolist()) == {known[w] for w, n in uni.items() if n >= least and n > 1}
    assert len(model.key) == sum(n >= least and n > 1 for n in bi.values())
    for before in (lm_score.START, *model.word[:40], np.uint64(5)):
        row = len(model.back) - 1 if before == lm_score.START else model.place(np.array([before]))[0]
        out = model.back[row] + model.uni
        voc = np.append(model.word, np.uint64(99))
        key = lm_score.mixed(lm_score.mixed(np.full(len(voc), before, np.uint64)) * lm_score._PAIR + voc)
        k = np.minimum(np.searchsorted(model.key, key), len(model.key) - 1)
        out[model.key[k] == key] = model.bi[k[model.key[k] == key]]
        assert np.exp(out).sum(0) == pytest.approx([1, 1])


def test_scores_tell_good_documents(spark, tables):
    docs, good = tables
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = lm_score.score(docs, lm_score.train(docs, good)).join(labels.withColumnRenamed("doc_id", "id"), "id").toPandas()
    low, high = (got.loc[got["quality"] == q, "difference"].to_numpy() for q in (1, 0))
    assert (low[:, None] < high[None, :]).mean() > 0.8


def test_edges(frame):
    docs = frame([(1, "a b a b a b", 0), (1, "a b a b a b", 0), (2, "c d", 1), (None, "a c", 2), (3, None, 3), (4, " ", 4)], "doc_id long, text string, target int")
    target = frame([(1,), (1,), (None,), (99,)], "doc_id long")
    got = lm_score.score(docs, lm_score.train(docs, target, least_share=0.01)).collect()
    assert len(got) == 6 and sum(r["n_tokens"] for r in got) == 16
    assert all((r["difference"] is None) == (r["n_tokens"] == 0) for r in got)
    value = {r["id"]: r["difference"] for r in got}
    assert value[1] < 0 < value[2]
    none = lm_score.train(docs.limit(0), target)
    assert all(not r["n_tokens"] or r["difference"] == 0 for r in lm_score.score(docs, none).collect())
    assert lm_score.score(docs.limit(0), none).collect() == []
