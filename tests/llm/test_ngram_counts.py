import collections
import math

import numpy as np
import pytest

from tradewake.llm import bloom, lm_score, ngram_counts
from tradewake.llm.words import words


def plain(train, target, discount=0.75):
    """text -> (target loss, background loss) from plain counters over all words and bigrams."""
    uni, bi = [collections.Counter(), collections.Counter()], [collections.Counter(), collections.Counter()]
    starts = [0, 0]
    for one, text in train:
        w = words(text)
        for m in range(1 + (one in target)):
            uni[m].update(w)
            bi[m].update(zip([None, *w], w))
            starts[m] += bool(w)
    size, after = len(uni[0]), [collections.defaultdict(list), collections.defaultdict(list)]
    for m in (0, 1):
        for (v, _), n in bi[m].items():
            after[m][v].append(n)

    def probability(m, v, w):
        low = (uni[m][w] + 1) / (uni[m].total() + size + 1)
        c = starts[m] if v is None else uni[m][v]
        if not c:
            return low
        return max(bi[m][v, w] - discount, 0) / c + (1 - sum(n - discount for n in after[m][v]) / c) * low

    def losses(text):
        w = words(text)
        return tuple(-sum(math.log(probability(m, *x)) for x in zip([None, *w], w)) / len(w) if w else None for m in (1, 0))

    return losses


def corpus(seed=3, n=300):
    draw = np.random.default_rng(seed)
    texts = [" ".join(f"W{min(x, 10**6)}" for x in draw.zipf(1.4, draw.integers(0, 60))) for _ in range(n)]
    ids = [None if k % 37 == 5 else k - k % 50 // 49 for k in range(n)]  # null and repeated ids
    return [*zip(ids, texts), (n, None), (n + 1, "  "), (n + 2, "the the the the"), (n + 3, "once " * 700)]


def check(got, want):
    assert got["n_tokens"] == len(words(want[1]))
    for name, x in zip(("target_loss", "background_loss"), want[0]):
        assert got[name] is None if x is None else got[name] == pytest.approx(x, rel=1e-9)


@pytest.mark.parametrize(("block", "parts"), [(500, 7), (1 << 21, None), (60, 1)])
def test_every_score_is_the_plain_cross_entropy(frame, block, parts):
    rows = corpus()
    docs = frame(rows, "doc_id long, text string").repartition(3)
    target = {k for k in range(0, 300, 3)}
    got = lm_score.score(docs, lm_score.train(docs, frame([(k,) for k in [*target, 0, None, 5000]], "doc_id long"), block=block, parts=parts)).collect()
    losses = plain(rows, target)
    order = lambda x: tuple((v is not None, v or 0) for v in x)
    want = sorted(((k, len(words(t)), *losses(t)) for k, t in rows), key=order)
    got = sorted(((r["id"], r["n_tokens"], r["target_loss"], r["background_loss"]) for r in got), key=order)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    # rows of an id and length by nearness: sums may differ in their last digits
    for g, w in zip(got, want):
        assert all(a is b if b is None else a == pytest.approx(b, rel=1e-9) for a, b in zip(g[2:], w[2:]))


def test_texts_that_were_not_counted(frame):
    rows = corpus(n=80)
    docs = frame(rows, "doc_id long, text string")
    other = frame([(1, "W1 W2 never W1"), (2, None), (0, "W1 W1"), (None, "new words")], "doc_id long, text string")
    target = {0, 1, 2, 40}
    model = lm_score.train(docs, frame([(k,) for k in target], "doc_id long"), block=200, parts=5)
    losses = plain(rows, target)
    got = {r["id"]: r for r in lm_score.score(other, model).collect()}
    assert len(got) == 4
    for r in other.collect():
        check(got[r["doc_id"]], (losses(r["text"]), r["text"]))


def test_rare_words_are_in_the_models(frame):
    common = [(k, "a b c d e f g h " * 1000) for k in range(100)]  # 800,000 tokens: the least count was 4
    rare = [(200, "x1 x2 x3 x4 x5 x6"), (201, "x1 x2 x3 x4 x5 x6"), (202, "y1 y2 y3 y4 y5 y6")]
    docs = frame(common + rare, "doc_id long, text string")
    got = {r["id"]: r for r in lm_score.score(docs, lm_score.train(docs, frame([(0,), (1,)], "doc_id long"))).collect()}
    assert got[200]["background_loss"] == got[201]["background_loss"]
    assert got[202]["background_loss"] > got[200]["background_loss"] + 0.5


def test_questions_of_wide_words_go_to_several_parts():
    estimate = {"word": np.array([5, 9, ngram_counts.START], np.uint64), "n": np.array([900, 100, 10])}
    deal = ngram_counts.Deal(10, estimate)
    assert deal.parts_of(np.array([5, 9, 7], np.uint64)).tolist() == [9, 1, 1]
    n = np.array([0, 1, 255, 256, 1 << 40])
    assert ngram_counts.widened(ngram_counts.narrow(n)).tolist() == n.tolist()
    assert ngram_counts.widened(ngram_counts.narrow(n[:0])).tolist() == []


@pytest.mark.parametrize("threshold", ["-1", "1g"])
def test_only_texts_that_may_be_targets_are_moved_by_one_plan(spark, frame, threshold):
    docs = frame([(k % 90 if k % 7 else None, f"text {k}", 3) for k in range(100)], "id long, text string, role int")
    ids = frame([(3,), (4,), (500,)], "doc_id long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        bits = spark.sparkContext.broadcast(bloom.build(ids))
        out = ngram_counts.flagged(docs, ids, bits)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        assert sorted(r["text"] for r in out.where("target").collect()) == ["text 3", "text 4", "text 93", "text 94"]
        assert out.where("target IS NOT NULL").count() < 10
        blocks = out.mapInArrow(ngram_counts.blocks_of(bits, 30), ngram_counts.BLOCKS).collect()
        assert len({r["block"] for r in blocks}) == len(blocks) > 3
        assert sum(len(r["ids"]) for r in blocks) == 100 and sum(sum(r["targets"]) for r in blocks) == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
