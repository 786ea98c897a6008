import itertools
import math
import random

import pytest

from tradewake.llm import shingle_join
from tradewake.llm.shingle_join import best_boundary, need, ngram_join, prefix_size, similar_groups, subset_sizes
from tradewake.llm.words import WordHashes, shingle_set


def brute(rows, percent=75):
    known = WordHashes()
    sets = [(i, frozenset(shingle_set(t, known).tolist())) for i, t in rows if i is not None]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for (a, (_, x)), (b, (_, y)) in itertools.combinations(enumerate(sets), 2):
        n = len(x & y)
        if n and 100 * n >= percent * (len(x) + len(y) - n):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(sets))


def run(df, **options):
    return sorted(tuple(r) for r in similar_groups(df, **options).where("id IS NOT NULL").collect())


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        k = rng.randrange(len(w))
        w[k : k + 1] = rng.choice([[], [f"new{rng.randrange(999)}"], [w[k], "extra"]])
        w = w or ["x"]
    return " ".join(w)


def corpus(seed, n=260):
    """Short and long texts, copies, chains of edits, and a passage that many hold."""
    rng = random.Random(seed)
    passage = " ".join(f"p{k}" for k in range(14))
    texts = []
    while len(texts) < n:
        size = rng.choice([1, 3, 5, 7, 9, 11, 13, 15, 18, 25, 60, 200])
        text = " ".join(f"w{rng.randrange(10_000)}" for _ in range(size))
        if rng.random() < 0.4:
            text = f"{passage} {text}" if rng.random() < 0.5 else f"{text} {passage}"
        for _ in range(rng.choice([1, 1, 2, 5, 12])):
            texts.append(text)
            if rng.random() < 0.7:
                text = edited(rng, text, rng.choice([1, 1, 2, max(1, size // 30)]))
    rng.shuffle(texts)
    return list(enumerate(texts, 100))


@pytest.mark.parametrize("seed, percent", [(1, 75), (3, 60)])
def test_random_corpus_against_all_pairs(frame, seed, percent):
    rows = corpus(seed)
    assert run(frame(rows, "doc_id long, text string"), percent=percent) == brute(rows, percent)


@pytest.mark.parametrize("boundary, heavy", [(0, 2), (16, 4)])
def test_any_boundary_and_heavy_lists(frame, monkeypatch, boundary, heavy):
    monkeypatch.setattr(shingle_join, "best_boundary", lambda *a: boundary)
    monkeypatch.setattr(shingle_join, "HEAVY", heavy)
    rows = corpus(boundary + 10, 150)
    assert run(frame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_tables_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert run(docs) == brute([tuple(r) for r in docs.collect()])


def test_edges(frame):
    long = " ".join(f"v{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO "), (6, "one two three"), (9, "a b c d e"), (8, "a b c d e"), (8, "a b c d e"),
            (11, "\xc9t\xe9 a b c d"), (12, "\xe9t\xe9 a b c d"), (20, long), (21, long + " more"), (22, long.replace("v7 ", "u7 ")), (7, "a b c d e")]
    docs = frame([(*r, 5, "q") for r in [*rows, (None, "one two"), (None, "only here")]], "doc_id long, text string, n int, token string")
    assert run(docs) == brute(rows)
    assert similar_groups(docs).where("id IS NULL AND component_id IS NULL").count() == 2
    assert run(docs.limit(0)) == []
    members, links = ngram_join(docs.limit(0))
    assert members.collect() == [] and links.collect() == []


def test_sizes_and_cost():
    for a in range(1, 40):
        for b in range(a, 60):
            if 100 * a >= 75 * b and need(a, b, 75) <= a:
                assert need(a, b, 75) in subset_sizes(a, 60, 75) and need(a, b, 75) in subset_sizes(b, 60, 75)
                # sets that share that much cannot miss each other's prefixes
                assert prefix_size(a, 75) > a - need(a, b, 75) and prefix_size(b, 75) > b - need(a, b, 75)
    sizes = dict.fromkeys(range(1, 33), 100)
    assert best_boundary(sizes, 1, 75) < best_boundary(sizes, 100, 75) < 16
    assert math.comb(12, 9) == len(shingle_join._choices(12, 9))
