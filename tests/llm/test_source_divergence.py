"""The divergence audit against a plain recount, with and without terms beyond the broadcast shards; perfect hashes."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import floor

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewake.llm import source_divergence as sd
from tradewake.llm.perfect_hash import PerfectHash


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=400))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.uint64)
    made = PerfectHash(keys)
    assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
    again = PerfectHash(bits=made.bits)
    assert (again.slots(keys) == made.slots(keys)).all()
    other = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    assert ((made.slots(other) >= -1) & (made.slots(other) < max(1, len(keys)))).all()


@given(st.lists(st.text("abé的", min_size=1, max_size=12), max_size=40))
def test_words_are_found_and_hashed_alike_wherever_they_stand(words):
    data = np.frombuffer(("  ".join([*words, *words[::-1]]) + " ").encode(), np.uint8)
    starts, sizes, hashed = sd.tokens(data)
    got = [data[a : a + n].tobytes().decode() for a, n in zip(starts, sizes)]
    assert got == [*words, *words[::-1]]
    assert len(set(zip(got, hashed.tolist()))) == len(set(got)) == len(set(hashed.tolist()))
    assert (sd.hashes("en", [w.encode() for w in words]) == sd.mixed(hashed[: len(words)] + sd._seed("en"))).all()


@given(st.text())
def test_terms(text):
    want = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]
    assert [t.decode() for t in sd.terms(text)] == want


@pytest.mark.parametrize("n, total, kept", [(0, 0, 1), (5, 9, 4), (10**14, 10**15, 10**9), (0, 10**15, 3), (7, 7, 1), (3, 3, 0)])
def test_shares_are_exact(spark, n, total, kept):
    row = spark.range(1).select(sd.share(*[F.lit(x).cast("long") for x in (n, total, kept)]).alias("p")).first()
    assert row["p"] == (1 + 10**9 * (n + 1) // (total + kept) if kept else 1)


def plain(rows, least=3, top=200):
    docs = [tuple(x or "" for x in r) for r in rows]
    words = [(lang, source, [t.decode() for t in sd.terms(text)]) for lang, source, text in docs]
    holders, counts = Counter(), defaultdict(Counter)
    for lang, source, got in words:
        holders.update({(lang, t) for t in got})
    kept = defaultdict(set)
    for (lang, t), n in holders.items():
        if n >= least:
            kept[lang].add(t)
    for lang, source, got in words:
        mine = Counter(t for t in got if t in kept[lang])
        counts[lang, source].update(mine)
        counts[lang, None].update(mine)
    part = lambda key, t: 1 + floor(Fraction(10**9 * (counts[key][t] + 1), sum(counts[key].values()) + len(kept[key[0]])))
    f = lambda p, q: (p - q) ** 2 // q
    out = set()
    for lang, source in [k for k in list(counts) if k[1] is not None]:
        pairs = [(o, sum(f(part((lang, source), t), part((lang, o), t)) for t in kept[lang])) for g, o in list(counts) if g == lang and o is not None and o != source]
        own = [(t, part((lang, source), t), part((lang, None), t)) for t in kept[lang] if counts[lang, source][t]]
        for name, found, most in (("pair", pairs, len(pairs)), ("term", [(t, f(p, q)) for t, p, q in own if p > q], top)):
            found.sort(key=lambda x: (-x[1], x[0].encode()))
            out |= {(lang, source, name, item, value, k + 1) for k, (item, value) in enumerate(found[:most])}
    return out


def corpus():
    rng = np.random.default_rng(5)
    letters = ["alpha", "Beta", "gamma", "été", "x" * 80, "ÉTÉ", "dd", "ee", "ff", "的一", "g2h", "tie", "tye"]
    rows = [(lang, source, " ".join(rng.choice(letters, rng.integers(0, 30)))) for lang in ("en", "fr", None) for source in ("a", "b", "c", None) for _ in range(4)]
    return rows + [("en", "a", None), ("en", "d", ""), ("xx", "a", "lonely words"), ("yy", "a", ""), ("yy", "b", None), ("en", "a", "alpha " * 20_000)] + [("en", "a", "tie tye")] * 3


@pytest.mark.parametrize("slots", [sd.SLOTS, 4, 0])
@pytest.mark.parametrize("top", [200, 2])
def test_audit_is_the_plain_one(spark, slots, top):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1, "no") for r in rows], "lang string, source string, text string, rank int, item string")
    got = sd.audit(docs, slots=slots, top=top).collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == plain(rows, top=top)


def test_blocks_and_tiles_do_not_change_results(spark, monkeypatch):
    rows = corpus()
    monkeypatch.setattr(sd, "BLOCK", 2)
    monkeypatch.setattr(sd, "TILE", 2)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert {tuple(r) for r in sd.audit(docs).collect()} == plain(rows)


def test_empty(spark):
    assert sd.audit(spark.createDataFrame([], "lang string, source string, text string")).collect() == []


def test_dense_counts_are_handed_over_when_full(spark, monkeypatch):
    """A fresh process sees the small bounds: the pass runs in this one."""
    monkeypatch.setattr(sd, "DENSE", 1)
    monkeypatch.setattr(sd, "DISTINCT", 1)
    rows = [(a, b, c or "") for a, b, c in corpus() if a]
    batch = __import__("pyarrow").RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), [x or "" for x in r])) for r in rows])
    seen = Counter()
    for part in sd._holders([batch, batch]):
        for r in part.to_pylist():
            seen[r["lang"], r["term"]] += r["n"]
    want = Counter()
    for lang, _, text in rows:
        want.update({(lang, t.decode()) for t in sd.terms(text)})
    assert seen == Counter({k: 2 * n for k, n in want.items()})
