"""Byte-level BPE against the tiktoken library and by exact round trips."""

import hashlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewake.llm import byte_bpe, queries

RANKS = "byte_bpe_multi_50k.tiktoken"


@lru_cache
def plain(name=RANKS):
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.vocabulary(name).ranks, special_tokens={})


@lru_cache
def encoder(name=RANKS):
    return byte_bpe.Encoder(name)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])) | st.text(" \n\t 　\x1c'strvelmd09aäß的😀") | st.text("ab", max_size=600), max_size=6))
def test_ids_are_those_of_the_library(texts):
    got = encoder().encode(texts)
    assert [g.tolist() for g in got] == [plain().encode_ordinary(t) for t in texts]
    flat, offsets = np.concatenate([np.zeros(0, np.int64), *got]), np.concatenate(([0], np.cumsum([len(g) for g in got]))).astype(int)
    data, ends = encoder().vocab.decoded(flat, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(ends, ends[1:])] == texts


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefghij", "äöüé", "的一是在不了", "=-", "aA1"])
@pytest.mark.parametrize("name", [RANKS, "byte_bpe_50k.tiktoken"])
def test_long_matches(letters, name):
    rng = np.random.default_rng(len(letters))
    for n in (3, 40, 257, 3000, 20_000):
        text = "".join(rng.choice(list(letters), n))
        assert encoder(name).encode([text])[0].tolist() == plain(name).encode_ordinary(text)


def test_merges_that_rank_lower_than_what_made_them_go_first():
    """Tokens whose parts come later in the order: one merge at a time and many at once must still agree."""
    ranks = {bytes([b]): b + 1000 for b in range(256)} | {b"ab": 5, b"abc": 1, b"abab": 0, b"ca": 3, b"cab": 2, b"aa": 4, b"aaaa": 6}
    vocab = object.__new__(byte_bpe.Vocabulary)
    vocab.ranks, vocab.byte_ids = ranks, np.arange(256) + 1000
    get = ranks.get
    rows = [(get(t[:k]), get(t[k:]), r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    vocab.pairs = byte_bpe.PairTable(*np.array(rows, np.int64).T)
    rng = np.random.default_rng(3)
    for n in (5, 17, 60, 300, 900):
        piece = rng.choice(np.frombuffer(b"abc", np.uint8), n).tobytes()
        ids = [bytes([b]) for b in piece]
        while pairs := [(ranks[a + b], k) for k, (a, b) in enumerate(zip(ids, ids[1:])) if a + b in ranks]:
            k = min(pairs)[1]
            ids[k : k + 2] = [ids[k] + ids[k + 1]]
        want = [ranks[t] for t in ids]
        assert byte_bpe.merged([piece], vocab)[0].tolist() == want
        assert byte_bpe.merged_long(vocab.byte_ids[np.frombuffer(piece, np.uint8)], vocab.pairs).tolist() == want


def test_memory_of_matches_is_emptied(monkeypatch):
    monkeypatch.setattr(byte_bpe, "KNOWN", 3)
    own = byte_bpe.Encoder(RANKS)
    for text in ["one two three four", "five six one two", "", "one"] * 2:
        assert own.encode([text])[0].tolist() == plain().encode_ordinary(text)
        assert len(own) <= 8


def test_frames(spark):
    long = "word äöü 的 " * 30_000
    rows = [(1, "Hello <|endoftext|> world", 7), (2, None, 8), (3, "", 9), (None, "tie", 1), (4, "tie", 2), (4, "tie", 2), (5, long, 3), (6, "x" * 40_000, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS int")
    both = byte_bpe.decode(byte_bpe.encode(docs))
    assert both.columns == ["doc_id", "text", "ids", "decoded"]
    for r in both.collect():
        assert r["ids"] == plain().encode_ordinary(r["text"] or "") and bytes(r["decoded"]) == (r["text"] or "").encode()
    assert both.count() == 8 and byte_bpe.decode(byte_bpe.encode(docs.limit(0))).collect() == []


def test_ids_that_are_not_there(spark):
    ids = spark.createDataFrame([(1, None), (2, []), (3, [50_256]), (4, [1, None]), (5, [-1]), (6, [0, 1])], "k int, ids array<int>")
    got = {r["k"]: r["decoded"] for r in byte_bpe.decode(ids).collect()}
    tokens = {v: k for k, v in byte_bpe.vocabulary(RANKS).ranks.items()}
    assert {k: None if v is None else bytes(v) for k, v in got.items()} == {1: None, 2: b"", 3: None, 4: None, 5: None, 6: tokens[0] + tokens[1]}


def test_query(spark):
    small = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, small, "documents").collect()}
    got = queries.QUERIES["op11_byte_bpe"](spark, small)
    assert dict(got.dtypes) == {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = plain().encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
