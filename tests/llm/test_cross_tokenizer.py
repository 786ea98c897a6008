"""Alignment of two tokenizers against a plain one that compares all byte ranges, with the libraries' own tokens."""

import hashlib
from collections import Counter, defaultdict
from functools import lru_cache

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tradewake.llm import cross_tokenizer, queries

SMALL = "/root/testdata/sf0.001"


@lru_cache
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@lru_cache
def letters():
    """Character of the byte-level alphabet -> byte: printable Latin-1 characters stand for themselves, the others from U+0100 on."""
    own = [b for b in range(256) if chr(b) in ByteLevel.alphabet()]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}


def plain_ids(text):
    a, b = libraries()
    if not text:
        return [], [], [], []
    x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_bytes = [bytes(map(letters().__getitem__, a.id_to_token(i))) for i in x]
    pieces = [b.id_to_piece(i) for i in y]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(y, pieces)]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], [], []
    return x, y, a_bytes, b_bytes


def plain(text):
    """(n_a, n_b, groups, links) by comparing ranges."""
    x, y, a_bytes, b_bytes = plain_ids(text)
    spans = lambda parts: [(sum(map(len, parts[:k])), sum(map(len, parts[: k + 1]))) for k in range(len(parts))]
    a, b = spans(a_bytes), spans(b_bytes)
    links = [(i, j) for (s, e), i in zip(a, x) for (t, f), j in zip(b, y) if s < f and t < e]
    groups, start = [], 0
    for end in sorted({e for _, e in a} & {e for _, e in b}):
        side = lambda spans, ids: ",".join(str(i) for (s, e), i in zip(spans, ids) if start <= s and e <= end)  # noqa: B023, E731
        groups.append(f"{side(a, x)}|{side(b, y)}")
        start = end
    return len(x), len(y), groups, links


TEXTS = st.text(st.characters(exclude_categories=["Cs"]), max_size=25) | st.text(" \n\t▁<>|0xstrelao'éß的😀", max_size=25) | st.sampled_from(
    ["<|endoftext|>", "<s> a</s>", "<0x41>", "▁", " lead", "trail ", "two  spaces", "ﬁ", "été", "Hello world, unbelievable tokenization", "\0", "\r\n"]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_groups_and_links(texts):
    both = cross_tokenizer.sides("byte_bpe_50k.tiktoken", "piece_bpe_32k.model")
    n_a, n_b, n_groups, groups, links = cross_tokenizer.aligned_texts(texts, both)
    for k, text in enumerate(texts):
        a, b, want, pairs = plain(text)
        assert (n_a[k], n_b[k], n_groups[k], groups[k]) == (a, b, len(want), ";".join(want))
        assert sorted(divmod(x, 1 << 32) for x in links[k].tolist()) == sorted(pairs)


def counted(rows):
    """(n_links, n_best, count_sum) of each row."""
    links = [plain(t)[3] for t in rows]
    count = Counter(p for x in links for p in set(x))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(len(x), sum(count[p] == best[p[0]] for p in x), sum(count[p] for p in x)) for x in links]


@pytest.mark.parametrize("block", [cross_tokenizer.BLOCK, 40])
def test_frames(spark, block):
    texts = ["a b a b", "été a", None, "", "▁", "a b a b", "<|endoftext|> a", "unbelievable 的 " * 30, " a", "x" * 300]
    rows = [(k if k else None, t, "keep", -1) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other string, n_best int").repartition(3)
    got = cross_tokenizer.support(cross_tokenizer.align(docs), block=block)
    once = cross_tokenizer.alignment(docs, digest=str.upper, block=block)
    assert once.columns == got.columns and sorted(once.collect(), key=str) == sorted(got.withColumn("groups", F.upper("groups")).collect(), key=str)
    assert got.columns == ["doc_id", "other", "n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]
    found = {r["doc_id"]: r for r in got.collect()}
    assert len(found) == len(texts)
    for (k, text, *_), want in zip(rows, counted(texts)):
        a, b, groups, _ = plain(text)
        assert tuple(found[k]) == (k, "keep", a, b, len(groups), ";".join(groups), *want)


def test_empty_table_and_no_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r) for r in cross_tokenizer.support(cross_tokenizer.align(docs)).collect()} == {(k, 0, 0, 0, "", 0, 0, 0) for k in (1, 2)}
    assert cross_tokenizer.support(cross_tokenizer.align(docs.limit(0))).collect() == []


def test_long_text(spark):
    text = "word 的é unbelievable\n" * 20_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = cross_tokenizer.support(cross_tokenizer.align(docs)).first()
    x, y, a_bytes, b_bytes = plain_ids(text)
    assert (got["n_a"], got["n_b"]) == (len(x), len(y)) and got["n_links"] == len(x) + len(y) - got["n_groups"]


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, SMALL, "documents").collect()}
    got = queries.QUERIES["op13_cross_tokenizer"](spark, SMALL)
    assert dict(got.dtypes) == dict.fromkeys(["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"], "bigint") | {"groups_sha256": "string"}
    rows = {r["doc_id"]: r for r in got.collect()}
    assert set(rows) == set(texts)
    # plain links in one walk, as texts are long here
    links = {}
    for k, text in texts.items():
        x, y, a_bytes, b_bytes = plain_ids(text)
        i = j = s = t = 0
        found, groups, cut = [], [], (0, 0)
        while i < len(x):
            found.append((x[i], y[j]))
            e, f = s + len(a_bytes[i]), t + len(b_bytes[j])
            if e <= f:
                i, s = i + 1, e
            if f <= e:
                j, t = j + 1, f
            if e == f:
                groups.append(",".join(map(str, x[cut[0] : i])) + "|" + ",".join(map(str, y[cut[1] : j])))
                cut = i, j
        links[k] = found
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if x else ""
        assert tuple(rows[k])[:5] == (k, len(x), len(y), len(groups), len(found)) and rows[k]["groups_sha256"] == digest
    count = Counter(p for found in links.values() for p in set(found))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    for k, found in links.items():
        assert (rows[k]["n_best"], rows[k]["count_sum"]) == (sum(count[p] == best[p[0]] for p in found), sum(count[p] for p in found))
