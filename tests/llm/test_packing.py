import collections
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradewake.llm.packing import cuts, differencing, encoder, pack, windows_of

EXACT = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_ids_are_those_of_tokenizers(text):
    assert encoder("byte_bpe_50k")(text).tolist() == EXACT.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts():
    for text in ("<|endoftext|> x", "a" * 5000, " \t\n　\x85 x  ", "naïve 漢字 🙂 ١٢", "don't 's 'LL"):
        assert encoder("byte_bpe_50k")(text).tolist() == EXACT.encode(text, add_special_tokens=False).ids


def test_cuts():
    for n in (1, 2047, 2048, 2049, 2304, 9999):
        parts = cuts(n, 2048, 256)
        assert [a for a, _ in parts] == np.cumsum([0, *(k for _, k in parts)]).tolist()[:-1] and sum(k for _, k in parts) == n
        assert all(k == 2048 or k <= 256 for _, k in parts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 256), min_size=1, max_size=300))
def test_windows_hold_their_capacity_with_little_padding(lengths):
    lengths = np.array(lengths)
    window = windows_of(lengths, 2048, 256)
    sums = np.bincount(window, weights=lengths)
    assert sums.max() <= 2048 and sums.min() > 0 and len(sums) <= -(-lengths.sum() // 2048) + 1
    assert sums.max() - sums.min() <= 256


def test_differencing_beats_what_a_simple_rule_leaves():
    assert sorted(np.bincount(differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])) == [14, 16]
    sizes = np.random.default_rng(3).integers(20, 257, 900)
    sums = np.bincount(differencing(sizes, 64), weights=sizes)
    assert sums.max() - sums.min() <= 8


def round_trip(rows, docs):
    ids = {}
    for doc, text in docs:
        ids.setdefault(doc, collections.Counter())[tuple([*EXACT.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    by_sequence, whole = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        whole[r["id"]].append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    for doc, texts in ids.items():
        if sum(texts.values()) == 1:
            (tokens,) = texts
            at = 0
            for r in sorted(whole[doc], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(tokens)
                part = np.array(tokens[at : at + r["length"]], "<u4")
                assert r["ids_crc32"] == zlib.crc32(part.tobytes())
                at += r["length"]
            assert at == len(tokens)
        assert sum(r["length"] for r in whole[doc]) == sum(len(t) * n for t, n in texts.items())
    return by_sequence


def test_documents_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs).collect()
    sequences = round_trip(rows, [(r["doc_id"], r["text"]) for r in docs.collect()])
    used, room = sum(r["length"] for r in rows), 2048 * len(sequences)
    assert used / room > 0.97


def test_edges(frame):
    rows = [(1, "hello"), (2, None), (3, ""), (None, "no id"), (5, "same"), (5, "same"), (6, "word " * 9000)] + [(k, "") for k in range(100, 3100)]
    docs = frame([(*r, 0, "x") for r in rows], "doc_id long, text string, length int, uid string")
    got = pack(docs, keep_ids=True).collect()
    round_trip(got, rows)
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)
    assert pack(docs.limit(0)).collect() == []
