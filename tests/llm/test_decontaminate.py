from tradewake.llm.decontaminate import decontaminated, find_items, partition_of, signature_size
from tradewake.llm.words import WordHashes, shingle_set, words


def test_signatures_cannot_be_missed():
    for n in range(1, 400):
        missing = n - -(-75 * n // 100)
        assert signature_size(partition_of(n), 75) > missing


def test_tables_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    known = WordHashes()
    sets = {r["item_id"]: set(shingle_set(r["text"], known).tolist()) for r in items.collect()}
    want = set()
    for r in docs.collect():
        held = set(shingle_set(r["text"], known).tolist())
        want |= {(r["doc_id"], i, len(s & held), len(s)) for i, s in sets.items() if s and 100 * len(s & held) >= 75 * len(s)}
    assert want and {tuple(r) for r in find_items(docs, items).collect()} == want


def test_edges(frame):
    item = "the quick brown fox jumps over the lazy dog and runs away from here"
    w = words(item)
    cut = b" ".join(w[2:]).decode()  # 8 of 10 shingles
    half = b" ".join(w[:9]).decode()  # 5 of 10
    rows = [(1, f"before {item.upper()} after", 9), (2, cut, 9), (3, half, 9), (4, None, 9), (5, "", 9), (None, item, 9), (1, f"before {item} after", 9),
            (6, "long " * 3000 + item + " text" * 3000, 9), (7, "we say hello   there twice", 9), (8, "hello you there", 9)]
    docs = frame(rows, "doc_id long, text string, token int")
    items = frame([(10, item, 1), (10, item, 1), (11, "Hello there", 2), (12, None, 3), (13, " ", 4), (None, item, 5)], "item_id long, text string, n int")
    assert sorted(map(tuple, find_items(docs, items).collect())) == [(1, 10, 10, 10), (2, 10, 8, 10), (6, 10, 10, 10), (7, 11, 1, 1)]
    kept = decontaminated(docs, items)
    assert kept.columns == docs.columns and sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 3, 4, 5, 8]
    assert find_items(docs.limit(0), items).collect() == [] and find_items(docs, items.limit(0)).collect() == []
    assert decontaminated(docs, items.limit(0)).count() == len(rows)
