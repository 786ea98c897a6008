import collections

from tradewake.llm.line_dedup import dedup_lines

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(rows, least=20, docs=3):
    holders = collections.defaultdict(set)
    for i, text, *_ in rows:
        if i is not None:
            for line in (text or "").split("\n"):
                if len(key(line)) >= least:
                    holders[key(line)].add(i)
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < docs or max(holders[key(x)]) == i]
        out.append((i, "\n".join(kept) if len(kept) < len(lines) else text, len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def run(df, **options):
    return sorted(map(tuple, dedup_lines(df, **options).select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def test_tables_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert run(docs) == brute([tuple(r) for r in docs.collect()])


def test_edges(frame):
    a, b = "This line is shared by many", "Another ÉTÉ line, shared as well"
    rows = [
        (1, f"{a}\nown\n  {a.upper()}\t"), (2, f"{a}\r\n\n{b}"), (3, f"x\n{a}\n{a}\ny"), (4, f"{b}\n{b}"), (5, b.replace("É", "é")), (6, f"\x0b{b}\x0c"),
        (7, None), (8, ""), (9, "\n\n"), (None, f"{a}\n{b}"), (None, a), (2, f"{a}\r\n\n{b}"), (3, f"other\n{a}"), (10, "short\n" * 3 + "nineteen characters"),
        (11, "nineteen characters"), (12, "nineteen characters"), (13, "unshared line of some length\n" * 5000), (14, " " + b + "\x85"),
    ]
    docs = frame([(*r, "keep") for r in rows], "doc_id long, text string, pos string")
    assert run(docs) == brute(rows)
    assert dedup_lines(docs).columns == ["doc_id", "text", "pos", "n_lines", "n_dropped"]
    assert run(docs.limit(0)) == []


def test_clashing_names_and_options(frame):
    rows = [(k, "shared words\nown %d" % k) for k in range(4)]
    docs = frame([(k, t, 5, "p") for k, t in rows], "doc_id long, text string, n_lines int, key string")
    got = dedup_lines(docs, min_chars=5, min_docs=4)
    assert got.columns == ["doc_id", "text", "key", "n_lines", "n_dropped"]
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [(0, "own 0"), (1, "own 1"), (2, "own 2"), (3, "shared words\nown 3")]
