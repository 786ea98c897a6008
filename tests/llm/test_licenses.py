import math

from tradewake.llm.licenses import TEMPLATES, scan, terms


def cosine(line, text):
    held = [set(terms(t)) for t in TEMPLATES.values()]
    idf = lambda t: math.log((1 + len(held)) / (1 + sum(t in h for h in held))) + 1
    a, b = set(terms(line)), set(terms(text))
    norm = lambda s: math.sqrt(sum(idf(t) ** 2 for t in s))
    return sum(idf(t) ** 2 for t in a & b) / (norm(a) * norm(b)) if a else 0.0


LINES = [
    "Licensed under the Apache License, Version 2.0.", "  licensed### UNDER the** Apache License (version 2.0)", "Released under the MIT License, by us",
    "the license of the version", "This work is licensed under the GNU General Public License, version 3. And much more text follows on the same line here",
    "License", "", "é MIT ü", "# Distributed under the Boost Software License, Version 1.0", "no terms at all", "version 2.0 of the Eclipse Public License",
]


def test_scores_against_plain_cosine(frame):
    got = {r["id"]: (r["license"], r["score"]) for r in scan(frame(list(enumerate(LINES)), "id long, text string").selectExpr("id", "'' AS path", "text"), least=0.5).collect()}
    for k, line in enumerate(LINES):
        score, name = max((round(cosine(line, t), 6), [-ord(c) for c in n], n) for n, t in TEMPLATES.items())[::2]
        want = (name, score) if score >= 0.5 else (None, None)
        assert got[k][0] == want[0] and (want[1] is None or abs(got[k][1] - want[1]) < 2e-6), line


def test_inheritance_and_edges(frame):
    mit, gpl, apache = TEMPLATES["MIT"], TEMPLATES["GPL-3.0"], TEMPLATES["Apache-2.0"]
    rows = [
        (1, "a/LICENSE", f"words\n{mit}\n"), (2, "a/x.py", "code"), (3, "a/b/y.py", "code\n" * 4000), (4, "a/b/c/COPYING.txt", gpl), (5, "a/b/c/d/z.py", None),
        (6, "a/b/c/d/own.py", f"code\n// {apache}\ncode"), (7, "ab/q.py", "code"), (8, None, "code"), (9, "top.py", ""), (10, "d/NOTICE", "nothing known"),
        (11, "d/e.py", "code"), (12, "a/b/license-old", "empty"), (2, "a/x.py", "code"), (None, "a/n.py", "code"), (13, None, mit), (14, "e/LICENSE", gpl), (15, "e/LICENSE.2", mit), (16, "e/f", ""),
    ]
    files = frame([(*r, "s", "k") for r in rows], "id long, path string, text string, dir string, license string")
    got = {(r["id"], r["path"]): (r["license"], r["origin"], r["origin_dir"]) for r in scan(files).collect()}
    assert len(got) == 17 == scan(files).count()
    none = (None, None, None)
    assert got == {
        (1, "a/LICENSE"): ("MIT", "own", None), (2, "a/x.py"): ("MIT", "inherited", "a"), (3, "a/b/y.py"): ("MIT", "inherited", "a"),
        (4, "a/b/c/COPYING.txt"): ("GPL-3.0", "own", None), (5, "a/b/c/d/z.py"): ("GPL-3.0", "inherited", "a/b/c"), (6, "a/b/c/d/own.py"): ("Apache-2.0", "own", None),
        (7, "ab/q.py"): none, (8, None): none, (9, "top.py"): none, (10, "d/NOTICE"): none, (11, "d/e.py"): none, (12, "a/b/license-old"): ("MIT", "inherited", "a"),
        (None, "a/n.py"): ("MIT", "inherited", "a"), (13, None): ("MIT", "own", None), (14, "e/LICENSE"): ("GPL-3.0", "own", None),
        (15, "e/LICENSE.2"): ("MIT", "own", None), (16, "e/f"): ("GPL-3.0", "inherited", "e"),
    }
    assert scan(files.limit(0)).collect() == []


def test_root_licence_and_main_path_is_native(frame):
    files = frame([(1, "LICENSE", TEMPLATES["ISC"]), (2, "a/b/c", "x"), (3, "d", "y"), (4, "/abs/LICENSE", TEMPLATES["MIT"]), (5, "/abs/x/y", "")], "id long, path string, text string")
    got = scan(files)
    assert {r["id"]: r["license"] for r in got.collect()} == {1: "ISC", 2: "ISC", 3: "ISC", 4: "MIT", 5: "MIT"}
    assert "Python" not in got._jdf.queryExecution().toString()
