import random

from tradewake.llm.graph import components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


def test_random_graphs_paths_and_stars(frame):
    rng = random.Random(5)
    edges = [(rng.randrange(-50, 400), rng.randrange(-50, 400)) for _ in range(220)]
    edges += [(1000 + k, 1001 + k) for k in range(60)] + [(2000, 2000 + k) for k in range(1, 300)] + edges[:9]
    edges = [(a, b) for a, b in edges if a != b]
    got = components(frame([*edges, (7777, 7777), (None, 3)], "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == brute(edges)
    assert got.count() == len(brute(edges))


def test_no_edges(frame):
    assert components(frame([], "a long, b long")).collect() == []
