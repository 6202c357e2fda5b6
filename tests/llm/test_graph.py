"""Connected components against union-find."""

import random

from shiftline.llm.graph import components


def _expected(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = root(a), root(b)
        if a != b:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


def test_components_of_paths_hubs_and_noise(spark):
    rnd = random.Random(1)
    path = [(k, k + 1) for k in range(100, 140)]
    rnd.shuffle(path)
    hub = [(500 + k, 499) for k in range(80)]
    noise = [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(90)]
    for edges in (path, hub + path, path + hub + noise + noise[:20] + [(7, 7)], [(2, 1)]):
        got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == _expected(edges)
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
