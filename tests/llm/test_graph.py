"""Components against a plain union-find."""
import random

import numpy as np
import pytest

from skein.llm import graph


def plain(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {x: root(x) for x in parent}


def kinds(rng):
    yield []
    yield [(3, 3), (1, 1)]
    yield [(i, i + 1) for i in range(3000)]                                  # a path
    yield [(i, 0) for i in range(1, 5000)] + [(0, -7)]                       # a hub
    yield [(rng.randrange(800), rng.randrange(800)) for _ in range(500)]
    yield [(rng.randrange(300), rng.randrange(300)) for _ in range(3000)]
    path = list(range(2000))
    rng.shuffle(path)
    yield list(zip(path, path[1:]))
    yield [(x, 10_000 + x % 40) for x in range(2000)] + [(x, 20_000 + x % 37) for x in range(2000)]
    yield [(1 << 62, -(1 << 62)), (5, 1 << 62)] * 3


def test_components(spark, monkeypatch):
    rng = random.Random(4)
    for edges in kinds(rng):
        df = spark.createDataFrame(edges, "a long, b long").repartition(5)
        got = graph.components(df).collect()
        assert len(got) == len({r.node for r in got})
        assert {r.node: r.component for r in got} == plain(edges)


@pytest.mark.parametrize("n", [0, 1, 400])
def test_forest(n):
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, 300, n), rng.integers(0, 300, n)
    x, y = graph.forest(a, b)
    want = plain(list(zip(a.tolist(), b.tolist())))
    assert dict(zip(x.tolist(), y.tolist())) == {k: v for k, v in want.items() if k != v}
