import random

import numpy as np

from riskloom.llm.components import components, local_components


def plain(edges):
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        top[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(top)}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)]
    edges += [(1000 + k, 1001 + k) for k in range(40)] + [(2000, 2000 + k) for k in range(1, 50)] + edges[:20]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    loops = {a for a, b in edges if a == b}
    wanted = {k: v for k, v in plain(edges).items() if k in got or k not in loops}
    assert got == wanted
    assert components(frame.limit(0)).count() == 0


def test_local():
    linked = np.zeros((6, 6), dtype=bool)
    for a, b in ((0, 3), (3, 5), (1, 2)):
        linked[a, b] = linked[b, a] = True
    assert local_components(linked).tolist() == [0, 1, 1, 0, 4, 0]
