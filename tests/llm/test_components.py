"""Connected components against plain union-find."""

import random

import pytest

from tidemark.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


def graphs():
    rng = random.Random(8)
    yield "path", [(i, i + 1) for i in range(-20, 20)]
    yield "hub", [(0, i) for i in range(1, 400)] + [(i, i + 1000) for i in range(1, 50)]
    yield "random", [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    yield "loops and copies", [(5, 5), (1, 2), (2, 1), (1, 2), (7, 3)]


@pytest.mark.parametrize("name, edges", list(graphs()))
def test_components(spark, name, edges):
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(found) == len({r["node"] for r in found})
    assert {r["node"]: r["component"] for r in found} == plain([e for e in edges if e[0] != e[1]])


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
