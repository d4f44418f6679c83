"""Connected components against a plain union of sets."""

import random

import pytest

from daytally.llm.common import Store
from daytally.llm.components import components

R = random.Random(5)
GRAPHS = {
    "sparse": [(R.randrange(300), R.randrange(300)) for _ in range(150)],
    "dense": [(R.randrange(100), R.randrange(100)) for _ in range(300)],
    "chain": [(i, i + 1) for i in range(100)],
    "star": [(0, i) for i in range(50)],
    "star round its largest": [(50, i) for i in range(50)],
    "repeated and loops": [(1, 2), (2, 1), (3, 3), (1, 2)],
    "empty": [],
}


def expected(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {(x, find(x)) for a, b in edges if a != b for x in (a, b)}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = spark.createDataFrame(GRAPHS[name], "a long, b long")
    got = [tuple(row) for row in components(edges, Store(spark, "graph"), "g").collect()]
    assert len(got) == len(set(got)) and set(got) == expected(GRAPHS[name])
