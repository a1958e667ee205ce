import random

import pytest

from dqspark.llm.components import components
from dqspark.llm.staging import Staged


def slow(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {(n, find(n)) for n in list(root)}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "odd", "none"])
def test_like_union_find(spark, kind):
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in rng.sample(range(60), 60)],
        "star": [(100, i) for i in range(40)],
        "random": [(rng.randrange(80), rng.randrange(80)) for _ in range(60)],
        "odd": [(1, 1), (None, 2), (3, None), (5, 4), (4, 5), (5, 4), (-7, 5)],
        "none": [],
    }[kind]
    found = components(spark.createDataFrame(edges, "a long, b long"), Staged(spark, "t")).collect()
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == slow(edges)
