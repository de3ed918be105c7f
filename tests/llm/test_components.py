from __future__ import annotations

import random

import pytest

from plumbline.llm.common import Scratch
from plumbline.llm.components import components


def plain(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    return {(n, root(n)) for n in up}


def graphs():
    rng = random.Random(3)
    chain = list(range(300))
    rng.shuffle(chain)
    yield [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    yield list(zip(chain, chain[1:], strict=False))
    yield [(i, i + 1) for i in range(200)] + [(900, 900), (None, 3), (5, None), (7, 8), (8, 7)]
    yield [(0, i) for i in range(1, 500)] + [(1000 + i, 2000) for i in range(300)] + [(1299, 499)]
    yield [(5, 5)]
    yield []


@pytest.mark.parametrize("edges", list(graphs()))
def test_labels_are_the_least_node_that_is_reached(spark, edges):
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(3), Scratch(spark, "t")).collect()
    assert len(found) == len({r["node"] for r in found}) and {tuple(r) for r in found} == plain(edges)
