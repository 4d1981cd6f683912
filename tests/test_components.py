"""Connected components against a union-find on the driver."""

import random

import pytest

from tessera.operators.components import connected_components


def brute(edges):
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in parent}


def random_edges(seed):
    r = random.Random(seed)
    return [(r.randrange(60), r.randrange(60)) for _ in range(45)]


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(40)], [(1, 3), (3, 2), (2, 9), (7, 7)], [(0, i) for i in range(1, 30)], random_edges(1), []], ids=["path", "bent", "star", "random", "empty"])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == brute(edges)


def test_null_ends_are_no_edges(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (4, 3)], "a long, b long")
    assert {tuple(r) for r in connected_components(df).collect()} == {(3, 3), (4, 3)}
