import random

import pytest

from lexforge.llm.components import connected_components


def test_components_match_union_find(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    parent = {x: x for pair in links for x in pair}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = top(a), top(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for pair in links if pair[0] != pair[1] for x in pair}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_long_chains_are_joined(spark):
    links = [(i, i + 1) for i in range(4000)] + [(10_000 - i, 9_999 - i) for i in range(3000)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(4001)} | {i: 7_000 for i in range(7_000, 10_001)}


def test_unfinished_labels_are_an_error(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    with pytest.raises(RuntimeError):
        connected_components(links, rounds=1)
