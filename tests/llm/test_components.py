"""Components of link tables of many shapes."""

import random

import pytest

from seriesforge.llm.components import components


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            parent[find(a)] = find(b)
    groups = {}
    for x in parent:
        groups.setdefault(find(x), set()).add(x)
    return sorted(sorted(g) for g in groups.values())


def result(df):
    groups = {}
    for r in df.collect():
        groups.setdefault(r.root, set()).add(r.node)
    return sorted(sorted(g) for g in groups.values())


PATH = [(f"{i:03d}", f"{i + 1:03d}") for i in range(60)]
STAR = [("m", f"s{i}") for i in range(300)]
RING = [(f"r{i}", f"r{(i + 1) % 9}") for i in range(9)]
ODD = [("x", "x"), (None, "y"), ("z", None), ("a1", "a2"), ("a2", "a1"), ("a1", "a2")]
RANDOM = [(f"q{random.Random(i).randrange(200)}", f"q{random.Random(-i).randrange(200)}") for i in range(150)]


@pytest.mark.parametrize("links", [PATH + STAR + RING + ODD, RANDOM, ODD[:3], []])
def test_components(spark, links):
    assert result(components(spark.createDataFrame(links, "a string, b string"))) == brute(links)
