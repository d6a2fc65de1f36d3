import random

from starloom.llm.components import components


def test_components_match_union_find(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(80)]
    edges += [(None, 1), (5, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    found = components(spark.createDataFrame(edges, "src long, dst long")).collect()
    assert {r["node"]: r["component"] for r in found} == {n: find(n) for n in root}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "src long, dst long")).collect() == []
