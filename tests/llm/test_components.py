import random

from brachis.llm.components import connected_components


def test_random_graphs_and_chains(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(300, 420)] + [(500, k) for k in range(501, 560)] + [(9, 9), (None, 4), (4, None)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {x: find(x) for x in list(root)}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0
