import random

from ledgerline.llm.graph import connected_components


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, x) for x in range(200, 260)] + [(300, 300), (301, 302), (302, 301)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
