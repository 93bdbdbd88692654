import random

import pytest

from listingloom.llm.components import components


def brute(links):
    root = {}
    for pair in links:
        for x in pair:
            root.setdefault(x, x)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root if find(x) != x}


def random_links(nodes, count, seed):
    pick = random.Random(seed)
    return [(pick.randrange(nodes), pick.randrange(nodes)) for _ in range(count)]


@pytest.mark.parametrize(
    "links",
    [
        random_links(200, 150, 1),
        random_links(60, 300, 2),
        [(n, n + 1) for n in range(300)],
        [(0, n) for n in range(1, 200)] + [(500, n) for n in range(100, 150)],
        [(n, 1000 - n) for n in range(400)] + [(n * 7 % 400, n * 11 % 400) for n in range(300)],
        [(5, 5)],
    ],
)
def test_components_equal_brute_force(spark, links):
    df = spark.createDataFrame([*links, (None, 3), (4, None)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == brute([p for p in links if p[0] != p[1]])


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
