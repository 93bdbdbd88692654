"""Ball-tree search and forest near duplicates against brute force."""

import math

import numpy as np
import pytest

from listingloom.llm import forest, topk

SCHEMA = "vec_id long, embedding array<float>"
ODD = [
    (9001, None), (9002, [0.0, None, 1.0]), (9003, [float("nan")] * 3), (9004, [float("inf"), 0.0, 0.0]), (None, [1.0, 1.0, 1.0]),
]


def brute_top(rows, is_query, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            own = [math.floor(64 * x) for x in np.array(v, np.float32).astype(float)]
            vectors[i] = min(vectors.get(i, own), own)
    out = []
    for q in filter(is_query, vectors):
        scored = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [8192, 90])
def test_top_k_equals_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 10)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    pick = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(pick.normal(size=(400, 3)).round(1))]
    rows += [(500 + i, [0.5, 0.5, 0.5]) for i in range(60)] + [(600, [1.0, 2.0]), (620, []), (7, [9.0, 9.0, 9.0])] + ODD
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", score string")
    got = topk.top_k(df, lambda i: i % 20 == 0, k=7)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, lambda i: i % 20 == 0, 7)


def test_top_k_with_few_rows(spark):
    rows = [(0, [1.0]), (1, [2.0]), (20, [3.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = topk.top_k(df, lambda i: i % 20 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, lambda i: i % 20 == 0, 20)
    assert topk.top_k(df.where("1 = 0"), lambda i: i % 20 == 0).count() == 0


def test_large_whole_numbers_stay_exact():
    a = np.array([[2.0**30, 3.0]])
    assert topk.exact_products(a, a)[0, 0] == 2**60 + 9


def brute_groups(rows, threshold=0.9):
    good = [
        (i, np.array(v, float))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    root = {i: i for i, _ in good}
    links = [0] * len(good)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, v) in enumerate(good):
        for b in range(a):
            j, w = good[b]
            if v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= threshold:
                links[a] += 1
                links[b] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    out = [(i, n, find(i), i == find(i)) for (i, _), n in zip(good, links)]
    rest = [i for i, v in rows if i not in root or i is None]
    return out + [(i, 0, i, i is not None) for i in rest]


def cloud(pick, size, groups, copies, noise):
    rows = [v for v in pick.normal(size=(size, 16))]
    for _ in range(groups):
        centre = pick.normal(size=16)
        rows += [centre + noise * pick.normal(size=16) for _ in range(copies)]
    return [(i, np.float32(v).tolist()) for i, v in enumerate(rows)]


def test_forest_finds_groups_and_copies(spark):
    pick = np.random.default_rng(5)
    rows = cloud(pick, 700, 20, 6, 0.05)
    rows += [(2000 + i, rows[0][1]) for i in range(40)] + [(3000, [0.0] * 16), (2000, rows[0][1])] + ODD[:1] + ODD[3:4]
    rows = [(i, v) for i, v in rows] + [(None, rows[1][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", node int")
    got = [tuple(r) for r in forest.near_duplicates(df, forest.Settings(leaf=100)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    expected = brute_groups(rows)
    assert len(got) == len(rows)
    found, true = sum(r[1] for r in got), sum(r[1] for r in expected)
    assert 0.98 * true <= found <= true
    same = sum(a == b for a, b in zip(sorted(got, key=key), sorted(expected, key=key)))
    assert same >= 0.97 * len(rows)


def test_tight_group_in_blocks(spark):
    pick = np.random.default_rng(6)
    rows = cloud(pick, 100, 1, 300, 0.03)
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in forest.near_duplicates(df, forest.Settings(leaf=40, block=64)).collect())
    assert got == sorted(brute_groups(rows))


def test_no_rows_and_no_usable_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    assert forest.near_duplicates(df.where("1 = 0")).count() == 0
    got = forest.near_duplicates(df.where("vec_id is not null")).collect()
    assert sorted(tuple(r) for r in got) == [(i, 0, i, True) for i in (9001, 9002, 9003, 9004)]


def made_rows(count, dim, shift, seed):
    pick = np.random.default_rng(seed)
    rows = pick.normal(size=(count, dim)) + shift * np.sqrt(dim) * np.eye(dim)[0]
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@pytest.mark.parametrize("shift", [0.0, 1.0])
@pytest.mark.parametrize("rows", [20_000, 200_000, 1_000_000])
def test_partners_above_the_threshold_meet_at_any_size(rows, shift):
    """Cosine 0.905, centred vectors and such of mean cosine 0.5; the sample is what the operator collects."""
    units = made_rows(6_000, 64, shift, 3)
    given = forest.Settings()
    trees, blocks = forest.grow(units[:4096], rows, given)
    fresh = units[4096:]
    pairs = forest.partners(fresh, 0.905, np.random.default_rng(9))
    met, copies = np.zeros(len(fresh), bool), 0
    for tree in trees:
        met |= forest.meet(tree, fresh, pairs)
        copies += sum(len(reached) for _, reached in tree.leaves_of(fresh))
    assert met.mean() >= 0.97
    print(rows, shift, len(trees), met.mean(), copies / len(fresh))


def test_leaves_stay_small_at_a_hundred_million_rows():
    units = made_rows(8_192, 32, 0.0, 4)
    trees, blocks = forest.grow(units, 10**8, forest.Settings(trees=2, most_trees=2))
    assert blocks.max() == 1 and len(blocks) > 10**5
    held = sum(x.nbytes for t in trees for x in (t.directions, t.cuts, t.low, t.high, t.levels, t.further, t.centres))
    assert held < 64 << 20
    fresh = made_rows(20_000, 32, 0.0, 5)
    for tree in trees:
        sizes = [len(reached) for _, reached in tree.leaves_of(fresh)]
        # As a share of all rows: the largest leaf stands for a few thousand rows.
        assert max(sizes) / len(fresh) * 10**8 < 60_000
        assert sorted(np.unique(np.concatenate([r for _, r in tree.leaves_of(fresh)]))) == list(range(len(fresh)))


def test_roots_of_chains_and_groups():
    pick = np.random.default_rng(7)
    for count in (0, 1, 2, 50, 400):
        names = pick.permutation(10 * count)[:count]
        chain = pick.permutation(count)
        linked = np.zeros((count, count), bool)
        linked[chain[:-1], chain[1:]] = pick.random(max(count - 1, 0)) < 0.9
        linked |= linked.T
        expected = names.copy()
        for _ in range(count):
            expected = np.minimum(expected, np.where(linked, expected[None, :], 10**9).min(axis=1, initial=10**9))
        assert (forest.local_roots(linked, names) == expected).all()
