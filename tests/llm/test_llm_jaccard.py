import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from listingloom.llm import jaccard

GIVEN = jaccard.Settings()
SCHEMA = "doc_id long, text string"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))) if words else frozenset()


def brute(rows):
    """Component of each id by comparing all with all."""
    sets, root = defaultdict(set), {}
    for i, text in rows:
        sets[i].add(shingle_set(text))
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(
                x and y and 100 * len(x & y) >= 85 * len(x | y) for x in sets[a] for y in sets[b]
            ):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def keys(elements, cost, node):
    return jaccard.keys_of(np.unique(np.array(elements, np.uint64)), node << 5, cost, GIVEN)


def test_every_similar_pair_meets():
    """Sets of all sizes that are just similar enough share a bucket, even where many elements cost a lot."""
    pick = random.Random(1)
    cost = np.zeros(jaccard.CELLS, np.int64)
    cost[: jaccard.CELLS // 3] = 1000
    for size in [*range(6, 130), *range(130, 1500, 37)]:
        base = [pick.getrandbits(64) for _ in range(size)]
        for _ in range(3):
            lost = pick.randint(0, size * 15 // 100)
            added = pick.randint(0, max(0, (100 * (size - lost)) // 85 - size))
            other = pick.sample(base, size - lost) + [pick.getrandbits(64) for _ in range(added)]
            if 100 * (size - lost) < 85 * (size + added) or not lost + added:
                continue
            a, b = keys(base, cost, 1), keys(other, cost, 2)
            all_keys, nodes = np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])
            order = np.lexsort((nodes, all_keys))
            hubs, _ = jaccard.meetings(all_keys[order], nodes[order])
            assert len(hubs), (size, lost, added)


def test_expensive_segments_are_skipped():
    cost, sizes = np.array([9, 0, 9, 0, 0]), np.array([4, 4, 4, 4, 9])
    assert jaccard.allowances(cost, sizes, 3, short=False).tolist() == [0, 1, 0, 1, 1]
    both = jaccard.allowances(cost, sizes, 5, short=True)
    assert both.sum() == 5 and both[0] == both[2] == 0


def near_copies(pick, base, count, share):
    for _ in range(count):
        words = list(base)
        for at in range(len(words)):
            if pick.random() < share:
                words[at] = f"n{pick.randrange(10**6)}"
        yield " ".join(words)


def test_groups_equal_brute_force(spark):
    pick = random.Random(5)
    texts = []
    for size in (3, 4, 9, 11, 14, 20, 33, 60, 150, 400):
        base = [f"w{pick.randrange(10**6)}" for _ in range(size)]
        texts += [" ".join(base)] * 2
        texts += near_copies(pick, base, 8, 0.02)
        texts += [" ".join([*base, "tail"]), " ".join(base[1:]), " ".join(base).upper().replace("W", "W")]
    common = " ".join(f"c{n}" for n in range(30))
    texts += [common + " " + " ".join(f"u{pick.randrange(10**6)}" for _ in range(40)) for _ in range(60)]
    rows = list(enumerate(texts))
    pick.shuffle(rows)
    got = jaccard.similar_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows)
    assert all(r["n_shingles"] == len(shingle_set(dict(rows)[r["doc_id"]])) for r in got)


def test_large_family_in_blocks(spark):
    pick = random.Random(8)
    base = [f"w{n}" for n in range(60)]
    rows = list(enumerate(near_copies(pick, base, 150, 0.012)))
    small = jaccard.Settings(block=20)
    got = jaccard.similar_groups(spark.createDataFrame(rows, SCHEMA), small).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == brute(rows)


def test_odd_inputs(spark):
    long_text = " ".join(f"l{n}" for n in range(60_000))
    rows = [
        (None, "a b c d e"), (1, None), (2, ""), (3, " \t\n"), (4, "a b c d e"), (5, "A B C D E"), (5, "A B C D E"),
        (6, "É x y z w"), (7, "é x y z w"), (8, long_text), (9, long_text + " more"), (10, "one"), (11, "one"),
        (12, "a b c d e"),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", node int, print string")
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(df).collect()]
    assert len(got) == len(rows)
    assert set(got) == {
        (None, 2, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 2, 4), (5, 2, 4), (6, 2, 6), (7, 2, 7),
        (8, 59_997, 8), (9, 59_998, 8), (10, 1, 10), (11, 1, 10), (12, 1, 12),
    }
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 6, 7, 8, 10, 12]
    assert jaccard.similar_groups(df.where("1 = 0")).count() == 0


def test_strangers_of_one_passage_fall_apart_and_links_stay(spark):
    """Chains of documents that share passages are parted before they are compared; groups equal brute force."""
    pick = random.Random(11)
    passages = [[f"p{n}_{k}" for k in range(60)] for n in range(6)]
    rows = []
    for n in range(160):
        own = [f"d{n}_{k}" for k in range(pick.randint(60, 90))]
        shown = pick.sample(passages, 2)
        rows.append((len(rows), " ".join(shown[0] + own + shown[1])))
    for text in near_copies(pick, rows[0][1].split(), 12, 0.008):
        rows.append((len(rows), text))
    docs = spark.createDataFrame(rows, SCHEMA)
    given = jaccard.Settings(settled=1)
    own = docs.withColumn("within", F.lit(0).cast("long"))
    groups = docs.select("doc_id", "text")
    described = jaccard.describe(groups, given)
    sets = described.where("n_shingles > 0").groupBy("print", "node")
    groups = sets.agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size"))
    cost = np.zeros(jaccard.CELLS, np.int64)
    before = jaccard.members_of(jaccard.families(own, cost, given), groups)
    after = jaccard.met_again(docs, before, groups, cost, given, 1)
    largest = [df.groupBy("family").count().agg(F.max("count")).first()[0] for df in (before, after)]
    assert largest[1] < largest[0]
    wanted = brute(rows)
    for turns in (1, 3):
        found = jaccard.similar_groups(docs, jaccard.Settings(settled=1, turns=turns)).collect()
        assert {r["doc_id"]: r["component_id"] for r in found} == wanted


def test_blocks_by_elements(spark):
    """Families are cut by their elements as well as by their sets."""
    pick = random.Random(12)
    base = [f"b{k}" for k in range(200)]
    rows = list(enumerate([*near_copies(pick, base, 30, 0.006), *near_copies(pick, base[::-1], 5, 0.006)]))
    docs = spark.createDataFrame(rows, SCHEMA)
    found = jaccard.similar_groups(docs, jaccard.Settings(elements=1000, settled=4)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == brute(rows)
