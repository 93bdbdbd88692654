import pytest
from pyspark.sql import functions as F

from listingloom.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def rows_of(count, sources=("a", "b", "c", None)):
    return [(n, "w " * (n * 7 % 40), sources[n * n % len(sources)] if n % 3 else sources[0]) for n in range(count)]


def brute_targets(sizes, most=3):
    """Shares by pouring: what is above the brim is poured on, until nothing is."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    target, left, open_sources = dict.fromkeys(sizes, 0.0), float(sum(sizes.values())), set(sizes)
    while left > 1e-9 and open_sources:
        total = sum(weight[s] for s in open_sources)
        poured = {s: target[s] + left * weight[s] / total for s in open_sources}
        left = 0.0
        for s, value in poured.items():
            left += max(0.0, value - most * sizes[s])
            target[s] = min(value, most * sizes[s])
        open_sources = {s for s in open_sources if target[s] < most * sizes[s] - 1e-9}
    return target


def test_targets_share_all_words_and_stop_at_three_times(spark):
    sizes = {"a": 10, "b": 4000, "c": 5, "d": 300, "e": 900, None: 7}
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    expected = brute_targets(sizes)
    for source in sizes:
        assert got[source] == pytest.approx(expected[source])
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_taken_words_come_near_targets_and_reruns_agree(spark):
    docs = spark.createDataFrame(rows_of(600), SCHEMA)
    first = mixing.mix_documents(docs)
    again = mixing.mix_documents(docs.repartition(7))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect()))
    assert first.where("taken > 3 * size or taken % nullif(size, 0) <> 0").count() == 0
    joined = first.join(docs.select("doc_id", "source"), "doc_id")
    for row in joined.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("target")).collect():
        assert abs(row["t"] - row["target"]) <= 20
    assert mixing.repeat_documents(docs).count() == first.agg(F.sum("copies")).first()[0]


def test_weights_change_the_chances_not_the_total(spark):
    rows = [(n, "a", 10, 9.0 if n < 200 else 1.0) for n in range(400)] + [(n, "b", 10, 1.0) for n in range(400, 500)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, liked double")
    targets = spark.createDataFrame([("a", 4000, 1500.0), ("b", 1000, 500.0)], "source string, source_size long, target double")
    mixed = mixing.mix(sized, targets, weight="liked").collect()
    taken = lambda keep: sum(r["taken"] for r in mixed if keep(r))
    assert taken(lambda r: r["source"] == "a") == 1500 and taken(lambda r: r["source"] == "b") == 500
    assert taken(lambda r: r["doc_id"] < 200) > 1200


def test_odd_inputs(spark):
    rows = [
        (None, "one two", "a"), (1, None, "a"), (2, "", None), (3, "x " * 50_000, "a"), (4, "tie", "b"), (4, "tie", "b"),
        (5, " ", None),
    ]
    docs = spark.createDataFrame([(*r, 9, 8) for r in rows], SCHEMA + ", size string, target string")
    got = mixing.mix_documents(docs).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["size"] for r in got} == {None: 2, 1: 0, 2: 0, 3: 50_000, 4: 1, 5: 1}
    assert set(mixing.repeat_documents(docs).columns) == set(docs.columns)
    assert mixing.mix_documents(docs.where("1 = 0")).count() == 0
    words = spark.createDataFrame([(1, " ", "a")], SCHEMA)
    assert [(r["target"], r["taken"]) for r in mixing.mix_documents(words).collect()] == [(0.0, 0)]


def test_ranks_of_any_source_spread_over_the_cells(spark):
    """Stopped sources, sources of tiny and of large shares, certain rows and rows without a chance."""
    docs = spark.range(20_000).selectExpr("id as doc_id", "'a' as source", "10L as size", "if(id % 2 = 0, 0.0, 1e9) as liked")
    for target in (600_000.0, 10.0, 199_990.0, 250_000.0):
        targets = spark.createDataFrame([("a", 200_000, target)], "source string, source_size long, target double")
        for weight in (None, "liked"):
            cells = mixing.ranks(docs, targets, "mix", weight).groupBy("__cell").count()
            assert cells.agg(F.max("count")).first()[0] < 40
            taken = mixing.mix(docs, targets, weight=weight).agg(F.sum("taken")).first()[0]
            assert abs(taken - target) <= 5


def test_columns_of_the_new_names_give_way(spark):
    sized = spark.createDataFrame([(1, "a", 5, 0.5, "x")], "doc_id long, source string, size long, target double, taken string")
    targets = mixing.source_targets(sized)
    for weight in (None, "target"):
        row = mixing.mix(sized, targets, weight=weight).collect()
        assert [r.asDict() for r in row] == [
            {"doc_id": 1, "source": "a", "size": 5, "source_size": 5, "target": 5.0, "copies": 1, "taken": 5}
        ]
