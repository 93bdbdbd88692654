"""The pipeline's stages against plain recomputation of their decisions."""

import random
from collections import Counter

from pyspark.sql import functions as F
from test_llm_jaccard import brute

import corpus_pipeline as pipeline
from listingloom.llm import language, mixing, quality
from listingloom.storage import stage


def test_stages_and_run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [len(s) for s in pipeline.STAGES] == [2] * 5
    seen = {"start": docs}
    for name, step in pipeline.STAGES:
        docs = seen[name] = stage(step(spark, docs, sf_dir), f"test-{name}")
    columns = seen["start"].columns
    assert all(seen[name].columns == columns for name, _ in pipeline.STAGES[:-1])
    rows = {name: [tuple(r) for r in df.collect()] for name, df in seen.items()}

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(quality.describe_documents(seen["start"]), labels)
    good = [r for r in rows["start"] if model.scores(quality.np.array([quality.describe(r[1])]))[0] >= quality.THRESHOLD]
    assert sorted(rows["quality"]) == sorted(good)

    net = language.fit(seen["quality"])
    langs, scores = language.identify([r[1] for r in good], net)
    named = [
        r for r, lang, s in zip(good, langs, scores) if lang != language.UNKNOWN and s >= pipeline.LEAST_LANGUAGE_SCORE
    ]
    assert sorted(rows["language"]) == sorted(named)

    groups = brute([(r[0], r[1]) for r in named])
    one = [r for r in named if groups[r[0]] == r[0]]
    assert sorted(rows["near_duplicates"]) == sorted(one)

    copies = {r["doc_id"]: r["copies"] for r in mixing.mix_documents(seen["near_duplicates"]).collect()}
    assert Counter(rows["mix"]) == Counter({r: copies[r[0]] for r in one if copies[r[0]]})

    whole = {r["doc_id"]: r["n"] for r in seen["packing"].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    sizes = {r["doc_id"]: r["doc_tokens"] for r in seen["packing"].collect()}
    assert whole == {i: sizes[i] * copies[i] for i in sizes} and set(whole) == {r[0] for r in rows["mix"]}

    ran = pipeline.run(spark, sf_dir)
    assert ran.columns == seen["packing"].columns
    assert ran.agg(F.sum("length")).first() == seen["packing"].agg(F.sum("length")).first()


def test_stages_take_extra_columns_nulls_and_no_rows(spark, sf_dir):
    rows = [(None, None, None, None, None, 1), (5, "", "en", "a", 0, 2), (6, "word word", None, None, 9, 3)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score long"
    )
    for given in (docs, docs.where("1 = 0")):
        for name, step in pipeline.STAGES:
            given = stage(step(spark, given, sf_dir), f"odd-{name}")
            assert name == "packing" or given.columns == docs.columns


def firsts_of_near_copies(rows, words=5, percent=80):
    """Smallest id of each group, by comparing all with all."""
    sets = {}
    for i, text in rows:
        own = text.split()
        sets[i] = {tuple(own[at : at + words]) for at in range(max(len(own) - words + 1, 1))}
    group = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = {i: new if g == old else g for i, g in group.items()}
    return {i for i, g in group.items() if i == g}


def test_near_copies_by_five_words_and_four_fifths(spark, sf_dir):
    pick = random.Random(3)
    rows = []
    for n in range(12):
        text = [f"w{pick.randrange(10**6)}" for _ in range(600)]
        rows.append((len(rows), " ".join(text)))
        for edits in (13, 14):  # 0.803 and 0.788 of the shingles
            copy = list(text)
            for k in range(edits):
                copy[20 + 40 * k] = f"x{pick.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
        for added in (110, 145, 160):
            rows.append((len(rows), " ".join([*text, *(f"y{pick.randrange(10**6)}" for _ in range(added))])))
    rows += [(100 + n, " ".join(f"z{k}" for k in range(9 + n))) for n in range(6)]
    docs = spark.createDataFrame([(i, t, "en", "a") for i, t in rows], "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in pipeline.one_of_each(spark, docs, sf_dir).collect()}
    assert kept == firsts_of_near_copies(rows)
    assert kept != firsts_of_near_copies(rows, 4, 85)
