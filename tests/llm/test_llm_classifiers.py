"""Language network, quality discriminant and licence classifier."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from listingloom.llm import language, licenses, quality

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "pf"], "cc": ["ño", "ció", "que", "ll"]}
SMALL = language.Settings(docs_per_lang=60, epochs=3, window=64)


def prose(pick, lang, words):
    return " ".join("".join(pick.choices(SYLLABLES[lang], k=pick.randint(1, 4))) for _ in range(words))


LONG = prose(random.Random(8), "bb", 40_000)


@pytest.fixture(scope="module")
def labelled(spark):
    pick = random.Random(2)
    rows = [(n, prose(pick, lang, pick.randint(5, 80)), lang) for n, lang in enumerate(list(SYLLABLES) * 80)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_gradients_equal_differences():
    pick = np.random.default_rng(0)
    windows, labels = pick.integers(0, 257, (6, 20)).astype(np.int16), pick.integers(0, 3, 6)
    given = language.Settings(window=20, filters=3, embedding=4, epochs=0)
    net = language.train(windows, labels, ["a", "b", "c"], given)
    for name in ("embedding", "filters", "bias", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    found = language.gradients(net, windows, labels)

    def loss():
        p = language.softmax(np.maximum(net.pooled(windows)[2], 0) @ net.out + net.out_bias)
        return -np.log(p[np.arange(6), labels]).mean()

    for name, gradient in found.items():
        weights = getattr(net, name)
        for at in zip(*np.nonzero(np.abs(gradient) > 1e-4)):
            at = tuple(at)
            old = weights[at]
            weights[at] = old + 1e-6
            up = loss()
            weights[at] = old - 1e-6
            down = loss()
            weights[at] = old
            assert (up - down) / 2e-6 == pytest.approx(gradient[at], rel=1e-2, abs=1e-5)
            break


def by_loops(net, text):
    """Mean probabilities of a text: every window, filter, position, byte and width by itself."""
    data, total = text.encode(), 0
    widths = [max(k for k in range(net.width) if net.mask.reshape(net.width, -1, net.filters.shape[1])[k, 0, f]) + 1
              for f in range(net.filters.shape[1])]
    shape = net.filters.reshape(net.width, -1, net.filters.shape[1])
    for at in range(0, len(data), net.window):
        own = list(data[at : at + net.window])
        cells = own + [language.PAD] * (net.window - len(own) + net.width - 1)
        hidden = []
        for f, width in enumerate(widths):
            answers = [
                sum(float(net.embedding[cells[p + k]] @ shape[k, :, f]) for k in range(width)) for p in range(net.window)
            ]
            hidden.append(max(0.0, max(answers) + float(net.bias[f])))
        powers = np.exp(np.array(hidden) @ net.out + net.out_bias)
        total = total + len(own) * powers / powers.sum()
    return total / len(data)


def test_inference_equals_loops(labelled):
    pick = random.Random(21)
    given = language.Settings(window=24, filters=3, embedding=4, epochs=2)
    windows = np.random.default_rng(1).integers(97, 123, (90, 24)).astype(np.int16)
    net = language.train(windows, np.arange(90) % 3, ["aa", "bb", "cc"], given)
    texts = [prose(pick, "cc", n) for n in (1, 2, 9, 30)] + ["x", "xyz" * 8, "xyz" * 16]
    for chunk in (2, 512):
        langs, scores = language.identify(texts, net, chunk)
        for text, lang, score in zip(texts, langs, scores):
            expected = by_loops(net, text)
            assert lang == net.langs[int(expected.argmax())] and score == pytest.approx(expected.max(), rel=1e-4)


def test_sample_of_many_languages(spark):
    """Each language has its share of the bounded sample, whatever the layout."""
    rows = [(n, f"word {n}", f"l{n % 40:02}" if n < 4000 else "rare") for n in range(4020)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    given = language.Settings(max_docs=200, docs_per_lang=60)
    first = language.sample(docs, given)
    assert first.equals(language.sample(docs.repartition(9), given))
    assert first.groupby("lang")["doc_id"].nunique().to_dict() == {**{f"l{n:02}": 4 for n in range(40)}, "rare": 4}


def test_language_of_held_out_and_odd_texts(spark, labelled):
    net = language.fit(labelled, SMALL)
    assert net.langs == ["aa", "bb", "cc"]
    odd = [(None, ""), (None, None), (None, " 12 !? \n"), (None, LONG), (None, prose(random.Random(9), "aa", 9))]
    texts = spark.createDataFrame(
        [(i, t) for i, t in odd], "doc_id long, text string"
    ).unionByName(labelled.select("doc_id", "text"))
    answers = texts.select("doc_id", "text", language.language_of(F.col("text"), net).alias("a")).collect()
    by_text = {r["text"]: (r["a"]["lang"], r["a"]["score"]) for r in answers}
    assert by_text[""] == by_text[None] == by_text[" 12 !? \n"] == ("und", 0.0)
    assert by_text[LONG][0] == "bb"
    assert all(0 <= score <= 1 for _, score in by_text.values())
    held = [r for r in labelled.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(held) > 20
    assert np.mean([by_text[r["text"]][0] == r["lang"] for r in held]) > 0.95


def test_language_is_learnt_from_training_rows_only(spark, labelled):
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    spoilt = labelled.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang")))
    assert language.fit(spoilt, SMALL).langs == ["aa", "bb", "cc"]
    assert (language.fit(spoilt, SMALL).out == language.fit(labelled.repartition(5), SMALL).out).all()


def test_language_without_labels(spark, labelled):
    for nothing in (labelled.withColumn("lang", F.lit(None).cast("string")), labelled.where("1 = 0")):
        net = language.fit(nothing, SMALL)
        rows = labelled.limit(3).select(language.language_of(F.col("text"), net).alias("a")).collect()
        assert {r["a"]["lang"] for r in rows} == {"und"}


def noisy(pick, n):
    words = [f"{pick.choice('ABC')}{pick.randrange(999)}{pick.choice('!#$')}" for _ in range(60)]
    return " ".join(words[:20] * 3) if n % 2 else " ".join(words)


@pytest.fixture(scope="module")
def judged(spark):
    pick = random.Random(4)
    rows = [(n, prose(pick, "aa", 90) if n % 3 else noisy(pick, n)) for n in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame([(n, int(n % 3 > 0), 0) for n in range(300)], "doc_id long, quality int, toxic int")


def test_discriminant_equals_direct_formula(judged):
    docs, labels = judged
    described = quality.describe_documents(docs)
    model = quality.fit(described, labels)
    rows = described.collect()
    x = np.array([r["features"] for r in rows])
    y = np.array([int(r["doc_id"] % 3 > 0) for r in rows])
    own = np.array([zlib.crc32(str(r["doc_id"]).encode()) % 5 != 0 for r in rows])
    centre, scale = x[own].mean(axis=0), np.maximum(x[own].std(axis=0), 1e-4)
    z, density = (x - centre) / scale, []
    for k in (0, 1):
        part = z[own & (y == k)]
        cov = np.cov(part.T, bias=True)
        cov = 0.9 * cov + 0.1 * max(np.trace(cov) / len(cov), 1e-6) * np.eye(len(cov))
        d = z - part.mean(axis=0)
        density.append(
            -0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
            - 0.5 * np.linalg.slogdet(cov)[1]
            + np.log(len(part) / own.sum())
        )
    expected = 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))
    assert np.allclose(model.scores(x), expected, atol=1e-6)
    assert ((expected > 0.3) == y)[~own].mean() > 0.95


def test_quality_of_odd_inputs(spark, judged):
    docs, labels = judged
    odd = [(1000, None), (1001, ""), (None, "ka lo"), (1002, "ka " * 90_000), (3, "ka lo"), (1003, "\U0001f600\x00 \n")]
    both = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("score", F.lit("x"))
    scored = quality.score_documents(both, labels).collect()
    assert len(scored) == 306
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scored)
    assert all(r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in scored)
    kept = quality.keep_good(both, labels)
    assert kept.columns == both.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored if r["predicted"]} - {None} | {
        r["doc_id"] for r in kept.collect() if r["doc_id"] is None
    }
    assert quality.score_documents(docs.where("1 = 0"), labels).count() == 0
    for few, expected in ((labels.where("1 = 0"), 0.5), (labels.where("quality = 1"), 1.0)):
        assert {r["score"] for r in quality.score_documents(docs.limit(5), few).collect()} == {expected}


def brute_license(line, model):
    words = licenses.python_words(line)
    if not set(words) & set(licenses.LEGAL):
        return None
    grams = licenses.python_grams(words)
    total = np.array(model.bias)
    for g in grams:
        total = total + np.array(model.features.get(g, np.zeros(len(total))))
    p = licenses.softmax((total / model.temperature)[None])[0]
    family = model.classes[p.argmax()]
    covers = [
        len(grams & own) / len(own)
        for t in licenses.TEMPLATES.get(family, ())
        for own in [licenses.python_grams(licenses.python_words(t))]
    ]
    if family == licenses.UNKNOWN or p.max() < 0.5 or max(covers) < licenses.LEAST_COVER:
        return None
    return family, round(float(p.max()), 6), round(max(covers), 6)


def test_licenses_equal_brute_force(spark):
    pick = random.Random(6)
    lines = [t for family in licenses.TEMPLATES.values() for t in family] + list(licenses.ORDINARY)
    texts = []
    for _ in range(150):
        own = []
        for line in pick.choices(lines, k=3):
            words = line.split()
            own.append(" ".join(w for w in words if pick.random() > 0.1) + pick.choice(["", " extra words", "!"]))
        texts.append("\n".join([prose(pick, "cc", 12), *own, ""]))
    texts += [None, "", "\n\n", "license " * 30_000, texts[0], "All rights reserved."]
    rows = [(n if n % 9 else None, t) for n, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, line string")
    model = licenses.train()
    got = sorted(
        (r["line"], r["family"], round(r["probability"], 6), round(r["cover"], 6)) for r in licenses.scan(df).collect()
    )
    expected = sorted(
        (n, *found)
        for _, t in rows
        for n, line in enumerate((t or "").split("\n"))
        for found in [brute_license(line, model)]
        if found
    )
    assert got == expected and len(got) > 200
    assert licenses.scan_documents(df).count() == len({i for i, _ in rows})
    assert licenses.scan(df.where("1 = 0")).count() == 0


def test_each_template_is_found_and_ordinary_sentences_are_not(spark):
    stated = [(f, t) for f, own in licenses.TEMPLATES.items() for t in own] + [("", s) for s in licenses.ORDINARY]
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(stated)], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licenses.scan_documents(df).collect()}
    assert sum(got[n] == f for n, (f, _) in enumerate(stated)) >= len(stated) - 2


def test_wrapped_notices_headings_and_tags_are_found(spark):
    import textwrap

    def wrapped(family, marks="", width=70):
        text = max(licenses.TEMPLATES[family], key=len)
        return "\n".join(marks + x for x in ["Some file.", "", *textwrap.wrap(text, width), "", "Code goes on here."])

    cases = [(f, wrapped(f, m, w)) for f in ("GPL-3.0", "GPL-2.0", "BSD", "MIT") for m, w in (("", 70), (" * ", 60), ("# ", 40))]
    cases += [
        ("MIT", "MIT License\n\nCopyright (c) 2020 A. Person"),
        ("Apache-2.0", "                Apache License\n          Version 2.0, January 2004\n".replace(", January 2004", "")),
        ("Apache-2.0", "# Licensed under the Apache License, Version 2.0"),
        ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007"),
        ("GPL-2.0", "// SPDX-License-Identifier: GPL-2.0-or-later"),
        ("BSD,MIT", "# SPDX-License-Identifier: (MIT OR BSD-3-Clause)"),
        ("", "She needs a license\nto drive and permission\nto leave, and the rights\nwere reserved for later."),
    ]
    df = spark.createDataFrame([(n, t) for n, (_, t) in enumerate(cases)], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licenses.scan_documents(df).collect()}
    assert [got[n] for n in range(len(cases))] == [f for f, _ in cases]
