"""Licence statements in documents by a trained paragraph classifier.

Lines are classified each for itself; then runs of words inside paragraphs (lines up
to a blank one) are, so that a notice wrapped over lines is found, and headings and
SPDX identifiers are looked up. Logistic regression over its word n-grams (one to five
words) names a licence family or none; scores are calibrated by a temperature, and
what is not likely enough counts as unknown. A prediction stands only if the line
also holds most of the n-grams of one of the family's template sentences.

Only n-grams that contain a legal word are features, so a line without one is
unknown by construction and is put aside by a look at its words. The lines that are
left are classified once per distinct wording, however many documents repeat it.
Training is numpy on the templates; scoring is joins and sums only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listingloom.storage import stage

UNKNOWN = "unknown"
LEAST_PROBABILITY = 0.5
LEAST_COVER = 0.5
LONGEST_GRAM = 5
#: Words of the runs of a paragraph, which overlap by half. The longest template has less than half of the largest.
RUNS = (16, 32, 96)
#: Of related families a paragraph's runs state those whose cover comes this near to the best one's.
NEAR_BEST = 0.9
#: Words are runs of letters and digits, joined by single dots and hyphens.
WORDS = r"[\p{L}\p{N}]+(?:[.-][\p{L}\p{N}]+)*"

# Notices by which well-known public licences are stated, by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    ),
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or any later "
        "version.",
        "Licensed under GPL version 3 or later.",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or any later "
        "version.",
        "Licensed under GPL version 2 or later.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
    ),
    "AGPL-3.0": (
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or any later version.",
    ),
    "BSD": (
        "Licensed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ),
    "ISC": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Released under the Unlicense.",
    ),
    "CC0-1.0": (
        "To the extent possible under law, the author has waived all copyright and related rights to this work.",
        "Licensed under CC0 1.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-ND": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
}
#: Families that share most of their wording, so that a run cut short fits several.
KIN = {
    **dict.fromkeys(("GPL-2.0", "GPL-3.0", "LGPL", "AGPL-3.0"), "GNU"),
    **dict.fromkeys(("MIT", "ISC"), "permission"),
    **dict.fromkeys(("CC-BY", "CC-BY-SA", "CC-BY-NC", "CC-BY-ND"), "CC"),
}
#: How a heading names a family, and its SPDX identifiers, as patterns. A blank stands for a gap between words.
TITLES = {
    "Apache-2.0": (r"apache license version 2\.0|apache license 2\.0|apache 2\.0", r"apache-2\.0"),
    "MIT": ("(?:the )?mit license", "mit"),
    "GPL-3.0": ("gnu general public license(?: v3| version 3(?: 29 june 2007)?)", r"gpl-3\.0(?:-only|-or-later|\+)?"),
    "GPL-2.0": ("gnu general public license(?: v2| version 2(?: june 1991)?)", r"gpl-2\.0(?:-only|-or-later|\+)?"),
    "LGPL": ("gnu (?:lesser|library) general public license(?: version [0-9.]+[^\n]*)?", r"lgpl-[0-9.]+(?:-only|-or-later|\+)?"),
    "AGPL-3.0": ("gnu affero general public license(?: version 3[^\n]*)?", r"agpl-3\.0(?:-only|-or-later|\+)?"),
    "BSD": ("(?:the )?(?:new |simplified )?bsd(?: [234][ -]clause)? license", "(?:0bsd|bsd-[1-4]-clause)"),
    "MPL-2.0": (r"mozilla public license(?: version)? 2\.0", r"mpl-2\.0"),
    "ISC": ("(?:the )?isc license", "isc"),
    "Unlicense": ("the unlicense", "unlicense"),
    "CC0-1.0": (r"cc0 1\.0 universal", r"cc0-1\.0"),
    "CC-BY": (r"creative commons attribution [1-4]\.0 international(?: public license)?", r"cc-by-[1-4]\.[05]"),
    "CC-BY-SA": (r"creative commons attribution[ -]sharealike [1-4]\.0 international(?: public license)?", r"cc-by-sa-[1-4]\.[05]"),
    "CC-BY-NC": (r"creative commons attribution[ -]noncommercial [1-4]\.0 international(?: public license)?", r"cc-by-nc-[1-4]\.[05]"),
    "CC-BY-ND": (r"creative commons attribution[ -]noderivatives [1-4]\.0 international(?: public license)?", r"cc-by-nd-[1-4]\.[05]"),
}
#: Words that licence statements do not go without.
LEGAL = (
    "license licensed licence licenced licenses unlicense copyright copyrighted rights reserved apache gnu gpl lgpl agpl "
    "bsd isc mozilla mpl cc cc0 redistribute redistribution distributed permission permitted warranty warranties "
    "waived unencumbered proprietary confidential unauthorized endorse "
    "commons attribution attribution-sharealike attribution-noncommercial attribution-noderivatives"
).split()
#: Sentences with legal words that state no licence.
ORDINARY = (
    "He lost his driving license last year.",
    "The shop needs a license to sell wine.",
    "She asked for permission to leave the room.",
    "A table was reserved for two.",
    "Civil rights and human rights were debated.",
    "The copyright of the picture is disputed.",
    "Food was distributed among the guests under the tree.",
    "The washing machine has a two year warranty.",
    "He is licensed to practise law in this state.",
    "The helicopter is called Apache.",
    "The bands were endorsed and the news was confidential.",
    "Smoking is not permitted in the rooms.",
    "Please read the license before you install.",
    "Copyright law applies to all works.",
    "License plates are made of metal.",
    "The rights to the film were sold.",
)


def python_words(line: str) -> list[str]:
    return re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", line.lower())


def python_grams(words: list[str]) -> set[str]:
    return {
        " ".join(words[at : at + n]) for n in range(1, LONGEST_GRAM + 1) for at in range(len(words) - n + 1)
    }


@dataclass(frozen=True)
class Model:
    """Weights per feature and class (the last class is unknown), biases and the calibrating temperature."""

    classes: tuple[str, ...]
    features: dict[str, tuple[float, ...]]
    bias: tuple[float, ...]
    temperature: float


def _variants(random: np.random.Generator, words: list[str], count: int) -> list[list[str]]:
    """A wording with up to a fifth of its words lost and with strange words around it."""
    out = [words]
    for _ in range(count):
        kept = [w for w in words if random.random() > 0.2 * random.random()]
        around = [f"word{random.integers(10**6)}" for _ in range(random.integers(0, 6))]
        cut = int(random.integers(0, len(around) + 1))
        out.append(around[:cut] + kept + around[cut:])
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@cache
def train(seed: int = 5, copies: int = 16, steps: int = 150) -> Model:
    """Fit on variants of the templates; every fourth example is held back to calibrate.

    The unknown class learns from ordinary sentences, from scattered words of the
    templates and from lines without any feature.
    """
    random = np.random.default_rng(seed)
    classes = (*TEMPLATES, UNKNOWN)
    legal = set(LEGAL)
    examples, labels = [], []
    for label, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            for words in _variants(random, python_words(template), copies):
                examples.append(python_grams(words))
                labels.append(label)
    every = sorted({w for family in TEMPLATES.values() for t in family for w in python_words(t)})
    for sentence in ORDINARY:
        for words in _variants(random, python_words(sentence), copies):
            examples.append(python_grams(words))
            labels.append(len(classes) - 1)
    for n in range(300):
        examples.append(python_grams([str(w) for w in random.choice(every, n % 4)]))
        labels.append(len(classes) - 1)
    vocabulary = sorted(
        {
            g
            for family in TEMPLATES.values()
            for t in family
            for g in python_grams(python_words(t))
            if legal & set(g.split(" "))
        }
    )
    place = {g: n for n, g in enumerate(vocabulary)}
    x = np.zeros((len(examples), len(vocabulary)))
    for row, grams in enumerate(examples):
        x[row, [place[g] for g in grams if g in place]] = 1
    y = np.eye(len(classes))[labels]
    held = np.arange(len(examples)) % 4 == 3
    weights, bias = np.zeros((len(vocabulary), len(classes))), np.zeros(len(classes))
    own_x, own_y = x[~held], y[~held]
    speed = [np.zeros_like(weights), np.zeros_like(bias)]
    for _ in range(steps):
        error = (softmax(own_x @ weights + bias) - own_y) / len(own_x)
        speed[0] = 0.9 * speed[0] - 2.0 * (own_x.T @ error + 1e-5 * weights)
        speed[1] = 0.9 * speed[1] - 2.0 * error.sum(axis=0)
        weights, bias = weights + speed[0], bias + speed[1]
    logits = x[held] @ weights + bias
    truth = y[held].argmax(axis=1)
    temperatures = np.geomspace(0.25, 4, 41)
    losses = [-np.log(softmax(logits / t)[np.arange(len(truth)), truth] + 1e-12).mean() for t in temperatures]
    return Model(
        classes,
        {g: tuple(float(v) for v in weights[n]) for g, n in place.items()},
        tuple(float(b) for b in bias),
        float(temperatures[int(np.argmin(losses))]),
    )


def words_of(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(WORDS), F.lit(0))


def _runs(words: Column, length: int) -> Column:
    """All runs of ``length`` words; the shifted lists are made once, not per run."""
    count = F.greatest(F.size(words) - (length - 1), F.lit(0))
    shifted = F.arrays_zip(*[F.slice(words, F.lit(k + 1), count).alias(f"w{k}") for k in range(length)])
    return F.transform(shifted, lambda run: F.concat_ws(" ", *[run[f"w{k}"] for k in range(length)]))


def grams_of(words: Column) -> Column:
    """The distinct n-grams of a list of words."""
    return F.array_distinct(F.concat(words, *[_runs(words, n) for n in range(2, LONGEST_GRAM + 1)]))


def _legal_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text where some part of a legal word occurs."""
    # A cheap look at the whole text first: every legal word shows up when it is cut at all other characters.
    rough = F.split(F.lower("text"), "[^a-z0-9]+")
    parts = sorted({p for w in LEGAL for p in w.split("-")})
    return docs.select("doc_id", "text").where(F.arrays_overlap(rough, F.array(*map(F.lit, parts))))


def legal_lines(docs: DataFrame) -> DataFrame:
    """doc_id, line number and words of every line with a legal word; NULL text has none."""
    legal = F.array(*map(F.lit, LEGAL))
    lines = _legal_texts(docs).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    return lines.select("doc_id", "line", words_of(F.col("content")).alias("words")).where(
        F.arrays_overlap("words", legal)
    )


def _tables(spark: SparkSession, model: Model) -> tuple[DataFrame, DataFrame]:
    """Weights by n-gram, and n-grams by template with the template's size. Both as large as the templates."""
    columns = [f"w{n}" for n in range(len(model.classes))]
    weights = spark.createDataFrame(
        [(g, *w) for g, w in model.features.items()], ", ".join(["gram string", *[f"{c} double" for c in columns]])
    )
    grams = [
        (family, number, g, len(own))
        for family, texts in TEMPLATES.items()
        for number, t in enumerate(texts)
        for own in [python_grams(python_words(t))]
        for g in sorted(own)
    ]
    return weights, spark.createDataFrame(grams, "family string, template int, gram string, grams int")


def classify(wordings: DataFrame, model: Model) -> DataFrame:
    """wording, family, probability and cover of each distinct ``wording`` (words joined by blanks) that states a licence."""
    weights, templates = _tables(wordings.sparkSession, model)
    grams = wordings.select("wording", F.explode(grams_of(F.split("wording", " "))).alias("gram"))
    columns = [f"w{n}" for n in range(len(model.classes))]
    sums = grams.join(weights, "gram", "inner").groupBy("wording").agg(*[F.sum(c).alias(c) for c in columns])
    logits = F.array(*[(F.col(c) + b) / model.temperature for c, b in zip(columns, model.bias)])
    scored = sums.select("wording", logits.alias("logits")).select(
        "wording",
        (F.array_position("logits", F.array_max("logits")) - 1).cast("int").alias("best"),
        (
            1
            / F.aggregate(
                F.transform("logits", lambda x: F.exp(x - F.array_max("logits"))), F.lit(0.0), lambda a, x: a + x
            )
        ).alias("probability"),
    )
    names = F.array(*map(F.lit, model.classes))
    named = scored.select("wording", F.element_at(names, F.col("best") + 1).alias("family"), "probability").where(
        (F.col("family") != UNKNOWN) & (F.col("probability") >= LEAST_PROBABILITY)
    )
    cover = (
        grams.join(templates, "gram", "inner")
        .groupBy("wording", "family", "template")
        .agg((F.count(F.lit(1)) / F.first("grams")).alias("cover"))
        .groupBy("wording", "family")
        .agg(F.max("cover").alias("cover"))
    )
    return named.join(cover, ["wording", "family"], "inner").where(F.col("cover") >= LEAST_COVER)


def scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, line, family, probability and cover of every line of ``docs`` that states a licence.

    Repeated rows are scanned each for itself; NULL and empty texts have no lines.
    Columns other than doc_id and text are ignored.
    """
    found = legal_lines(docs).select("doc_id", "line", F.array_join("words", " ").alias("wording"))
    lines = stage(found, "license-lines")  # The texts are read once for it.
    known = classify(lines.select("wording").distinct(), model or train())
    return lines.join(known, "wording", "inner").select("doc_id", "line", "family", "probability", "cover")


def legal_runs(docs: DataFrame) -> DataFrame:
    """doc_id, paragraph and words of the overlapping runs with a legal word in paragraphs of several lines."""
    legal = F.array(*map(F.lit, LEGAL))
    # Comment marks are no words, so a line of marks alone is blank.
    paragraphs = _legal_texts(docs).select(
        "doc_id", F.posexplode(F.split("text", r"\n[^\p{L}\p{N}]*\n")).alias("paragraph", "content")
    )
    worded = paragraphs.where(F.trim(F.col("content")).contains("\n")).select(
        "doc_id", "paragraph", words_of(F.col("content")).alias("all")
    )
    count = F.size("all")

    def cut(size: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(count - size // 2 - 1, F.lit(0)), F.lit(size // 2))
        return F.transform(starts, lambda at: F.slice("all", at + 1, size))

    runs = [cut(size) for size in RUNS]
    return (
        worded.where(F.arrays_overlap("all", legal))
        .select("doc_id", "paragraph", F.explode(F.array_distinct(F.concat(*runs))).alias("words"))
        .where(F.arrays_overlap("words", legal))
    )


def scan_runs(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """doc_id, family, probability and cover of the notices that runs of words state, one for each doc_id and family."""
    found = legal_runs(docs).select("doc_id", "paragraph", F.array_join("words", " ").alias("wording"))
    runs = stage(found, "license-runs")
    known = classify(runs.select("wording").distinct(), model or train())
    kin = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in KIN.items() for x in pair]), F.col("family")), "family")
    best = (
        runs.join(known, "wording", "inner")
        .groupBy("doc_id", "paragraph", "family")
        .agg(F.max(F.struct("cover", "probability")).alias("best"))
        .withColumn("most", F.max("best.cover").over(Window.partitionBy("doc_id", "paragraph", kin)))
        .where(F.col("best.cover") >= NEAR_BEST * F.col("most"))
    )
    return best.groupBy("doc_id", "family").agg(F.max("best").alias("best")).select(
        "doc_id", "family", "best.probability", "best.cover"
    )


def scan_titles(docs: DataFrame) -> DataFrame:
    """doc_id, family, probability and cover (both 1) of the families that a heading or an SPDX tag names."""
    gap = r"[^\p{L}\p{N}]+"
    named = []
    for family, (title, spdx) in TITLES.items():
        heading = rf"(?im)^[^\p{{L}}\p{{N}}\n]*(?:(?:licensed|released) under (?:the )?)?(?:{title})[^\p{{L}}\p{{N}}\n]*$"
        tag = rf"(?im)spdx-license-identifier:(?:[^\n]*[\s(])?{spdx}(?![\w.+-])"
        states = F.col("text").rlike(heading.replace(" ", gap)) | F.col("text").rlike(tag)
        named.append(F.when(states, F.lit(family)))
    found = _legal_texts(docs).select("doc_id", F.explode(F.array_compact(F.array(*named))).alias("family"))
    return found.select("doc_id", "family", F.lit(1.0).alias("probability"), F.lit(1.0).alias("cover")).distinct()


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per doc_id: families (sorted, joined by a comma), lines that state them, and the weakest evidence.

    A family that no line states by itself counts as one line if a wrapped notice, a heading or a tag does.
    Documents without a licence have an empty ``families``, 0 lines and NULL
    evidence. Repeated ids and rows without id are one row each.
    """
    found = stage(scan(docs).select("doc_id", "family", "probability", "cover"), "license-found")
    more = (
        scan_runs(docs)
        .unionByName(scan_titles(docs))
        .groupBy("doc_id", "family")
        .agg(F.max(F.struct("cover", "probability")).alias("best"))
        .select("doc_id", "family", "best.probability", "best.cover")
    )
    stated = found.select(F.col("doc_id").alias("__id"), F.col("family").alias("__family")).distinct()
    more = more.join(stated, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("family") == F.col("__family")), "left_anti")
    nothing = docs.select(
        "doc_id",
        F.lit(None).cast("string").alias("family"),
        F.lit(None).cast("double").alias("probability"),
        F.lit(None).cast("double").alias("cover"),
    )
    return (
        nothing.unionByName(found)
        .unionByName(more)
        .groupBy("doc_id")
        .agg(
            F.array_join(F.array_sort(F.collect_set("family")), ",").alias("families"),
            F.count("family").alias("license_lines"),
            F.min("probability").alias("probability"),
            F.min("cover").alias("cover"),
        )
    )
