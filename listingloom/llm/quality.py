"""Quality of a document by regularised quadratic discriminant analysis.

A few statistics of the whole text, transformed so that they are roughly normal,
describe a document. Each class gets a mean and a covariance, shrunk towards a
multiple of the identity; the score compares the two log densities. Sums and
products for both classes come from one Spark aggregation over all labelled
rows, so nothing is sampled, and only two rows reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom.llm.common import held_out, ship_by_value
from listingloom.storage import stage

#: Words that a local share of different words is taken over, whatever the text's length.
BLOCK = 64
#: Part of a class covariance that gives way to the identity.
SHRINKAGE = 0.1
#: Every share is mixed with that of so many words of ordinary prose, so that a short text is not taken for an odd one.
PSEUDO_WORDS = 40
#: Ordinary prose: characters of a word, then shares of upper case, symbols, digits, repeats, marked ends, lone marks.
WORD_CHARS, UPPER, SYMBOLS, DIGITS, REPEATS, BLOCK_REPEATS, MARKED, LONE = 6.0, 0.015, 0.025, 0.001, 0.002, 0.1, 0.1, 0.001
#: A word counts with so many characters at most in their mean, so that one key or link does not move it.
LONGEST = 16
#: Scores from here on are predicted to be label 1.
THRESHOLD = 0.3
FEATURES = (
    "root_upper",
    "root_symbols",
    "root_digits",
    "log_word_chars",
    "repeated_words",
    "block_repeats",
    "root_marked_ends",
    "root_lone_marks",
)

_LETTER, _UPPER, _DIGIT, _SPACE, _SYMBOL = range(5)
_classes: list[np.ndarray] = []


def _char_classes() -> np.ndarray:
    """Class of each code point of the basic plane, built once per process; others count as symbols."""
    if not _classes:
        chars = [chr(c) for c in range(0x10000)]
        found = np.full(0x10001, _SYMBOL, np.uint8)
        found[:0x10000] = [
            _UPPER if c.isupper() else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SPACE if c.isspace() else _SYMBOL
            for c in chars
        ]
        _classes.append(found)
    return _classes[0]


def describe(text: str | None) -> list[float]:
    """The statistics of one whole text; NULL, empty and blank texts look like ordinary prose."""
    words = (text or "").split()
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), np.uint32)
    counts = np.bincount(_char_classes()[np.minimum(codes, 0x10000)], minlength=5)
    shown = len(codes) - counts[_SPACE]
    letters = counts[_LETTER] + counts[_UPPER]
    count = len(words)
    repeats = sum(map(str.__eq__, words, words[1:]))
    different = sum(len(set(words[at : at + BLOCK])) for at in range(0, count, BLOCK))
    marked = sum(not w[-1].isalnum() for w in words)
    lone = sum(len(w) == 1 and not w.isalnum() for w in words)

    def root(part: float, of: float, usual: float, unit: float = 1.0) -> float:
        return float(np.sqrt((part + PSEUDO_WORDS * unit * usual) / (of + PSEUDO_WORDS * unit)))

    return [
        root(counts[_UPPER], letters, UPPER, WORD_CHARS),
        root(counts[_SYMBOL], shown, SYMBOLS, WORD_CHARS),
        root(counts[_DIGIT], shown, DIGITS, WORD_CHARS),
        float(np.log((sum(min(len(w), LONGEST) for w in words) + PSEUDO_WORDS * WORD_CHARS) / (count + PSEUDO_WORDS))),
        root(repeats, count, REPEATS),
        root(count - different, count, BLOCK_REPEATS),
        root(marked, count, MARKED),
        root(lone, count, LONE),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([describe(t) for t in texts])


@dataclass
class Discriminant:
    """Inverse Cholesky factors and constants of both classes, class 0 first.

    Without rows of both labels there is nothing to compare: every score is
    ``prior``, the share of label 1 among the labelled rows, or 0.5 without any.
    """

    prior: float
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None
    means: tuple[np.ndarray, ...] = ()
    factors: tuple[np.ndarray, ...] = ()
    constants: tuple[float, ...] = ()

    def scores(self, features: np.ndarray) -> np.ndarray:
        if not self.factors:
            return np.full(len(features), self.prior)
        x = (features - self.centre) / self.scale
        density = [
            constant - 0.5 * (((x - mean) @ factor.T) ** 2).sum(axis=1)
            for mean, factor, constant in zip(self.means, self.factors, self.constants)
        ]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def solve(counts: dict[int, float], sums: dict[int, np.ndarray], squares: dict[int, np.ndarray]) -> Discriminant:
    """The discriminant of both classes' row counts, feature sums and product sums."""
    total = sum(counts.values())
    if not total or any(counts.get(k, 0) < 2 for k in (0, 1)):
        return Discriminant(counts.get(1, 0) / total if total else 0.5)
    centre = (sums[0] + sums[1]) / total
    spread = np.diag(squares[0] + squares[1]) / total - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-8))
    means, factors, constants = [], [], []
    for k in (0, 1):
        mean = sums[k] / counts[k]
        covariance = (squares[k] / counts[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        size = len(mean)
        level = max(np.trace(covariance) / size, 1e-6)
        covariance = (1 - SHRINKAGE) * covariance + SHRINKAGE * level * np.eye(size)
        lower = np.linalg.cholesky(covariance)
        means.append((mean - centre) / scale)
        factors.append(np.linalg.inv(lower))
        constants.append(float(np.log(counts[k] / total) - np.log(np.diag(lower)).sum()))
    return Discriminant(counts[1] / total, centre, scale, tuple(means), tuple(factors), tuple(constants))


def fit(described: DataFrame, labels: DataFrame) -> Discriminant:
    """Learn from all rows of ``described`` (doc_id, features) that ``labels`` (doc_id, quality) marks 0 or 1.

    Held-out rows and rows with NULL id or label are left aside. A document with
    several labels, or several documents with one, count as often as they meet.
    """
    n = len(FEATURES)
    pairs = list(combinations_with_replacement(range(n), 2))
    known = (
        described.where(~held_out(F.col("doc_id")))
        .select("doc_id", "features")
        .join(labels.where("quality in (0, 1)").select("doc_id", "quality"), "doc_id", "inner")
    )
    f = [F.col("features")[i] for i in range(n)]
    rows = (
        known.groupBy("quality")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.array(*[F.sum(x) for x in f]).alias("sums"),
            F.array(*[F.sum(f[i] * f[j]) for i, j in pairs]).alias("products"),
        )
        .collect()
    )
    counts, sums, squares = {}, {}, {}
    for row in rows:
        k = row["quality"]
        counts[k], sums[k], squares[k] = row["rows"], np.array(row["sums"]), np.zeros((n, n))
        for (i, j), value in zip(pairs, row["products"]):
            squares[k][i, j] = squares[k][j, i] = value
    return solve(counts, sums, squares)


def score_features(features: Column, model: Discriminant) -> Column:
    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.array(vectors.to_list(), dtype=float)))

    return score(features)


def describe_documents(docs: DataFrame) -> DataFrame:
    """doc_id and features of every document, stored: texts are read and measured once."""
    return stage(docs.select("doc_id", statistics(F.col("text")).alias("features")), "quality-features")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, NULL and empty texts included.

    Repeated rows are scored alike. Columns other than doc_id and text are not read.
    """
    described = describe_documents(docs)
    model = fit(described, labels)
    return described.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score_features(F.col("features"), model).alias("score")
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted to be label 1, with all their columns."""
    model = fit(describe_documents(docs), labels)
    return docs.where(score_features(statistics(F.col("text")), model) >= THRESHOLD)


ship_by_value(__name__)
