"""Language of a text by a small convolutional network over its bytes.

Bytes are embedded, filters of several widths run over windows of fixed length,
each filter keeps its strongest answer in the window, and a softmax layer names
the language. The network is trained with numpy on a bounded sample of labelled
documents and goes to the tasks inside the function (some 20 kB). A document is
cut into windows from its first byte to its last; its scores are the means over
its windows, weighted by their bytes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingloom.llm.common import held_out, ship_by_value
from listingloom.storage import stage

LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"
PAD = 256


@dataclass(frozen=True)
class Settings:
    """Shape and training of the network.

    The sample is bounded by ``docs_per_lang``, ``max_docs`` and ``windows_per_doc``;
    ``max_docs`` bounds what reaches the driver to 8 MB.
    """

    window: int = 128
    widths: tuple[int, ...] = (2, 3, 5)
    filters: int = 16
    embedding: int = 8
    docs_per_lang: int = 600
    max_docs: int = 16_000
    windows_per_doc: int = 4
    epochs: int = 6
    batch: int = 64
    rate: float = 0.004
    seed: int = 7


@dataclass
class Network:
    """Weights; ``filters`` stacks all widths, shorter ones filled with zeros."""

    langs: list[str]
    window: int
    width: int
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    mask: np.ndarray = field(repr=False)

    def columns(self, windows: np.ndarray) -> np.ndarray:
        """Each position's bytes, embedded side by side: (windows, positions, width * embedding)."""
        count, length = windows.shape
        padded = np.full((count, length + self.width - 1), PAD, np.int64)
        padded[:, :length] = windows
        embedded = self.embedding[padded]
        return np.concatenate([embedded[:, k : k + length] for k in range(self.width)], axis=2)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        columns = self.columns(windows)
        answers = columns @ self.filters
        strongest = answers.max(axis=1) + self.bias
        return columns, answers, strongest

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        strongest = self.pooled(windows)[2]
        return softmax(np.maximum(strongest, 0) @ self.out + self.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def windows_of(data: bytes, length: int) -> np.ndarray:
    """All bytes in rows of ``length``; the last row is filled up with PAD."""
    rows = -(-len(data) // length)
    cells = np.full(rows * length, PAD, np.int16)
    cells[: len(data)] = np.frombuffer(data, np.uint8)
    return cells.reshape(rows, length)


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], given: Settings = Settings()) -> Network:
    """Fit by Adam on shuffled batches; the same sample gives the same network."""
    random = np.random.default_rng(given.seed)
    width, total = max(given.widths), given.filters * len(given.widths)
    mask = np.zeros((width, given.embedding, total), np.float32)
    for n, w in enumerate(given.widths):
        mask[:w, :, n * given.filters : (n + 1) * given.filters] = 1
    mask = mask.reshape(width * given.embedding, total)
    net = Network(
        langs,
        given.window,
        width,
        random.normal(0, 0.5, (PAD + 1, given.embedding)).astype(np.float32),
        (random.normal(0, 0.3, mask.shape) * mask).astype(np.float32),
        np.zeros(total, np.float32),
        random.normal(0, 0.2, (total, len(langs))).astype(np.float32),
        np.zeros(len(langs), np.float32),
        mask,
    )
    names = ("embedding", "filters", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    for _ in range(given.epochs):
        order = random.permutation(len(windows))
        for at in range(0, len(order), given.batch):
            pick = order[at : at + given.batch]
            grads = gradients(net, windows[pick], labels[pick])
            step += 1
            for k in names:
                first[k] += 0.1 * (grads[k] - first[k])
                second[k] += 0.001 * (grads[k] ** 2 - second[k])
                mean, power = first[k] / (1 - 0.9**step), second[k] / (1 - 0.999**step)
                getattr(net, k)[...] -= given.rate * mean / (np.sqrt(power) + 1e-8)
    return net


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy. Through the pooling only the strongest position of a filter learns."""
    count, length = windows.shape
    columns, answers, strongest = net.pooled(windows)
    hidden = np.maximum(strongest, 0)
    error = softmax(hidden @ net.out + net.out_bias)
    error[np.arange(count), labels] -= 1
    error /= count
    back = (error @ net.out.T) * (strongest > 0)
    where = answers.argmax(axis=1)
    seen = columns[np.arange(count)[:, None], where]
    filters = np.einsum("bfk,bf->kf", seen, back) * net.mask
    spread = back[:, :, None] * net.filters.T[None]
    embedding = np.zeros_like(net.embedding)
    size = net.embedding.shape[1]
    padded = np.full((count, length + net.width - 1), PAD, np.int64)
    padded[:, :length] = windows
    for k in range(net.width):
        at = padded[np.arange(count)[:, None], where + k]
        np.add.at(embedding, at, spread[:, :, k * size : (k + 1) * size])
    return {
        "embedding": embedding,
        "filters": filters,
        "bias": back.sum(axis=0),
        "out": hidden.T @ error,
        "out_bias": error.sum(axis=0),
    }


def sample(docs: DataFrame, given: Settings) -> pd.DataFrame:
    """Windows of labelled documents, spread evenly over each whole text.

    The documents are those with the lowest hash of their ids in each language,
    so any engine layout gives the same ones. Where languages are so many that
    ``docs_per_lang`` of each would exceed ``max_docs``, all get an equal share of it, one document
    at least. Ids are picked first, then only their texts are read.
    """
    known = docs.select("doc_id", "lang", "text").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    # Of a frequent language only the lower hashes can be picked; twice as many as needed go on.
    rates = stage(
        known.groupBy("lang").agg((F.lit(2.0 * given.docs_per_lang) / F.count(F.lit(1))).alias("__rate")),
        "language-rates",
    )
    share = max(1, min(given.docs_per_lang, given.max_docs // max(rates.count(), 1)))
    by_hash = Window.partitionBy("lang").orderBy("__key", "doc_id")
    picked = (
        known.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(2**40)).alias("__key"))
        .join(rates, "lang", "inner")
        .where((F.col("__key") / float(2**40) < F.col("__rate")) | (F.col("__rate") > 0.2))
        .withColumn("__n", F.row_number().over(by_hash))
        .where(F.col("__n") <= share)
        .orderBy("__n", "__key", "doc_id")
        .limit(given.max_docs)
        .select("doc_id")
        .distinct()
    )
    # At most max_docs ids of eight bytes.
    texts = known.join(F.broadcast(picked), "doc_id", "left_semi")
    length, most = given.window, given.windows_per_doc

    def cut(batches):
        for batch in batches:
            out = []
            for doc_id, lang, text in zip(batch["doc_id"], batch["lang"], batch["text"]):
                if isinstance(text, str) and LETTER.search(text):
                    data = text.encode()
                    starts = np.unique(np.linspace(0, max(len(data) - length, 0), most).astype(int))
                    out += [(doc_id, lang, int(s), data[s : s + length]) for s in starts]
            yield pd.DataFrame(out, columns=["doc_id", "lang", "start", "piece"])

    cut_texts = texts.mapInPandas(cut, "doc_id long, lang string, start long, piece binary")
    found = cut_texts.dropDuplicates(["doc_id", "lang", "start", "piece"]).limit(
        given.max_docs * most
    ).toPandas()
    return found.sort_values(["lang", "doc_id", "start", "piece"], ignore_index=True)


def fit(docs: DataFrame, given: Settings = Settings()) -> Network:
    """Train on ``docs`` (doc_id, text, lang), leaving held-out rows aside.

    Without labelled text the network knows no language. Then, as for text
    without a letter, every answer is ``und``.
    """
    known = sample(docs, given)
    langs = sorted(known["lang"].unique())
    windows = np.full((len(known), given.window), PAD, np.int16)
    for row, piece in enumerate(known["piece"]):
        windows[row, : len(piece)] = np.frombuffer(piece, np.uint8)
    labels = np.searchsorted(np.array(langs, dtype=object), known["lang"].to_numpy()) if langs else np.array([])
    return train(windows, labels.astype(int), langs, given)


def identify(texts, net: Network, chunk: int = 512) -> tuple[list[str], list[float]]:
    """Language and score of each text. A long text passes through in chunks of windows."""
    sums = np.zeros((len(texts), max(len(net.langs), 1)))
    weights = np.zeros(len(texts))
    waiting, owners, held = [], [], 0

    def flush():
        if waiting:
            windows, owner = np.concatenate(waiting), np.concatenate(owners)
            for at in range(0, len(windows), chunk):
                part = windows[at : at + chunk]
                size = (part != PAD).sum(axis=1)
                np.add.at(sums, owner[at : at + chunk], net.probabilities(part) * size[:, None])
                np.add.at(weights, owner[at : at + chunk], size)
            waiting.clear(), owners.clear()

    for row, text in enumerate(texts):
        if net.langs and isinstance(text, str) and LETTER.search(text):
            windows = windows_of(text.encode("utf-8", "replace"), net.window)
            waiting.append(windows)
            owners.append(np.full(len(windows), row))
            held += len(windows)
            if held >= chunk:
                flush()
                held = 0
    flush()
    means = sums / np.maximum(weights, 1)[:, None]
    best = means.argmax(axis=1)
    named = weights > 0
    return (
        [net.langs[b] if ok else UNKNOWN for b, ok in zip(best, named)],
        np.clip(np.where(named, means.max(axis=1), 0.0), 0, 1).tolist(),
    )


def language_of(text: Column, net: Network) -> Column:
    """Struct of ``lang`` and ``score`` (mean probability) of the whole text.

    NULL text and text without a letter are ``und`` with score 0. Equal texts get
    equal answers; an empty table is answered by no rows.
    """

    @F.pandas_udf("lang string, score double")
    def answer(texts: pd.Series) -> pd.DataFrame:
        langs, scores = identify(texts.to_list(), net)
        return pd.DataFrame({"lang": langs, "score": scores})

    return answer(text)


ship_by_value(__name__)
