"""What filters take from each other, over all orders of applying them.

The filters already applied form a state of the subset lattice; an order is a path
from the empty to the full state. One sweep forwards counts the orders that reach
a state, one backwards those that leave it. An edge applies one filter to what a
state has kept. It lies on (orders reaching its start) x (orders leaving its end)
paths, so the edges weighted by that give the Shapley sums, and the steps of any
single order are read from the same edges.

Documents are reduced to counts by part and set of failed filters first, which is
all the lattice needs: its work depends on the parts, not on the documents.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingloom.llm.common import ship_by_value
from listingloom.storage import stage

LETTERS = "ABCDE"
LEAST_WORDS = 200
#: Different words, of all words, in percent; upper-case letters, of all characters, in percent.
LEAST_DISTINCT, MOST_UPPER = 50, 2
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Fixed by the result's contract: characters of the fourth filter.
MARKS = b"#$%&*|"
COUNTS = ("rows", "good", "toxic")


@dataclass(frozen=True)
class Lattice:
    """States are bit sets of applied filters; bit i is ``letters[i]``."""

    letters: str = LETTERS
    forward: np.ndarray = field(init=False)
    backward: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        count = len(self.letters)
        forward, backward = np.zeros(1 << count, np.int64), np.zeros(1 << count, np.int64)
        forward[0] = backward[-1] = 1
        for state in range(1 << count):
            for bit in range(count):
                if not state >> bit & 1:
                    forward[state | 1 << bit] += forward[state]
        for state in reversed(range(1 << count)):
            for bit in range(count):
                if state >> bit & 1:
                    backward[state ^ 1 << bit] += backward[state]
        object.__setattr__(self, "forward", forward)
        object.__setattr__(self, "backward", backward)

    def kept(self, failing: np.ndarray) -> np.ndarray:
        """Rows left in each state, of rows counted by the set of filters that they fail.

        A state keeps what fails none of its filters: the sum over all subsets of
        the filters not applied.
        """
        sums = failing.copy()
        for bit in range(len(self.letters)):
            pairs = sums.reshape(-1, 2, 1 << bit)
            pairs[:, 1] += pairs[:, 0]
        return sums[::-1]

    def edges(self, kept: np.ndarray) -> np.ndarray:
        """Rows removed on each edge, by state and filter; 0 where the filter has been applied."""
        states = np.arange(len(kept))[:, None]
        return kept[:, None] - kept[states | 1 << np.arange(len(self.letters))]

    def shapley(self, removed: np.ndarray) -> np.ndarray:
        """Rows removed by each filter, summed over all orders."""
        states = np.arange(len(removed))[:, None]
        bits = 1 << np.arange(len(self.letters))
        paths = np.where(states & bits, 0, self.forward[:, None] * self.backward[states | bits])
        return (paths * removed).sum(axis=0)

    def steps(self) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Order, step, state before and filter of every step of every order."""
        orders, step, state, filters = [], [], [], []
        for order in permutations(range(len(self.letters))):
            name, before = "".join(self.letters[f] for f in order), 0
            for number, f in enumerate(order, 1):
                orders.append(name)
                step.append(number)
                state.append(before)
                filters.append(f)
                before |= 1 << f
        return orders, np.array(step, np.int32), np.array(state), np.array(filters)


def failed(text: str | None) -> tuple[int, bytes]:
    """The filters A to D that a whole text fails, as bits, and 128 bits that identify it. NULL is empty."""
    text = text or ""
    said = text.encode("utf-8", "replace")
    words = said.split()
    upper = len(said) - len(said.translate(None, UPPER))
    mask = (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * upper > MOST_UPPER * len(text)) << 2
        | (len(said.translate(None, MARKS)) < len(said)) << 3
    )
    return mask, xxhash.xxh3_128_digest(said)


def measure(docs: DataFrame) -> DataFrame:
    """Stored doc_id, part (the source, NULL as empty), mask of the filters A to D, print of the text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches):
        for batch in batches:
            found = [failed(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array((mask for mask, _ in found), pa.int32()),
                    pa.array((seal for _, seal in found), pa.binary()),
                ],
                ["doc_id", "part", "mask", "print"],
            )

    part = F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part")
    return stage(
        docs.select("doc_id", part, "text").mapInArrow(read, f"doc_id {kind}, part string, mask int, print binary"),
        "filters-measured",
    )


def count_failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows by part and mask of failed filters: ``rows``, and of these ``good`` and ``toxic`` ones.

    A document is a copy (filter E) unless it has the smallest id of its text. That
    is looked up by id: texts with very many copies are aggregated, never joined.
    """
    measured = measure(docs)
    firsts = (
        measured.groupBy("print")
        .agg(F.min("doc_id").alias("doc_id"))
        .select("doc_id", F.col("print").alias("first_of"), F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    )
    marks = labels.select(
        "doc_id",
        F.lit(None).cast("binary").alias("first_of"),
        (F.col("quality") == 1).alias("good"),
        (F.col("toxic") == 1).alias("toxic"),
    )
    by_id = (
        firsts.unionByName(marks)
        .where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.collect_set("first_of").alias("first_of"),
            F.coalesce(F.bool_or("good"), F.lit(False)).alias("good"),
            F.coalesce(F.bool_or("toxic"), F.lit(False)).alias("toxic"),
        )
    )
    first = F.coalesce(F.array_contains("first_of", F.col("print")), F.lit(False))
    copy = F.col("doc_id").isNotNull() & ~first
    whole = F.col("mask") + F.when(copy, 1 << LETTERS.index("E")).otherwise(0)
    return (
        measured.join(by_id, "doc_id", "left")
        .groupBy("part", whole.alias("mask"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("good").alias("good"),
            F.count_if("toxic").alias("toxic"),
        )
    )


def audit(counts: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row per part, order and step for rows of part, mask, rows, good and toxic.

    Returns ``part``, ``filter_order``, ``step`` and the counts ``kept`` (after the
    step), ``removed`` (there), ``redundant`` (failing the filter, removed before),
    ``unique_fails`` (failing it alone), ``good_lost``, ``toxic_lost`` and
    ``shapley`` (removed by the filter over all orders). Each part has at most two
    to the number of filters rows here, so a part is one small row to a task.
    """
    lattice = Lattice(letters)
    orders, step, state, filters = lattice.steps()

    def lay_out(batches):
        after = state | 1 << filters
        for batch in batches:
            for part, found in zip(batch["part"], batch["found"]):
                failing = {name: np.zeros(1 << len(letters), np.int64) for name in COUNTS}
                for row in found:
                    for name in COUNTS:
                        failing[name][row["mask"]] += row[name]
                kept = {name: lattice.kept(failing[name]) for name in COUNTS}
                removed = {name: lattice.edges(kept[name]) for name in COUNTS}
                masks = np.arange(1 << len(letters))
                fails = np.array([failing["rows"][masks >> f & 1 == 1].sum() for f in range(len(letters))])
                yield pd.DataFrame(
                    {
                        "part": part,
                        "filter_order": orders,
                        "step": step,
                        "kept": kept["rows"][after],
                        "removed": removed["rows"][state, filters],
                        "redundant": fails[filters] - removed["rows"][state, filters],
                        "unique_fails": failing["rows"][1 << filters],
                        "good_lost": removed["good"][state, filters],
                        "toxic_lost": removed["toxic"][state, filters],
                        "shapley": lattice.shapley(removed["rows"])[filters],
                    }
                )

    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", *COUNTS)).alias("found"))
    return per_part.mapInPandas(
        lay_out,
        "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
        "good_lost long, toxic_lost long, shapley long",
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over whole documents.

    A: under 200 words; B: fewer than half of the words differ; C: over 2 % of the
    characters are A-Z; D: holds one of ``#$%&*|``; E: a smaller id has the same
    text, wherever in the table. Words part at the six ASCII white-space characters.

    NULL text is empty: it fails A alone, and E if it repeats. Rows of one id are
    documents of their own and no copies of each other; a NULL id has no smaller
    one and no label. A document is good or toxic if any of its label rows says so.
    Other columns are ignored. No documents give no rows.
    """
    return audit(count_failures(docs, labels))


ship_by_value(__name__)
