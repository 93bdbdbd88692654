"""Jaccard join on word shingles by partition of the universe.

Two sets of sizes a and b with similarity t differ in at most
H = (1 - t) / (1 + t) * (a + b) elements. Hash the elements into segments: if a set
gives segment i an allowance of a_i and the allowances add up to more than H, some
segment differs in fewer than a_i elements. Allowance 1 means that the segments
are equal, allowance 2 that they are equal or one has one element more, which
deletion variants of both sides reveal; segments with allowance 0 are skipped.

Sizes fall into bands, each with its own number of segments. The larger set of a
pair indexes all its segments in its own band; the smaller one probes there and in
the bands just above. Which segments it probes is a matter of cost: how often the
segment's rarest element occurs among all documents, by a sketch of fixed size.
So segments made of passages that many documents share are skipped while others
are left. Small sets have few segments, and only they use deletion variants.

Sets that meet form families. A large family is met again with segments of a new
hash, among its own members only: similar sets meet whatever the hash, strangers
that one passage or accident had brought together mostly do not, so chains of
them fall apart before anything is compared. What is left is verified in blocks, on all
shingles of the whole texts, and returns links as local stars; pairs are never listed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listingloom.llm.common import ship_by_value
from listingloom.llm.components import components
from listingloom.storage import stage

#: Cells of the sketch of element counts, and of the pieces in which it is added up.
CELLS, CHUNK = 1 << 18, 1 << 14
#: What a row of a bucket is: the low bits of its node.
INDEX, INDEX_SHORT, PROBE, PROBE_BOTH, PROBE_SHORT = 1, 2, 4, 8, 16
FLAGS = 31
#: Cost of a segment without elements, which many sets have in common.
EMPTY = np.int64(1) << 40


@dataclass(frozen=True)
class Settings:
    """``percent`` is the least similarity; ``ratio`` of a band's ends; up to ``short`` elements deletions are used.

    ``spare`` is the share of segments that a set can skip. ``block`` sets of a family, of about ``elements`` elements
    at most, are compared at once with as many others. Families of more than ``settled`` sets meet ``turns`` times.
    """

    words: int = 4
    percent: int = 85
    ratio: float = 1.4
    short: int = 48
    spare: float = 0.06
    block: int = 512
    elements: int = 1 << 19
    settled: int = 32
    turns: int = 2

    def differ(self, total: int) -> int:
        """Most elements in which two sets of ``total`` elements together differ."""
        return (100 - self.percent) * total // (100 + self.percent)

    def band(self, size: int) -> tuple[int, int]:
        """Smallest and largest size in the band of ``size``. Bands start at 1."""
        low = 1
        while True:
            high = max(low, int(low * self.ratio))
            if size <= high:
                return low, high
            low = high + 1

    def segments(self, high: int) -> int:
        most = self.differ(2 * high) + 1
        if high <= self.short:
            return (most + 1) // 2 + 1
        return most + 1 + int(most * self.spare)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of a whole text as sorted 64-bit hashes.

    Only A-Z are lower-cased; words part at the six ASCII white-space characters.
    Fewer words than ``words`` are one shingle; no word and NULL give no shingle.
    """
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    length = min(words, len(found))
    total = np.full(len(found) - length + 1, len(found) if len(found) < words else words, np.uint64)
    for k in range(length):
        total = mix(total * np.uint64(0xD6E8FEB86659FD93) + hashes[k : len(hashes) - length + 1 + k])
    return np.unique(total)


def describe(docs: DataFrame, given: Settings) -> DataFrame:
    """Stored rows of two kinds: documents (doc_id, n_shingles, node, print) and pieces of the count sketch.

    ``print`` identifies the set with 128 bits, ``node`` is its short form. A task
    ends with its pieces of the sketch: how many documents hold an element of each
    cell.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches):
        cells = np.zeros(CELLS, np.int64)
        for batch in batches:
            sizes, nodes, prints = [], [], []
            for text in batch["text"]:
                own = shingles(text, given.words)
                sizes.append(len(own))
                seal = xxhash.xxh3_128_digest(own.tobytes())
                prints.append(seal)
                nodes.append(int.from_bytes(seal[:8], "little", signed=True) & ~FLAGS)
                np.add.at(cells, (own % np.uint64(CELLS)).astype(np.int64), 1)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n_shingles": sizes, "node": nodes, "print": prints, "chunk": -1, "cells": None}
            )
        pieces = [cells[at : at + CHUNK].astype("<i8").tobytes() for at in range(0, CELLS, CHUNK)]
        yield pd.DataFrame(
            {
                "doc_id": None,
                "n_shingles": 0,
                "node": TaskContext.get().partitionId(),
                "print": None,
                "chunk": range(len(pieces)),
                "cells": pieces,
            }
        ).astype({"doc_id": batch_type(kind)})

    return stage(
        docs.select("doc_id", "text").mapInPandas(
            read, f"doc_id {kind}, n_shingles long, node long, print binary, chunk int, cells binary"
        ),
        "jaccard-sets",
    )


def batch_type(kind: str) -> str:
    return "Int64" if kind in ("bigint", "int", "smallint", "tinyint") else "object"


def costs(described: DataFrame) -> np.ndarray:
    """Cost of each cell: by how much its count exceeds what most cells have.

    Pieces are added up in two steps, so no task holds those of all tasks. The
    result has a fixed size.
    """

    def add(pieces: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, "<i8") for x in pieces["cells"])
        return pd.DataFrame(
            {"chunk": [pieces["chunk"].iloc[0]], "node": [pieces["node"].iloc[0]], "cells": [total.tobytes()]}
        )

    pieces = described.where("chunk >= 0").select("chunk", F.col("node") % 64, "cells").toDF("chunk", "node", "cells")
    shape = "chunk int, node long, cells binary"
    once = pieces.groupBy("chunk", "node").applyInPandas(add, shape)
    rows = once.groupBy("chunk").applyInPandas(add, shape).collect()
    cells = np.zeros(CELLS, np.int64)
    for row in rows:
        cells[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["cells"], "<i8")
    usual = np.median(cells)
    excess = cells - usual
    return np.where(excess > 4 * np.sqrt(usual) + 8, excess, 0).astype(np.int64)


def allowances(cost: np.ndarray, sizes: np.ndarray, needed: int, short: bool) -> np.ndarray:
    """Allowances of all segments that add up to ``needed``, cheapest segments first.

    Of equally cheap segments the longer come first. Where deletions are allowed a
    segment's second unit costs one variant per element on top of the first.
    """
    order = np.lexsort((-sizes, cost))
    given = np.zeros(len(cost), np.int64)
    if not short:
        given[order[:needed]] = 1
        return given
    units = np.concatenate([cost, cost * 2 + 1])
    # A second unit never comes before the first of the same segment, as it costs more.
    first = np.lexsort((np.concatenate([-sizes, sizes]), units))[:needed]
    np.add.at(given, first % len(cost), 1)
    return given


def keys_of(
    own: np.ndarray, node: int, cost: np.ndarray, given: Settings, turn: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of one set and its node with flags for each. Each turn has its own hash of the elements."""
    size = len(own)
    low, high = given.band(size)
    reach = 100 * size // given.percent
    keys, nodes = [], []
    home = True
    while low <= reach:
        needed = given.differ(size + min(high, reach)) + 1
        # Sets that may not differ at all are equal, and equal sets are joined by their prints.
        if home or needed > 1:
            short = high <= given.short
            count = given.segments(high)
            # Elements are hashed anew in each band and turn, so that accidents of one do not repeat in the next.
            mixed = mix(own + np.uint64(high + (turn << 40)))
            segment = (mixed % np.uint64(count)).astype(np.int64)
            order = np.argsort(segment, kind="stable")
            sizes = np.bincount(segment, minlength=count)
            running = np.concatenate([[np.uint64(0)], np.cumsum(mixed[order])])
            ends = np.cumsum(sizes)
            sums = running[ends] - running[ends - sizes]
            least = np.full(count, EMPTY, np.int64)
            np.minimum.at(least, segment, cost[(own % np.uint64(CELLS)).astype(np.int64)])
            allowed = allowances(least, sizes, needed, short)
            salt = mix(np.arange(count, dtype=np.uint64) + np.uint64(high << 20))
            flags = np.where(allowed > 0, PROBE, 0) | np.where(allowed > 1, PROBE_BOTH, 0) | (INDEX if home else 0)
            shown = flags > 0
            keys.append(mix(sums + salt)[shown])
            nodes.append(flags[shown])
            if short:
                less = np.where(allowed[segment] > 1, PROBE_SHORT, 0) | (INDEX_SHORT if home else 0)
                shown = less > 0
                keys.append(mix(sums[segment] - mixed + salt[segment])[shown])
                nodes.append(less[shown])
        home = False
        low, high = given.band(high + 1)
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keys).view(np.int64), np.concatenate(nodes).astype(np.int64) | node


def meetings(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the runs of equal keys in which a probe can meet an index entry of another set."""
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    flags = np.bitwise_or.reduceat(nodes & FLAGS, starts)
    bare = nodes & ~FLAGS
    able = ((flags & (PROBE | PROBE_BOTH | PROBE_SHORT) > 0) & (flags & INDEX > 0)) | (
        (flags & PROBE_BOTH > 0) & (flags & INDEX_SHORT > 0)
    )
    lengths = np.diff(np.concatenate([starts, [len(keys)]]))
    hubs = np.repeat(bare[starts], lengths)
    shown = np.repeat(able & (lengths > 1), lengths) & (hubs != bare)
    return hubs[shown], bare[shown]


def families(docs: DataFrame, cost: np.ndarray, given: Settings, turn: int = 0) -> DataFrame:
    """``node`` and ``root`` of the sets that meet others in some bucket (roots themselves not listed).

    ``docs`` holds ``text`` and ``within``, the family in which a set can meet others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(cost)  # CELLS numbers, whatever the input.

    def index(batches):
        table = shared.value
        for batch in batches:
            texts, homes = batch.column(0), batch.column(1).to_numpy().view(np.uint64)
            for at in range(0, len(texts), 256):
                keys, nodes = [], []
                for text, home in zip(texts.slice(at, 256).to_pylist(), homes[at : at + 256]):
                    own = shingles(text, given.words)
                    if len(own):
                        seal = xxhash.xxh3_128_digest(own.tobytes())
                        node = int.from_bytes(seal[:8], "little", signed=True) & ~FLAGS
                        found = keys_of(own, node, table, given, turn)
                        keys.append(mix(found[0].view(np.uint64) ^ home).view(np.int64))
                        nodes.append(found[1])
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys)), pa.array(np.concatenate(nodes))], ["key", "node"]
                    )

    def meet(batches):
        keys, nodes = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            nodes = np.concatenate([nodes, batch.column(1).to_numpy()])
            # The last run may go on in the next batch; a very long one is handed over in parts that share a row.
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if len(keys) - cut > 1_000_000:
                yield stars(*meetings(keys, nodes | FLAGS))
                keys, nodes = keys[cut : cut + 1], nodes[cut : cut + 1] | FLAGS
            elif cut > 100_000:
                yield stars(*meetings(keys[:cut], nodes[:cut]))
                keys, nodes = keys[cut:], nodes[cut:]
        if len(keys):
            yield stars(*meetings(keys, nodes))

    def stars(hubs: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.stack([hubs, nodes], axis=1), axis=0)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], ["a", "b"]
        )

    rows = docs.select("text", "within").mapInArrow(index, "key long, node long")
    met = rows.repartition("key").sortWithinPartitions("key", "node").mapInArrow(meet, "a long, b long")
    return components(met)


def link_family(members: pd.DataFrame, given: Settings) -> pd.DataFrame:
    """Stars of the links between the two blocks of a family (or within one)."""
    sets = [shingles(t, given.words) for t in members["text"]]
    ids = members["rep"].to_numpy(np.int64)
    sides = members["own"].to_numpy()
    first, second = int(members["first"].iloc[0]), int(members["second"].iloc[0])
    left, right = np.flatnonzero(sides == first), np.flatnonzero(sides == second)
    sizes = np.array([len(s) for s in sets], np.int64)
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}).astype("int64")
    elements = np.concatenate([sets[r] for r in right])
    owners = np.repeat(np.arange(len(right)), sizes[right])
    order = np.argsort(elements, kind="stable")
    elements, owners = elements[order], owners[order]
    roots = {int(i): int(i) for i in ids}

    def root(x: int) -> int:
        while roots[x] != x:
            roots[x] = roots[roots[x]]
            x = roots[x]
        return x

    for row in left:
        begin = np.searchsorted(elements, sets[row], "left")
        counts = np.searchsorted(elements, sets[row], "right") - begin
        total = int(counts.sum())
        if not total:
            continue
        shift = np.repeat(begin - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        common = np.bincount(owners[np.arange(total) + shift], minlength=len(right))
        union = sizes[row] + sizes[right] - common
        for other in right[100 * common >= given.percent * union]:
            a, b = root(int(ids[row])), root(int(ids[other]))
            if a != b:
                roots[max(a, b)] = min(a, b)
    linked = [(i, root(i)) for i in roots if root(i) != i]
    return pd.DataFrame(linked, columns=["a", "b"]).astype("int64")


def members_of(met: DataFrame, groups: DataFrame) -> DataFrame:
    """``rep``, ``family`` and ``size`` of every set that has met another, stored."""
    roots = met.select(F.col("root").alias("node")).distinct().withColumn("root", F.col("node"))
    named = groups.join(met.unionByName(roots), "node", "inner")
    return stage(named.groupBy("rep", F.col("root").alias("family")).agg(F.max("size").alias("size")), "jaccard-members")


def met_again(
    own: DataFrame, members: DataFrame, groups: DataFrame, cost: np.ndarray, given: Settings, turn: int
) -> DataFrame:
    """``members`` with the large families parted into those whose sets meet in this turn as well."""
    large = members.groupBy("family").agg(F.count(F.lit(1)).alias("sets")).where(F.col("sets") > given.settled)
    open_ones = members.join(large, "family", "left_semi").select("rep", F.col("family").alias("within"))
    texts = own.join(open_ones, own["doc_id"] == open_ones["rep"], "inner").select("text", "within")
    parted = members_of(families(texts, cost, given, turn), groups)
    return stage(members.join(large, "family", "left_anti").unionByName(parted.select(*members.columns)), "jaccard-parted")


def similar_groups(docs: DataFrame, given: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Two documents link when 100 * common >= percent * union of their shingle sets;
    the component is the smallest doc_id reachable by links. Equal sets are one
    node, so copies never meet each other. NULL, empty and blank texts have no
    shingles and link with nothing. Rows without doc_id have a NULL component. A
    doc_id that comes more than once is one document of several texts. Other
    columns are ignored. No rows give no rows.
    """
    own = docs.select("doc_id", "text")
    described = describe(own, given)
    sets = described.where("chunk < 0").select("doc_id", "n_shingles", "node", "print")
    full = sets.where("n_shingles > 0 and doc_id is not null")
    groups = stage(
        full.groupBy("print", "node").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size")),
        "jaccard-groups",
    )
    cost = costs(described)
    started = own.where("doc_id is not null").select("text", F.lit(0).cast("long").alias("within"))
    members = members_of(families(started, cost, given), groups)
    # From here on only texts of sets that have met are moved; of those in large families first, then of what is left.
    texts = own.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    if given.turns > 1:
        texts = stage(texts, "jaccard-texts")
    for turn in range(1, given.turns):
        members = met_again(texts, members, groups, cost, given, turn)
    blocks = members.groupBy("family").agg(
        F.ceil(
            F.greatest(F.count(F.lit(1)) / F.lit(given.block), F.sum("size") / F.lit(given.elements))
        ).cast("int").alias("blocks")
    )
    dealt = (
        members.join(blocks, "family", "inner")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("rep", "family", "own", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"))
    )
    links = (
        texts.join(dealt, texts["doc_id"] == dealt["rep"], "inner")
        .select("rep", "family", "own", "first", "second", "text")
        .groupBy("family", "first", "second")
        .applyInPandas(lambda rows: link_family(rows, given), "a long, b long")
    )
    found = components(links)
    named = groups.select("print", "rep").join(
        found.select(F.col("node").alias("rep"), F.col("root")), "rep", "left"
    ).select(F.col("print").alias("__print"), F.coalesce("root", "rep").alias("component_id"))
    return sets.join(
        named, (F.col("print") == F.col("__print")) & (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), "left"
    ).select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, given: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` without those that a document with a smaller id stands for.

    Of a doc_id that comes more than once the row with the smallest text stays.
    Rows without doc_id all stay.
    """
    groups = similar_groups(docs, given)
    stays = groups.where("doc_id = component_id").select("doc_id").distinct()
    known = docs.where("doc_id is not null").join(stays, "doc_id", "left_semi").select(*docs.columns)
    order = [F.col(c) for c in ("text", "source", "lang") if c in docs.columns]
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(*order))
    one = known.withColumn("__n", first).where("__n = 1").drop("__n")
    return one.unionByName(docs.where("doc_id is null"))


ship_by_value(__name__)
