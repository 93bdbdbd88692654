"""Near-duplicate vectors by a forest of random-projection trees.

Each tree splits the space at the median along random directions; rows close to
a cut go to both sides. Rows of one leaf are compared exactly, and what is alike
is joined to components. The cuts are fitted on a bounded sample, but every row
passes through every tree. Below the depth that the sample can tell, a leaf that still
stands for too many rows is cut on at its middle along fresh directions, which all
such leaves of a tree share; so leaves stay small at any number of rows and the
forest's size is a few numbers a leaf.

How many trees are grown is measured: partners at a cosine just above the threshold
are made for sampled rows, and trees are added until enough of them meet.

A node whose rows would nearly all go to both sides is not split further: a group
of near copies stays together. A leaf that is expected to hold many rows is
compared in blocks, a task for each pair of blocks. Links are counted where two
rows meet first, never listed: a task returns a count and a local root per row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingloom.llm.common import ship_by_value
from listingloom.llm.components import components
from listingloom.llm.vectors import usable
from listingloom.storage import stage


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows that the cuts are fitted on.

    ``spill`` is half the width of the overlap at a cut, in standard deviations
    of a random direction; ``leaf`` the rows a leaf should have; ``block`` the rows
    of a block; a node where more than ``tight`` of the rows lie in the overlap
    stays whole. There are ``trees`` trees at least and ``most_trees`` at most, as
    many as it takes for ``recall`` of the made partners to meet.
    """

    threshold: float = 0.9
    trees: int = 4
    spill: float = 0.16
    leaf: int = 384
    block: int = 2048
    sample: int = 16_384
    tight: float = 0.6
    seed: int = 11
    recall: float = 0.985
    most_trees: int = 12


#: Sampled rows below which a node's median is no guide.
FEWEST = 16
#: Sampled rows that partners are made for, and how far above the threshold.
PROBES, ABOVE = 2048, 0.005


@dataclass
class Tree:
    """Cuts by node; ``low`` and ``high`` are child nodes, or -1 and the number of the leaf.

    A leaf with ``levels`` above 0 is cut on that often along ``further``; its first
    sub-leaf has the leaf's number, and ``centres`` are its places along each.
    """

    directions: np.ndarray
    cuts: np.ndarray
    low: np.ndarray
    high: np.ndarray
    margin: float
    levels: np.ndarray
    further: np.ndarray
    centres: np.ndarray

    def leaves_of(self, units: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Leaf numbers with the rows that reach them."""
        found, waiting = [], [(0, np.arange(len(units)))]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            if self.low[node] < 0:
                found += self._cut_on(node, units, rows)
                continue
            along = units[rows] @ self.directions[node] - self.cuts[node]
            waiting += [
                (int(self.low[node]), rows[along < self.margin]),
                (int(self.high[node]), rows[along > -self.margin]),
            ]
        return found

    def _cut_on(self, node: int, units: np.ndarray, rows: np.ndarray) -> list[tuple[int, np.ndarray]]:
        parts = [(int(self.high[node]), rows)]
        for level in range(int(self.levels[node])):
            halves = []
            for number, own in parts:
                along = units[own] @ self.further[level] - self.centres[node, level]
                halves += [(number, own[along < self.margin]), (number + (1 << level), own[along > -self.margin])]
            parts = [(number, own) for number, own in halves if len(own)]
        return parts


def grow_tree(units: np.ndarray, scale: float, first: int, random, given: Settings) -> tuple[Tree, list[tuple[int, int]]]:
    """A tree whose leaves are numbered from ``first``, and (number of sub-leaves, blocks of each) by leaf.

    Each sampled row stands for ``scale`` rows.
    """
    size = max(units.shape[1], 1)
    margin = given.spill / np.sqrt(size)
    directions, cuts, low, high, levels, middles = [], [], [], [], [], []
    leaves: list[tuple[int, int]] = []
    number = first
    # With each node goes the middle of the last ancestor that had rows enough to tell it.
    waiting = [(np.arange(len(units)), None, units.mean(axis=0) if len(units) else np.zeros(size))]
    while waiting:
        own, link, middle = waiting.pop()
        node = len(cuts)
        direction = random.normal(size=size)
        direction /= np.linalg.norm(direction)
        directions.append(direction)
        if link:
            link[0][link[1]] = node
        along = units[own] @ direction
        cut = float(np.median(along)) if len(own) else 0.0
        cuts.append(cut)
        if len(own) >= FEWEST:
            middle = units[own].mean(axis=0)
        left, right = own[along < cut + margin], own[along > cut - margin]
        tight = len(left) + len(right) - len(own) > given.tight * len(own)
        standing = len(own) * scale
        if standing <= given.leaf or len(own) < FEWEST or tight:
            more = 0 if tight and len(own) >= FEWEST else max(0, int(np.ceil(np.log2(max(standing, 1) / given.leaf))))
            low.append(-1)
            high.append(number)
            levels.append(more)
            middles.append(middle)
            leaves.append((1 << more, max(1, int(np.ceil(standing / (1 << more) / given.block)))))
            number += 1 << more
            continue
        low.append(0)
        high.append(0)
        levels.append(0)
        middles.append(None)
        waiting += [(left, (low, node), middle), (right, (high, node), middle)]
    depth = max(levels, default=0)
    further = random.normal(size=(depth, size))
    further /= np.maximum(np.linalg.norm(further, axis=1, keepdims=True), np.finfo(float).tiny)
    centres = np.zeros((len(cuts), depth))
    at = [n for n, middle in enumerate(middles) if middle is not None and levels[n]]
    if at:
        centres[at] = np.array([middles[n] for n in at]) @ further.T
    tree = Tree(
        np.array(directions), np.array(cuts), np.array(low), np.array(high), margin, np.array(levels), further, centres
    )
    return tree, leaves


def partners(units: np.ndarray, cosine: float, random) -> np.ndarray:
    """For each row one at the given cosine to it, in a random direction."""
    aside = random.normal(size=units.shape)
    aside -= (aside * units).sum(axis=1, keepdims=True) * units
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), np.finfo(float).tiny)
    return cosine * units + np.sqrt(1 - cosine**2) * aside


def meet(tree: Tree, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether row i of ``a`` and row i of ``b`` share a leaf."""
    found = np.zeros(len(a), bool)
    inside = dict(tree.leaves_of(a))
    for leaf, rows in tree.leaves_of(b):
        if leaf in inside:
            found[np.intersect1d(inside[leaf], rows, assume_unique=True)] = True
    return found


def grow(units: np.ndarray, rows: int, given: Settings) -> tuple[list[Tree], np.ndarray]:
    """The trees for ``rows`` rows of which ``units`` is a sample, and the blocks of the leaves.

    Leaves are numbered through all trees.
    """
    random = np.random.default_rng(given.seed)
    scale = rows / max(len(units), 1)
    probes = units[:PROBES]
    made = partners(probes, min(given.threshold + ABOVE, 1.0), random) if units.shape[1] > 1 else probes
    missed = np.ones(len(probes), bool)
    trees, counts, first = [], [], 0
    while len(trees) < given.trees or (len(trees) < given.most_trees and missed.mean() > 1 - given.recall):
        tree, leaves = grow_tree(units, scale, first, random, given)
        trees.append(tree)
        counts.append(np.repeat([blocks for _, blocks in leaves], [parts for parts, _ in leaves]))
        first += sum(parts for parts, _ in leaves)
        if len(probes):
            missed &= ~meet(tree, probes, made)
        else:
            missed = np.zeros(1, bool)
    return trees, np.concatenate(counts).astype(np.int32)


def unit_rows(vectors, width: int) -> np.ndarray:
    """Rows of length 1 in double precision; short vectors are filled with zeros."""
    out = np.zeros((len(vectors), width))
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    # Twice, first by the largest component, so that neither very small nor very large ones are lost.
    out /= np.maximum(np.abs(out).max(axis=1, keepdims=True, initial=0), np.finfo(float).tiny)
    return out / np.maximum(np.sqrt((out**2).sum(axis=1, keepdims=True)), np.finfo(float).tiny)


def local_roots(linked: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Smallest name reachable over the symmetric matrix ``linked``.

    Roots hook onto the smallest root next to any of their rows and paths are
    halved, so the matrix is read about as often as the logarithm of its rows.
    """
    count = len(names)
    order = np.argsort(names, kind="stable")
    place = np.empty(count, np.int64)
    place[order] = np.arange(count)
    # From here on a name is its place in their order.
    roots = place.copy()
    by_place = order
    while True:
        least = np.where(linked, roots[None, :], count).min(axis=1, initial=count)
        above = np.arange(count)
        np.minimum.at(above, roots, np.minimum(roots, least))
        while True:
            higher = above[above]
            if (higher == above).all():
                break
            above = higher
        lower = above[roots]
        if (lower == roots).all():
            return names[by_place[roots]]
        roots = lower


def shared_homes(a: list, b: list, below: int) -> np.ndarray:
    """Whether two rows also meet in a leaf numbered below ``below``."""
    codes = {}
    for homes in (*a, *b):
        for h in homes:
            if h < below:
                codes.setdefault(h, len(codes))
    lived = []
    for side in (a, b):
        table = np.zeros((len(side), len(codes)), np.float32)
        for row, homes in enumerate(side):
            table[row, [codes[h] for h in homes if h < below]] = 1
        lived.append(table)
    return (lived[0] @ lived[1].T) > 0 if codes else np.zeros((len(a), len(b)), bool)


def near_duplicates(rows: DataFrame, given: Settings = Settings()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``rows`` (vec_id, embedding).

    Two rows link when their cosine in double precision is at least
    ``given.threshold`` and they meet in a leaf of some tree. Equal vectors travel
    as one row and link with each other. Vectors that are NULL, zero or hold NULL
    or non-finite components, and rows without vec_id, link with nothing; the latter
    have a NULL component and are not kept. A vec_id that comes more than once is
    several vectors of one component. Shorter vectors are filled with zeros.
    """
    given_rows = rows.select("vec_id", "embedding")
    fits = F.col("vec_id").isNotNull() & usable(F.col("embedding")) & F.exists("embedding", lambda x: x != 0)
    good = given_rows.where(fits)
    distinct = stage(
        good.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")),
        "forest-vectors",
    )
    count, width = distinct.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    sample = distinct.orderBy(F.xxhash64("embedding"), "node").limit(given.sample).select("embedding").collect()
    trees, blocks = grow(unit_rows([r[0] for r in sample], width or 1), count, given)
    # Bounded by the sample: at most one direction for every few sampled rows of each tree.
    forest = rows.sparkSession.sparkContext.broadcast((trees, blocks))
    kind = distinct.schema["embedding"].dataType.simpleString()

    def route(batches):
        trees, blocks = forest.value
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.iloc[at : at + 2048]
                units = unit_rows(part["embedding"].to_list(), width)
                homes = [[] for _ in range(len(part))]
                for tree in trees:
                    for leaf, reached in tree.leaves_of(units):
                        for row in reached:
                            homes[row].append(leaf)
                nodes = part["node"].to_numpy()
                out = []
                for row, own in enumerate(homes):
                    for leaf in own:
                        own_block = int(nodes[row] * 0x9E3779B1 % 0x7FFFFFFF % blocks[leaf])
                        out += [
                            (leaf, min(own_block, x), max(own_block, x), own_block, row) for x in range(blocks[leaf])
                        ]
                if out:
                    leaf, first, second, own_block, row = map(list, zip(*out))
                    taken = part.iloc[row]
                    yield pd.DataFrame(
                        {
                            "leaf": leaf,
                            "first": first,
                            "second": second,
                            "block": own_block,
                            "node": taken["node"].to_numpy(),
                            "copies": taken["copies"].to_numpy(),
                            "embedding": taken["embedding"].to_numpy(),
                            "homes": [homes[r] for r in row],
                        }
                    )

    def compare(members: pd.DataFrame) -> pd.DataFrame:
        leaf, first, second = (int(members[c].iloc[0]) for c in ("leaf", "first", "second"))
        members = members.sort_values("node", ignore_index=True)
        nodes, copies = members["node"].to_numpy(np.int64), members["copies"].to_numpy(np.int64)
        units = unit_rows(members["embedding"].to_list(), width)
        linked = units @ units.T >= given.threshold
        if first != second:
            side = members["block"].to_numpy()
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        some = np.flatnonzero(linked.any(axis=1))
        linked = linked[np.ix_(some, some)]
        homes = members["homes"].iloc[some].to_list()
        fresh = linked & ~shared_homes(homes, homes, leaf)
        return pd.DataFrame(
            {
                "node": nodes[some],
                "links": (fresh @ copies[some].astype(float)).astype(np.int64),
                "root": local_roots(linked, nodes[some]),
            }
        )

    routed = distinct.mapInPandas(
        route,
        f"leaf int, first int, second int, block int, node long, copies long, embedding {kind}, homes array<int>",
    )
    met = stage(
        routed.groupBy("leaf", "first", "second").applyInPandas(compare, "node long, links long, root long"),
        "forest-links",
    )
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    groups = (
        distinct.join(links, "node", "left")
        .join(roots, "node", "left")
        .select(
            F.col("embedding").alias("__embedding"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "node").alias("component_id"),
        )
    )
    linked = good.join(groups, F.col("embedding") == F.col("__embedding"), "inner").select(
        "vec_id", "n_links", "component_id"
    )
    alone = given_rows.where(~fits).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )


ship_by_value(__name__)
