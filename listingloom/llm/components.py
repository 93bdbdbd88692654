"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingloom.storage import stage


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for every node that has a smaller one in reach.

    ``links`` has columns ``a`` and ``b``; direction, repeats and loops do not
    matter, rows with NULL are dropped. In each round every node keeps a link to
    its smallest neighbour only and hands its other smaller neighbours to that
    one, until each node has one link. Chains of such links are then halved until
    all end at a root. Only aggregations and joins are used, every round is
    stored, and nothing is collected but one count per round.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("low")).distinct(),
        "components-links",
    )
    while True:
        lowest = edges.groupBy("node").agg(F.min("low").alias("root"), F.count(F.lit(1)).alias("links"))
        if lowest.where("links > 1").isEmpty():
            break
        known = edges.join(lowest.select("node", "root"), "node", "inner")
        handed = known.where("low <> root").select(F.col("low").alias("node"), F.col("root").alias("low"))
        kept = lowest.select("node", F.col("root").alias("low"))
        edges = stage(handed.unionByName(kept).distinct(), "components-round")
    parents = stage(edges.select("node", F.col("low").alias("root")), "components-parents")
    while True:
        above = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        inner = parents.select("root").distinct().join(above, "root", "inner")
        if inner.isEmpty():
            return parents
        moved = parents.join(inner, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
        parents = stage(moved, "components-halved")
