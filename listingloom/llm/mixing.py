"""Mixing sources to target weights by Pareto order sampling.

Every document of a source is due the same number of copies, target words over
source words. The whole part is certain. For the rest the documents are ranked
by their random odds over their inclusion odds, and the first ones are taken
until the source has its words: a sample of fixed size with unequal inclusion
probabilities where a weight column is given.

The ranking of a source is never brought into one task. A histogram of the
ranks gives each cell of each source the words that lie before it; inside a cell a
window adds up the rest. Random numbers come from the id and a seed, so a rerun
or a retried task takes the same documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingloom.llm.common import word_count
from listingloom.storage import stage

#: Weights of the sources in code point order, repeating.
CYCLE = (5, 2, 1)
#: No source gives more than this many times its own words.
MOST_COPIES = 3
#: Cells of a source's ranking.
CELLS = 4096


def source_targets(sizes: DataFrame, cycle: tuple[int, ...] = CYCLE, most: int = MOST_COPIES) -> DataFrame:
    """``source``, ``source_size`` and ``target`` for rows of ``source`` and ``size``.

    The sources share all words by weight. A target stops at ``most`` times its
    source's words; what is cut off is shared by weight among the others. Sorted
    by the share at which they stop, the sources that stop are the first ones, so
    running sums find the common share. The window runs over one row per source,
    NULL being one of them and the last.
    """
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(cycle)
    weighted = per_source.withColumn("weight", F.element_at(F.array(*map(F.lit, cycle)), (place + 1).cast("int")))
    weighted = weighted.withColumn("most", F.col("source_size") * most).withColumn(
        "stop", F.col("most").cast("double") / F.col("weight")
    )
    by_stop = Window.orderBy("stop", F.col("source").asc_nulls_last())
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = weighted.withColumn("share", left.cast("double") / weight_left)
    share = F.min(F.when(F.col("share") <= F.col("stop"), F.struct("stop", "share"))).over(whole)["share"]
    return shared.withColumn("common", share).select(
        "source",
        "source_size",
        F.coalesce(F.least(F.col("common") * F.col("weight"), F.col("most").cast("double")), F.lit(0.0)).alias("target"),
    )


def uniform(doc_id: Column, seed: str) -> Column:
    """A number from 0 to below 1 that depends on the id and the seed only."""
    text = F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substr(F.md5(text.cast("binary")), F.lit(1), F.lit(13))
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(2**52))


def _safe_odds(p: Column) -> Column:
    """p / (1 - p) for a p from 0 to below 1."""
    return p / (1 - p)


def ranks(sized: DataFrame, targets: DataFrame, seed: str, weight: str | None) -> DataFrame:
    """Rows with their ``__rank`` in the source and the ``__cell`` of it, an even share of the source's rows."""
    given = F.col(weight).cast("double") if weight else F.lit(1.0)
    new = ("source_size", "target", "copies", "taken")
    sized = sized.withColumn("__weight", F.greatest(F.coalesce(given, F.lit(0.0)), F.lit(0.0))).drop(*new)
    joined = sized.join(
        targets.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")), "inner"
    ).drop("__source")
    due = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    u = F.col("__u")
    chance = F.col("__chance")
    ranked = (
        joined.withColumn("__whole", F.floor(due))
        .withColumn("__need", F.col("target") - F.col("__whole") * F.col("source_size"))
        .withColumn("__part", due - F.col("__whole"))
        .withColumn("__chance", F.col("__part"))
        .withColumn("__u", uniform(F.col("doc_id"), seed))
    )
    if weight:
        totals = sized.groupBy(F.col("source").alias("__source")).agg(
            F.sum(F.col("__weight") * F.col("size")).alias("__weighted")
        )
        ranked = ranked.join(totals, F.col("source").eqNullSafe(F.col("__source")), "inner").drop("__source")
        scale = F.when(F.col("__weighted") > 0, F.col("source_size") / F.col("__weighted")).otherwise(0.0)
        ranked = ranked.withColumn("__chance", chance * F.col("__weight") * scale)
    # Certain rows come first, those without a chance last, both spread by their random numbers. Between them,
    # times the odds of the source's mean chance, ranks spread like the random numbers again.
    drawn = (chance > 0) & (chance < 1)
    rank = F.when(drawn, _safe_odds(u) / _safe_odds(F.least(chance, F.lit(1 - 1e-12)))).otherwise(u)
    scaled = F.col("__rank") * _safe_odds(F.least(F.col("__part"), F.lit(1 - 1e-12)))
    cell = (
        F.when(drawn, F.least(F.floor((1 - 1 / (1 + scaled)) * CELLS), F.lit(CELLS - 1)))
        .when(chance > 0, F.floor(u * CELLS) - CELLS)
        .otherwise(F.floor(u * CELLS) + CELLS)
    )
    return ranked.withColumn("__rank", rank).withColumn("__cell", cell.cast("int"))


def mix(sized: DataFrame, targets: DataFrame, seed: str = "mix", weight: str | None = None) -> DataFrame:
    """``sized`` with ``source_size``, ``target``, ``copies`` and ``taken`` for every row.

    ``sized`` holds doc_id, source, ``size`` (words) and any further columns (those of
    the four new names give way to the new ones);
    ``targets`` comes from :func:`source_targets`. ``weight`` names a column of
    relative chances within a source; NULL or negative counts as 0, which comes last,
    and without it all are alike. A document gets the whole copies it is due and one more if
    the ranking takes it, so its words never exceed the copies of its source. The
    last document of a ranking is taken if that brings the source nearer its
    target, so the error is at most half a document.

    Repeated rows are documents of their own with equal ranks; ties go by id, then
    size. Empty documents take no words. A source without words has target 0. No
    rows give no rows.
    """
    own = [name for name in sized.columns if name not in ("source_size", "target", "copies", "taken")]
    ranked = ranks(sized, targets, seed, weight)
    cells = ranked.groupBy("source", "__cell").agg(F.sum("size").alias("__words"))
    upto = Window.partitionBy("source").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select(
        F.col("source").alias("__source"),
        F.col("__cell").alias("__at"),
        F.coalesce(F.sum("__words").over(upto), F.lit(0)).alias("__offset"),
    )
    inside = Window.partitionBy("source", "__cell").orderBy("__rank", "doc_id", "size")
    summed = ranked.withColumn(
        "__inside",
        F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    before = F.col("__offset") + F.col("__inside")
    extra = ((F.col("__need") - before) * 2 >= F.col("size")) & (F.col("__need") > 0)
    mixed = (
        summed.join(
            offsets, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__cell") == F.col("__at")), "inner"
        )
        .withColumn("copies", (F.col("__whole") + F.when(extra, 1).otherwise(0)).cast("long"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
    return mixed.select(*own, "source_size", "target", "copies", "taken")


def mix_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, copies and taken of every document.

    Words are counted once and stored with the ids; the sampling works on that
    small table. NULL text has size 0. Other columns are ignored.
    """
    sized = stage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mix-sizes")
    targets = stage(source_targets(sized), "mix-targets")
    return mix(sized, targets, seed).drop("source")


def repeat_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself: each document's row once per copy, with the columns of ``docs``."""
    own = docs.columns
    packed = docs.select(
        F.struct(*own).alias("__row"), "doc_id", "source", word_count(F.col("text")).alias("size")
    )
    targets = stage(source_targets(packed), "mix-targets")
    mixed = mix(packed, targets, seed).where("copies > 0")
    return mixed.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(
        *[F.col("__row").getField(name).alias(name) for name in own]
    )
