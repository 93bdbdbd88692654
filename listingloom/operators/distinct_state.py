"""Exact distinct counts as mergeable state: bitmaps over dense ids.

A distinct count of raw ids cannot be added up over days. Its bitmap can: each id
gets a dense number once, each day stores which numbers it saw per group, 2^15 of
them to a row, and the bitmaps of any days are joined by OR. A new day is counted
alone; no old row is read again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingloom.storage import stage

# Executors get the functions themselves, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Parts in which new ids are numbered, each for itself.
SHARDS = 256
BUCKET, BITMAP = "_bucket", "_bitmap"


def new_ids(known: DataFrame | None, ids: DataFrame, id_col: str) -> DataFrame:
    """``id_col`` and ``number`` of the ids that ``known`` lacks, numbered on from its highest.

    NULL ids get no number. Numbers are dense from 0: new ids are counted per hash
    shard, the shards are laid end to end, and an id's number is its place in its
    shard. One row per shard is all that meets in a task. Stored, so that a number,
    once given, is not worked out again.
    """
    new = ids.where(F.col(id_col).isNotNull()).select(id_col).distinct()
    first = 0
    if known is not None:
        new = new.join(known.select(id_col), id_col, "left_anti")
        first = known.agg(F.coalesce(F.max("number") + 1, F.lit(0))).first()[0]
    sharded = stage(new.withColumn("shard", F.pmod(F.xxhash64(id_col), F.lit(SHARDS)).cast("int")), "distinct-new")
    sizes = sharded.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("shard", (F.coalesce(F.sum("size").over(before), F.lit(0)) + first).alias("offset"))
    place = F.row_number().over(Window.partitionBy("shard").orderBy(id_col)) - 1
    return stage(
        sharded.withColumn("place", place)
        .join(offsets, "shard", "inner")
        .select(id_col, (F.col("offset") + F.col("place")).alias("number")),
        "distinct-ids",
    )


def seen(rows: DataFrame, by: list[str | Column], number: str, when: dict[str, Column] | None = None) -> DataFrame:
    """The state of ``rows``: a row per group and bucket, one bitmap per test.

    ``when`` names the distinct counts wanted and the rows that count for each; by
    default it is one, ``_bitmap``, of all rows. Rows without a number count nowhere.
    """
    tests = when or {BITMAP: F.lit(True)}
    keys = [F.col(c) if isinstance(c, str) else c for c in by]
    # Numbers travel, not bitmaps of a few bits each; a group and bucket has at most 2^15 different ones.
    told = (
        rows.where(F.col(number).isNotNull())
        .select(*keys, F.col(number).alias("_number"), *[test.alias(name) for name, test in tests.items()])
        .distinct()
        .withColumn(BUCKET, F.bitmap_bucket_number(F.col("_number") + 1))
    )
    groups = [c for c in told.columns if c not in ("_number", *tests)]
    return told.repartition(*groups).groupBy(*groups).agg(
        *[F.bitmap_construct_agg(F.when(F.col(name), F.bitmap_bit_position(F.col("_number") + 1))).alias(name) for name in tests]
    )


def merged(states: DataFrame, by: list[str], names: list[str] | None = None) -> DataFrame:
    """States of several days as one, by fewer or the same columns."""
    return states.groupBy(*by, BUCKET).agg(*[F.bitmap_or_agg(name).alias(name) for name in names or [BITMAP]])


def counts(states: DataFrame, by: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """Exact distinct counts over all given states: bitmap columns to the names of their counts."""
    names = names or {BITMAP: "total"}
    joined = merged(states, by, list(names))
    return joined.groupBy(*by).agg(
        *[F.sum(F.bitmap_count(bitmap)).cast("bigint").alias(name) for bitmap, name in names.items()]
    )


def without(states: DataFrame, names: list[str], off: str) -> DataFrame:
    """``states`` with the numbers of bitmap ``off`` taken out of the bitmaps ``names``; ``off`` itself goes."""
    kept = [c for c in states.columns if c not in (*names, off)]

    def cleared(own: bytes | None, gone: bytes | None) -> bytes | None:
        if own is None or gone is None:
            return own
        return (np.frombuffer(own, np.uint8) & ~np.frombuffer(gone, np.uint8)).tobytes()

    def clear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                gone = batch.column(off).to_pylist()
                left = [pa.array(map(cleared, batch.column(n).to_pylist(), gone), pa.binary()) for n in names]
                yield pa.RecordBatch.from_arrays([*map(batch.column, kept), *left], [*kept, *names])

    types = [f"`{c}` {states.schema[c].dataType.simpleString()}" for c in (*kept, *names)]
    return states.select(*kept, *names, off).mapInArrow(clear, ", ".join(types))
