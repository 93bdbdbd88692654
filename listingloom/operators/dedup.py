"""Which of several rows about the same thing stays.

All rankings are plain ``row_number() = 1`` windows. Spark keeps only the best
row of each key per task before it shuffles them, so a key that holds a third
of the table reaches its task as one row per upstream task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_key(
    product_id: Column, product_url: Column, name_key: Column, product_name: Column
) -> Column:
    """What identifies a row within its source: id, else url, else name.

    The raw name stands in for names without any key character, so that these
    do not fall into one group. Blank values identify nothing; a row with
    nothing else has no key.
    """
    parts = (product_id.cast("string"), product_url, name_key, product_name)
    return F.coalesce(*[F.when(F.trim(part) != "", part) for part in parts])


def _best_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rn") == 1).drop("_rn")


def latest_one(
    df: DataFrame, keys: list[str], time: str, tie_breaks: list[Column]
) -> DataFrame:
    """The newest row per key. NULL times lose; ``tie_breaks`` settle equal times."""
    return _best_row(df, keys, [F.col(time).desc_nulls_last(), *tie_breaks])


def latest_or_keyless(
    df: DataFrame, keys: list[str], key: str, time: str, tie_breaks: list[Column]
) -> DataFrame:
    """The newest row per key, and every row whose ``key`` is NULL.

    Rows that nothing identifies are no versions of one thing. They stay out
    of the window, so their number does not gather in one task either.
    """
    known = latest_one(df.where(F.col(key).isNotNull()), keys, time, tie_breaks)
    return known.unionByName(df.where(F.col(key).isNull()))


def latest_all_ties(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """Every row that carries its key's newest time; rows without a time never do.

    A join with the per-key maximum rather than a rank: ties of a hot key stay
    spread out, since a skewed join can be split and a window cannot.
    """
    newest = df.groupBy(*keys).agg(F.max(time).alias(time))
    return df.join(newest, [*keys, time]).select(*df.columns)


def first_wins(
    df: DataFrame, keys: list[str], order: list[Column], drop_null_keys: bool = True
) -> DataFrame:
    """The first row per key in feed order, rows without a key dropped."""
    if drop_null_keys:
        df = df.dropna("any", subset=keys)
    return _best_row(df, keys, [o.asc() for o in order])
