"""What several training-data operators share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows whose checksum leaves no rest by this number are never learnt from.
FOLDS = 5


def ship_by_value(module: str) -> None:
    """Send the functions of ``module`` to tasks whole, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows kept for testing; a NULL id is never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def word_count(text: Column) -> Column:
    """Number of words in the whole text, 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


ship_by_value(__name__)
