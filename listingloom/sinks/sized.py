"""Parquet tables in files of a wanted size.

How large a file gets is known only when it is written, so sizes are planned from
measured bytes: every row has a place on a line as long as the stored parts, by its
file and its number in it, and the line is cut into equal pieces, a file each.
Parts that are too large are cut, small ones are put together. One piece is written
first, to learn what the rows weigh in files of that size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listingloom.storage import stage, work_dir

TARGET_BYTES = 256 << 20
_PLACE, _PIECE = "_place", "_piece"


def measured_parts(spark: SparkSession, folder: str) -> DataFrame:
    """``file_path``, ``bytes`` and ``rows`` of each file, and the ``offset`` of its first byte among all.

    Rows are counted from the files' footers. One row per file, so the running sum
    is over a listing.
    """
    parts = (
        spark.read.parquet(folder)
        .select("_metadata.file_path", F.col("_metadata.file_size").alias("bytes"))
        .groupBy("file_path", "bytes")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    before = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("offset", F.coalesce(F.sum("bytes").over(before), F.lit(0)))


def placed_rows(spark: SparkSession, folder: str, parts: DataFrame) -> DataFrame:
    """The rows of a table with their place, in bytes, on the line of all its files."""
    rows = spark.read.parquet(folder)
    numbered = rows.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("_row"))
    place = F.col("offset") + F.col("_row") * (F.col("bytes") / F.col("rows"))
    return numbered.join(parts, "file_path", "inner").select(*rows.columns, place.alias(_PLACE))


def _write_pieces(placed: DataFrame, columns: list[str], pieces: int, width: float, path: str) -> None:
    piece = F.least(F.floor(F.col(_PLACE) / F.lit(width)), F.lit(pieces - 1)).cast("int")
    cut = placed.withColumn(_PIECE, piece)
    if pieces > 1:
        cut = cut.repartitionById(pieces, F.col(_PIECE))
    else:
        cut = cut.repartition(1)
    cut.sortWithinPartitions(_PLACE).select(*columns).write.mode("overwrite").parquet(path)


def compact(spark: SparkSession, folder: str, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Writes the table of ``folder`` to ``path`` in files of about ``target_bytes``; returns their number.

    A task writes one file. One file for all is the case of a target beyond the
    table's size: that task sorts the whole table, so it is for exports whose size
    is known to suit one machine. An empty table becomes an empty table.
    """
    # Stored, so that Spark sees how small it is and sends it to the rows; they would be shuffled by file to meet it.
    parts = stage(measured_parts(spark, folder), "sized-places")
    columns = spark.read.parquet(folder).columns
    total = parts.agg(F.sum("bytes")).first()[0] or 0
    if not total:
        spark.read.parquet(folder).write.mode("overwrite").parquet(path)
        return 0
    placed = placed_rows(spark, folder, parts)
    weight, pieces = 1.0, round(total / target_bytes)
    if pieces > 1:
        # What the first piece weighs once it is one file, compared with what it was counted as.
        trial = work_dir(spark, "sized-trial")
        first = placed.where(F.col(_PLACE) < target_bytes)
        _write_pieces(first, columns, 1, float(target_bytes), trial)
        written = measured_parts(spark, trial).agg(F.sum("bytes")).first()[0] or 0
        weight = written / target_bytes if written else 1.0
    pieces = max(1, round(total * weight / target_bytes))
    _write_pieces(placed, columns, pieces, total / pieces, path)
    return pieces


def write_sized(df: DataFrame, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Writes a frame in files of about ``target_bytes``. It is stored in parallel first, then put together."""
    parts = work_dir(df.sparkSession, "sized-parts")
    df.write.parquet(parts)
    return compact(df.sparkSession, parts, path, target_bytes)
