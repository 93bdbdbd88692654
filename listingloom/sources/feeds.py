"""Raw JSON feeds: JSON Lines files and JSON array files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom.sources.json_array import read_json_array

CORRUPT = "_corrupt_record"
# Side files that share a feed's folder.
SIDE_FILE_NAMES = ["summary", "stats"]


def read_feed(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of a ``.jsonl`` file (one object a line) or of a JSON array file.

    With a schema there is no inference pass over the file; records that do not
    fit keep what parsed and show up whole in ``_corrupt_record``. Both forms are
    split across tasks, array files by :mod:`json_array`. Without a schema an array
    file is inferred and read by one task.
    """
    is_lines = path.rstrip("/").endswith(".jsonl")
    if schema is not None and not is_lines:
        return read_json_array(spark, path, schema, CORRUPT).drop("raw_file")
    reader = spark.read.option("columnNameOfCorruptRecord", CORRUPT)
    if schema is not None:
        # A new schema object: StructType.add would change the caller's.
        fields = [*schema.fields, T.StructField(CORRUPT, T.StringType())]
        reader = reader.schema(T.StructType(fields))
    if is_lines:
        return reader.option("lineSep", "\n").json(path)
    return reader.option("multiline", True).json(path)


def with_raw_file(df: DataFrame, path: str | None = None) -> DataFrame:
    """Adds ``raw_file``: the given path, or the file each row was read from."""
    return df.withColumn("raw_file", F.lit(path) if path else F.col("_metadata.file_path"))


def list_feed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and modification time of the feed files below a folder.

    The file contents are pruned from the listing, so nothing is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "modificationTime")
    )
    name = F.lower(below(folder))
    return files.filter(~name.rlike("|".join(SIDE_FILE_NAMES)))


def below(folder: str) -> Column:
    """The part of ``path`` below ``folder``, whichever scheme it is written with."""
    base = folder.rstrip("/").split("://")[-1] + "/"
    return F.substring_index("path", base, -1)


def latest_feed_file(files: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The newest file (per group); of equally old files the last path."""
    newest = F.max_by("path", F.struct("modificationTime", "path")).alias("path")
    return files.groupBy(*(by or [])).agg(newest)


def feed_entries(files: DataFrame, root: str) -> DataFrame:
    """Feeds below ``root/<source>/`` with the time of their newest part.

    A feed is the entry directly below its source's folder: one file, or a
    folder with all the parts that a distributed writer left.
    """
    steps = F.split(below(root), "/")
    base = F.expr("left(path, length(path) - length(_below))")
    return (
        files.withColumn("_below", below(root))
        .where(F.size(steps) > 1)
        .select(
            steps[0].alias("source_name"),
            F.concat(base, steps[0], F.lit("/"), steps[1]).alias("path"),
            "modificationTime",
        )
        .groupBy("source_name", "path")
        .agg(F.max("modificationTime").alias("modificationTime"))
    )


def find_latest_feeds(
    spark: SparkSession, root: str, sources: list[str]
) -> dict[str, str]:
    """Newest feed of each source that has any, below ``root/<source>/``."""
    feeds = feed_entries(list_feed_files(spark, root), root)
    newest = latest_feed_file(feeds.filter(F.col("source_name").isin(sources)), ["source_name"])
    # At most one row per known source.
    return {row["source_name"]: row["path"] for row in newest.collect()}
