"""Parquet outputs, JSON reports and the published table."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom import schemas
from listingloom.storage import CODEC, shuffles_freed


def write_table(df: DataFrame, path: str) -> None:
    """One table folder. Files stay as many as there are tasks: one file for
    everything would send the whole table through one of them."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def write_partitioned(df: DataFrame, path: str, by: str = "source_name") -> None:
    """A folder per value of ``by``.

    Rows are gathered by value so that small sources give few files; the
    rebalance hint lets Spark split a source that is large.
    """
    dealt = df.hint("rebalance", F.col(by))
    with shuffles_freed(df.sparkSession):
        dealt.write.mode("overwrite").option("compression", CODEC).partitionBy(by).parquet(path)


def reject_report(rejected: DataFrame) -> DataFrame:
    """All rejected rows with the rules they break."""
    return rejected.select(*schemas.REJECT_COLUMNS)


def duplicate_report(found: DataFrame) -> DataFrame:
    """All duplicates."""
    return found.select(*schemas.DUPLICATE_COLUMNS)


def report_head(report: DataFrame, rows: int) -> DataFrame:
    """The first rows of a report in a fixed order, to be shown."""
    return report.orderBy("source_name", "product_id", "product_name", "price").limit(rows)


def write_report(report: DataFrame, path: str, by: str | None = None) -> None:
    """A whole report as JSON lines, in a folder per value of ``by`` if given."""
    with shuffles_freed(report.sparkSession):
        if by is None:
            report.write.mode("overwrite").json(path)
        else:
            report.hint("rebalance", F.col(by)).write.mode("overwrite").partitionBy(by).json(path)


ALL_SOURCES = "all sources"


COUNTS = ["before_validate", "after_validate", "after_dedup", "bad_products", "malformed_records"]


def count_table(
    spark: SparkSession, read: dict[str, int], checked: dict[str, dict[str, int]], kept: dict[str, dict[str, int]]
) -> DataFrame:
    """A row per source that has any rows, from counts that the run's writes brought along."""
    rows = [
        {"source_name": source, "before_validate": number, **checked[source], **kept[source]}
        for source, number in read.items()
        if number or any(checked[source].values())
    ]
    return spark.createDataFrame(
        [tuple(row[c] for c in ("source_name", *COUNTS)) for row in rows],
        "source_name string, " + ", ".join(f"{c} bigint" for c in COUNTS),
    )


def run_summary(
    counts: DataFrame,
    rejected: DataFrame | None,
    run_ts: str,
    outputs: dict[str, str],
    source_files: dict[str, str],
) -> DataFrame:
    """A row per source about a run, and one for all sources.

    ``counts`` is the stage-count table, ``rejected`` the rejected rows with
    their errors, ``source_files`` the feed that each source was read from. Without
    ``rejected``, ``counts`` has all five numbers.
    """
    if rejected is not None:
        malformed = F.array_contains("validation_errors", "malformed_record")
        bad = rejected.groupBy("source_name").agg(
            F.count(F.lit(1)).alias("bad_products"), F.count_if(malformed).alias("malformed_records")
        )
        counts = counts.unionByName(bad, allowMissingColumns=True)
    totals = counts.rollup("source_name").agg(
        F.grouping("source_name").alias("is_total"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS],
    )

    def as_map(names: dict[str, str]) -> Column:
        pairs = [F.lit(x) for item in names.items() for x in item]
        return F.create_map(*pairs).cast("map<string,string>")

    return totals.select(
        F.lit(run_ts).alias("processed_at"),
        F.lit("pyspark").alias("engine"),
        F.when(F.col("is_total") == 1, ALL_SOURCES).otherwise(F.col("source_name")).alias("source_name"),
        as_map(source_files)[F.col("source_name")].alias("source_file"),
        F.col("before_validate").alias("total_before_validate"),
        F.col("after_validate").alias("total_valid_before_dedup"),
        F.col("after_dedup").alias("total_after_dedup"),
        "bad_products",
        "malformed_records",
        (F.col("after_validate") - F.col("after_dedup")).alias("duplicate_products"),
        as_map(outputs).alias("outputs"),
    )


def publish_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Names the Parquet folder ``path``; returns the table.

    A view on the folder is replaced in one step, so readers never find the
    name missing. Each run writes its own folder and publishes it afterwards.
    """
    if not path:
        raise ValueError("no folder to publish")
    folder = re.sub(r"^s3://", "s3a://", path)
    spark.read.parquet(folder).createOrReplaceTempView(name)
    return spark.table(name)


def publish_external_table(
    spark: SparkSession, name: str, path: str, schema: T.StructType = schemas.PRODUCT
) -> DataFrame:
    """The same as an external table of the session's catalog, for other sessions.

    The table has the columns of ``schema`` whatever files it points at, and
    dropping it leaves the folder. A table that exists is pointed at the new
    folder in one step, so its readers never miss it.
    """
    if not path:
        raise ValueError("no folder to publish")
    folder = re.sub(r"^s3://", "s3a://", path).replace("'", "\\'")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=folder, source="parquet", schema=schema)
    return spark.table(name)


def describe_table(table: DataFrame) -> DataFrame:
    """Column names and types in order."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(table.schema.fields)]
    return table.sparkSession.createDataFrame(
        rows, "position int, column_name string, data_type string"
    )
