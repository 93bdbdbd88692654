"""Checks on the published table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingloom import schemas
from listingloom.functions.web import non_empty

ALLOWED_SOURCE_COUNTS = [4, 5]


def table_sample(df: DataFrame, rows: int = schemas.SAMPLE_ROWS, order_by: list[str] | None = None) -> DataFrame:
    """A few rows, the first ones in the given order if any."""
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def crawl_moment(time: Column) -> Column:
    """Crawl time text as a timestamp without zone, NULL if it is none."""
    return time.try_cast("timestamp_ntz")


def freshness_check(df: DataFrame, time: str = "crawl_time") -> DataFrame:
    """One row: number of rows and the newest crawl time that can be read."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.max(crawl_moment(F.col(time))).alias("last_crawl_time"),
    )


def source_coverage(
    df: DataFrame,
    required: list[str] = schemas.REQUIRED_SOURCES,
    optional: list[str] = schemas.OPTIONAL_SOURCES,
    source: str = "source_name",
) -> DataFrame:
    """Each known or found source as present, missing or unexpected."""
    known = df.sparkSession.createDataFrame(
        [(s, "required") for s in required] + [(s, "optional") for s in optional],
        "source_name string, expectation string",
    )
    found = df.select(non_empty(F.col(source)).alias("source_name")).dropna().distinct()
    status = (
        F.when(F.col("expectation").isNull(), "unexpected")
        .when(F.col("is_found"), "present")
        .otherwise(F.concat(F.lit("missing_"), F.col("expectation")))
    )
    return (
        found.withColumn("is_found", F.lit(True))
        .join(known, "source_name", "full")
        .select("source_name", status.alias("status"))
    )


def dataset_gate(
    df: DataFrame,
    required: list[str] = schemas.REQUIRED_SOURCES,
    optional: list[str] = schemas.OPTIONAL_SOURCES,
    source: str = "source_name",
    time: str = "crawl_time",
    source_counts: list[int] = ALLOWED_SOURCE_COUNTS,
) -> DataFrame:
    """One row per check: ``check_name, passed, detail``. Optional sources only warn.

    One pass over two columns: the table shrinks to a row per source, and those
    to one row of counts. Found names are never gathered, so a table whose
    source column holds anything at all is still checked.
    """
    per_source = df.groupBy(non_empty(F.col(source)).alias("s")).agg(
        F.count(F.lit(1)).alias("n"), F.max(crawl_moment(F.col(time))).alias("t")
    )
    known = [*required, *optional]
    facts = per_source.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("s").alias("sources"),
        F.count_if(F.col("s").isNotNull() & ~F.col("s").isin(known)).alias("unexpected"),
        F.max("t").alias("newest"),
        *[F.coalesce(F.bool_or(F.col("s") == name), F.lit(False)).alias(f"has_{i}")
          for i, name in enumerate(known)],
    )

    def missing(names: list[str]) -> Column:
        absent = [
            F.when(~F.col(f"has_{known.index(name)}"), F.lit(name)) for name in sorted(names)
        ]
        return F.concat_ws(",", *absent)

    def check(name: str, passed: Column, detail: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            passed.alias("passed"),
            detail.cast("string").alias("detail"),
        )

    newest = F.date_format("newest", "yyyy-MM-dd HH:mm:ss")
    checks = [
        check("has_rows", F.col("rows") > 0, F.col("rows")),
        check("required_sources", missing(required) == "", missing(required)),
        check("optional_sources", F.lit(True), missing(optional)),
        check("unexpected_sources", F.col("unexpected") == 0, F.col("unexpected")),
        check("source_count", F.col("sources").isin(source_counts), F.col("sources")),
        check("crawl_time", F.col("newest").isNotNull(), F.coalesce(newest, F.lit("none"))),
    ]
    return facts.select(F.inline(F.array(*checks)))


def require_passed(gate: DataFrame) -> None:
    """Raises if any check failed. The gate has one row per check."""
    failed = [f"{r['check_name']} ({r['detail']})" for r in gate.collect() if not r["passed"]]
    if failed:
        raise ValueError("dataset checks failed: " + "; ".join(failed))
