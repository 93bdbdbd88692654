"""Row validation, and counts over rows, feeds and runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingloom.sources.feeds import CORRUPT

# What became of a product's detail lookup, by summary column.
DETAIL_COUNTS = {
    "detail_success": "success",
    "detail_missing": "missing_product_url",
    "no_flashsale_data": "no_flashsale_data",
    "no_flashsale_response": "no_flashsale_response",
    "detail_error": "error",
}


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def add_validation_errors(
    df: DataFrame,
    name: str = "product_name",
    price: str = "price",
    original_price: str = "original_price",
) -> DataFrame:
    """Adds ``validation_errors``, the list of rules a row breaks (empty if none).

    A reader's column of unreadable lines, if there, is a rule of its own.
    """
    rules = {
        "missing_product_name": is_blank(F.col(name)),
        "invalid_price_negative": F.col(price) < 0,
        "invalid_original_price_negative": F.col(original_price) < 0,
    }
    if CORRUPT in df.columns:
        rules["malformed_record"] = F.col(CORRUPT).isNotNull()
    broken = [F.when(test, F.lit(label)) for label, test in rules.items()]
    return df.withColumn("validation_errors", F.array_compact(F.array(*broken)))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("validation_errors") == 0).drop("validation_errors")


def rejected_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("validation_errors") > 0)


def stage_counts(
    before: DataFrame, valid: DataFrame, survivors: DataFrame, by: str = "source_name"
) -> DataFrame:
    """Rows per source before validation, after it and after duplicates are gone."""
    stages = {"before_validate": before, "after_validate": valid, "after_dedup": survivors}
    counts = [
        df.groupBy(by).agg(F.count(F.lit(1)).alias(stage)) for stage, df in stages.items()
    ]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return merged.groupBy(by).agg(
        *[F.coalesce(F.sum(stage), F.lit(0)).alias(stage) for stage in stages]
    )


def feed_totals(feed: DataFrame, by: list[str]) -> DataFrame:
    """Products per feed and run."""
    return feed.groupBy(*by).agg(F.count(F.lit(1)).alias("total_products"))


def crawl_summary(catalog: DataFrame, by: str = "source_name") -> DataFrame:
    """Categories, responses, products and detail outcomes of a catalog feed.

    Counts inside each response's product array, so no product row is made.
    """
    products = F.col("body.product_list")

    def with_status(status: str) -> Column:
        hits = F.filter(products, lambda p: p["detail_status"] == status)
        return F.coalesce(F.sum(F.greatest(F.size(hits), F.lit(0))), F.lit(0))

    return catalog.groupBy(by).agg(
        F.count_distinct("source_category_name").alias("total_subcategories_collected"),
        F.count(F.lit(1)).alias("total_catalog_responses"),
        F.sum(F.greatest(F.size(products), F.lit(0))).alias("total_products"),
        *[with_status(status).alias(name) for name, status in DETAIL_COUNTS.items()],
    )


def completeness_check(targets: DataFrame, responses: DataFrame, expected: str) -> DataFrame:
    """One row: responses expected over all targets, responses there, enough or not."""
    wanted = targets.agg(F.sum(expected).cast("bigint").alias("expected_total"))
    there = responses.agg(F.count(F.lit(1)).alias("actual_total"))
    both = wanted.unionByName(there, allowMissingColumns=True).agg(
        F.coalesce(F.sum("expected_total"), F.lit(0)).alias("expected_total"),
        F.sum("actual_total").alias("actual_total"),
    )
    return both.withColumn("is_complete", F.col("actual_total") >= F.col("expected_total"))


def data_quality_report(checked: DataFrame, run: str, product_id: str = "product_id") -> DataFrame:
    """The ten counters of each run over rows with ``validation_errors``.

    Counted per run and product first: repeated ids are then one row each, and
    no exact-distinct pass over the whole table is needed.
    """
    def rows(test: Column) -> Column:
        return F.count_if(test)

    has_error = F.size("validation_errors") > 0
    flags = {
        "total_products_seen": F.count(F.lit(1)),
        "products_passed": rows(~has_error),
        "products_failed": rows(has_error),
        "missing_product_id": rows(is_blank(F.col(product_id).cast("string"))),
        "missing_product_name": rows(is_blank(F.col("product_name"))),
        "missing_product_url": rows(is_blank(F.col("product_url"))),
        "invalid_price_negative": rows(F.col("price") < 0),
        "invalid_final_price_negative": rows(F.col("final_price") < 0),
        "final_price_greater_than_price": rows(F.col("final_price") > F.col("price")),
    }
    per_product = checked.groupBy(run, product_id).agg(
        *[column.alias(name) for name, column in flags.items()]
    )
    repeats = F.when(
        ~is_blank(F.col(product_id).cast("string")), F.col("total_products_seen") - 1
    )
    return per_product.groupBy(run).agg(
        *[F.sum(name).alias(name) for name in flags],
        F.coalesce(F.sum(repeats), F.lit(0)).alias("duplicate_product_id"),
    )
