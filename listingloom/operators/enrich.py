"""Stock and sales from detail lookups, and the category allow-list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listingloom.functions.web import non_empty
from listingloom.operators.dedup import latest_one

# Fixed value: the note on products that cannot be looked up.
NO_URL_ERROR = "product_url is missing"
NO_RESPONSE_ERROR = "Flashsale API response timeout or not triggered"


def enrich_detail(products: DataFrame, details: DataFrame, key: str = "product_url") -> DataFrame:
    """Products with the outcome of their detail lookup.

    ``details`` has a row per lookup of a key: ``has_response, error,
    buffer_value, total_sold, detail_crawl_time``; both values NULL means that
    the answer was empty. Of several lookups of one key the newest counts, so
    products stay one row each. Fields a lookup did not bring keep the
    product's own value.
    """
    values = ["has_response", "error", "buffer_value", "total_sold", "detail_crawl_time"]
    newest = latest_one(
        details.where(non_empty(F.col(key)).isNotNull()),
        [key],
        "detail_crawl_time",
        [F.col(c).asc_nulls_last() for c in ("error", "has_response", "buffer_value", "total_sold")],
    )
    looked_up = newest.select(F.col(key).alias("_key"), *values, F.lit(True).alias("_found"))
    asked = non_empty(products[key]).isNotNull()
    # Products without a key have nothing to look for and would all meet in one task.
    found = products.where(asked).join(looked_up, F.col(key) == F.col("_key"), "left")
    joined = found.unionByName(products.where(~asked), allowMissingColumns=True)
    status = (
        F.when(non_empty(F.col(key)).isNull(), "missing_product_url")
        .when(F.col("_found").isNull(), "not_attempted")
        .when(F.col("error").isNotNull(), "error")
        .when(~F.coalesce("has_response", F.lit(False)), "no_flashsale_response")
        .when(F.coalesce("buffer_value", "total_sold").isNull(), "no_flashsale_data")
        .otherwise("success")
    )
    good = F.col("detail_status") == "success"
    in_stock = (F.coalesce("buffer_value", F.lit(0)) > 0).cast("int")
    message = (
        F.when(F.col("detail_status") == "missing_product_url", NO_URL_ERROR)
        .when(F.col("detail_status") == "no_flashsale_response", NO_RESPONSE_ERROR)
        .when(F.col("detail_status") == "error", F.col("error"))
    )
    own = [c for c in products.columns if c not in ("stock_available", "sold_qty")]
    return joined.withColumn("detail_status", status).select(
        *own,
        F.when(good, in_stock).otherwise(F.col("stock_available")).alias("stock_available"),
        F.when(good, F.col("total_sold")).otherwise(F.col("sold_qty")).alias("sold_qty"),
        "detail_status",
        message.alias("detail_error"),
        "detail_crawl_time",
    )


def allow_categories(df: DataFrame, category: str, allowed: DataFrame) -> DataFrame:
    """Rows whose category name is in the one-column frame ``allowed``."""
    names = allowed.toDF(category)
    return df.join(names, category, "left_semi")
