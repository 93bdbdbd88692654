"""Analytical marts over the product, snapshot, category and run tables.

Rows are summed up per product before they meet the category map, and per
(category, product) before products are counted, so that exact distinct counts
need no copy of the rows and each shuffle carries partial sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom.functions.numbers import mean_2dp, percent_2dp
from listingloom.operators.dedup import latest_all_ties, latest_one

MEASURES = ["price", "final_price", "discount_percent", "sold_qty"]

REPORT_COUNTERS = [
    "total_products_seen",
    "products_passed",
    "products_failed",
    "missing_product_id",
    "missing_product_name",
    "missing_product_url",
    "invalid_price_negative",
    "invalid_final_price_negative",
    "final_price_greater_than_price",
    "duplicate_product_id",
]


def _sums() -> list[Column]:
    """Per measure its sum and the number of its values."""
    return [
        column
        for m in MEASURES
        for column in (F.sum(m).alias(f"{m}_sum"), F.count(m).alias(f"{m}_n"))
    ]


def _averages() -> list[Column]:
    return [mean_2dp(F.col(f"{m}_sum"), F.col(f"{m}_n")).alias(f"avg_{m}") for m in MEASURES]


def _zero_if_missing(name: str) -> Column:
    return F.coalesce(name, F.lit(0)).cast("bigint").alias(name)


def category_product_counts(categories: DataFrame, product_category_map: DataFrame) -> DataFrame:
    """Number of distinct products per category, largest first."""
    counts = product_category_map.groupBy("category_id").agg(
        F.count_distinct("product_id").alias("total_products")
    )
    return (
        categories.select("category_id", "category_name")
        .distinct()
        .join(counts, "category_id")
        .orderBy(F.desc("total_products"))
    )


def category_performance(
    categories: DataFrame,
    product_category_map: DataFrame,
    products: DataFrame,
    product_snapshot: DataFrame,
) -> DataFrame:
    """Counts and average measures of each category's products at their latest time.

    All snapshots of a product's latest time count, and a product weighs as
    often as it is mapped. Categories without products are kept.
    """
    in_stock = F.col("stock_available")
    # The newest time alone combines well before the shuffle; only rows that carry it are summed.
    latest = (
        latest_all_ties(product_snapshot, ["product_id"], "processed_time")
        .groupBy("product_id")
        .agg(*_sums(), F.bool_or(in_stock).alias("in_stock"), F.bool_or(~in_stock).alias("out_stock"))
    )
    # A row per product and category needs no adding up once it knows how often it counts.
    often = products.groupBy("product_id").agg(F.count(F.lit(1)).alias("listed"))
    known = often.join(latest, "product_id", "left")
    mapped = product_category_map.groupBy("category_id", "product_id").agg(F.count(F.lit(1)).alias("mapped"))
    times = F.col("mapped") * F.col("listed")
    per_category = (
        mapped.join(known, "product_id", "left")
        .groupBy("category_id")
        .agg(
            F.count("product_id").alias("total_products"),
            *[F.sum(F.col(f"{m}_{part}") * times).alias(f"{m}_{part}") for m in MEASURES for part in ("sum", "n")],
            F.count_if("in_stock").alias("in_stock_products"),
            F.count_if("out_stock").alias("out_stock_products"),
        )
    )
    return (
        categories.select("category_id", "category_name")
        .distinct()
        .join(per_category, "category_id", "left")
        .select(
            "category_id",
            "category_name",
            _zero_if_missing("total_products"),
            *_averages(),
            _zero_if_missing("in_stock_products"),
            _zero_if_missing("out_stock_products"),
        )
    )


def price_daily(
    categories: DataFrame, product_category_map: DataFrame, product_snapshot: DataFrame
) -> DataFrame:
    """Products and average measures per day and category, in that order."""
    per_category = daily_sums(product_category_map, product_snapshot)
    return (
        per_category.join(categories.select("category_id", "category_name").distinct(), "category_id")
        .select("snapshot_date", "category_id", "category_name", "total_products", *_averages())
        .orderBy("snapshot_date", "category_name")
    )


def daily_sums(product_category_map: DataFrame, product_snapshot: DataFrame) -> DataFrame:
    """Products, and each measure's sum and number of values, per ``snapshot_date`` and ``category_id``."""
    per_day = product_snapshot.groupBy(
        "product_id", F.to_date("processed_time").alias("snapshot_date")
    ).agg(*_sums())
    weights = product_category_map.groupBy("product_id", "category_id").agg(
        F.count(F.lit(1)).alias("weight")
    )
    # A row for each category of a product's day: from here on only whole numbers are multiplied and added.
    split = [m for m in MEASURES if _splits(per_day.schema[f"{m}_sum"].dataType)]
    limbs = {f"{m}_{part}": value for m in split for part, value in _limbs(F.col(f"{m}_sum")).items()}
    narrow = per_day.withColumns(limbs).drop(*[f"{m}_sum" for m in split])
    numbers = [c for c in narrow.columns if c not in ("product_id", "snapshot_date")]
    summed = (
        narrow.join(weights, "product_id")
        .groupBy("snapshot_date", "category_id")
        .agg(F.count(F.lit(1)).alias("total_products"), *[F.sum(F.col(c) * F.col("weight")).alias(c) for c in numbers])
    )
    sums = {
        m: _joined_limbs(m).cast(T.DecimalType(38, per_day.schema[f"{m}_sum"].dataType.scale)).alias(f"{m}_sum")
        if m in split
        else F.col(f"{m}_sum")
        for m in MEASURES
    }
    return summed.select(
        "snapshot_date", "category_id", "total_products", *[c for m in MEASURES for c in (sums[m], f"{m}_n")]
    )


#: Numbers below it are added up nine thousand million times before a long is full.
LIMB = 10**9


def _splits(kind: T.DataType) -> bool:
    return isinstance(kind, T.DecimalType) and kind.scale <= 6


def _limbs(total: Column) -> dict[str, Column]:
    """A decimal of up to six places as three longs of its sign: whole ``LIMB``s, ones, and parts of a ``LIMB``th.

    Longs are added faster than long decimals, and as exactly.
    Totals of up to 18 digits are split as longs, others as what they are.
    """
    limb, whole = F.lit(LIMB), total.cast("long")
    wide = total.cast("decimal(38,6)")
    short = F.abs(total) < F.lit(10**18)
    return {
        "high": F.when(short, F.call_function("div", whole, limb)).otherwise(F.call_function("div", wide, limb)).cast("long"),
        "ones": F.when(short, whole % limb).otherwise((wide % limb).cast("long")),
        "parts": F.when(short, ((total - whole) * limb).cast("long")).otherwise(((wide % F.lit(1)) * limb).cast("long")),
    }


def _joined_limbs(measure: str) -> Column:
    high, ones, parts = (F.col(f"{measure}_{part}").cast("decimal(19,0)") for part in ("high", "ones", "parts"))
    billion = F.lit(LIMB).cast("decimal(10,0)")
    return (high * billion + ones).cast("decimal(29,0)") + (parts * F.lit("0.000000001").cast("decimal(9,9)"))


def rejected_daily(rejected_products: DataFrame) -> DataFrame:
    """Rejected products per day."""
    return rejected_products.groupBy(F.to_date("rejected_at").alias("run_date")).agg(
        F.count(F.lit(1)).alias("total_rejected")
    )


def task_audit_daily(pipeline_task_audit: DataFrame) -> DataFrame:
    """Tasks per day by outcome."""
    return pipeline_task_audit.groupBy(F.to_date("finished_at").alias("run_date")).agg(
        F.count(F.lit(1)).alias("total_tasks"),
        F.count_if(F.col("status") == "success").alias("success_tasks"),
        F.count_if(F.col("status") == "failed").alias("failed_tasks"),
    )


def pipeline_health_daily(
    pipeline_runs: DataFrame,
    data_quality_reports: DataFrame,
    rejected_products: DataFrame,
    pipeline_task_audit: DataFrame,
) -> DataFrame:
    """Runs, products, rejects and tasks per day; failure rate 0 on days without products."""
    sums = {
        "total_products_seen": "total_products_seen",
        "total_products_passed": "products_passed",
        "total_products_failed": "products_failed",
        "total_duplicate_product_id": "duplicate_product_id",
    }
    per_run = (
        pipeline_runs.select("process_run_id", F.to_date("processed_at").alias("run_date"))
        .join(data_quality_reports.select("process_run_id", *sums.values()), "process_run_id", "left")
        .groupBy("run_date", "process_run_id")
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in sums.items()])
    )
    per_day = per_run.groupBy("run_date").agg(
        F.count("process_run_id").alias("total_runs"),
        *[F.sum(name).alias(name) for name in sums],
    )
    rate = percent_2dp(F.col("total_products_failed"), F.col("total_products_seen"))
    return (
        per_day.join(rejected_daily(rejected_products), "run_date", "left")
        .join(task_audit_daily(pipeline_task_audit), "run_date", "left")
        .select(
            "run_date",
            "total_runs",
            *sums,
            F.coalesce(rate, F.lit(0)).cast("decimal(18,2)").alias("failure_rate_percent"),
            *[
                _zero_if_missing(c)
                for c in ("total_rejected", "total_tasks", "success_tasks", "failed_tasks")
            ],
        )
    )


def pipeline_quality_runs(pipeline_runs: DataFrame, data_quality_reports: DataFrame) -> DataFrame:
    """Runs with the counters of their quality report."""
    return pipeline_runs.join(data_quality_reports, "process_run_id").select(
        "process_run_id",
        "processed_at",
        "source_name",
        "raw_file_minio",
        "total_raw_records",
        *REPORT_COUNTERS,
    )


def failure_rate(pipeline_runs: DataFrame, data_quality_reports: DataFrame) -> DataFrame:
    """Percent of failed products per run, NULL for runs without products."""
    rate = percent_2dp(F.col("products_failed"), F.col("total_products_seen"))
    return pipeline_runs.join(data_quality_reports, "process_run_id").select(
        "process_run_id",
        "processed_at",
        "total_products_seen",
        "products_failed",
        rate.alias("failure_rate_percent"),
    )


def latest_product_snapshot(
    products: DataFrame, product_snapshot: DataFrame, tie_breaks: list[Column]
) -> DataFrame:
    """Each known product with its one newest snapshot."""
    newest = latest_one(product_snapshot, ["product_id"], "processed_time", tie_breaks)
    return products.join(newest, "product_id").select(
        "product_id",
        "product_name",
        "product_url",
        "image_src",
        "price",
        "final_price",
        "discount_percent",
        "stock_available",
        "sold_qty",
        "processed_time",
    )


def _top(latest: DataFrame, measure: str, columns: list[str], limit: int | None) -> DataFrame:
    ranked = (
        latest.filter(F.col(measure).isNotNull())
        .select("product_id", "product_name", *columns)
        .orderBy(F.desc(measure), F.desc_nulls_first("processed_time"), "product_id")
    )
    return ranked if limit is None else ranked.limit(limit)


def top_discount(latest: DataFrame, limit: int | None = None) -> DataFrame:
    """Latest snapshots by discount, then newest; all of them unless limited."""
    columns = ["price", "final_price", "discount_percent", "processed_time"]
    return _top(latest, "discount_percent", columns, limit)


def top_sold(latest: DataFrame, limit: int | None = None) -> DataFrame:
    """Latest snapshots by quantity sold, then newest; all of them unless limited."""
    columns = ["sold_qty", "final_price", "discount_percent", "processed_time"]
    return _top(latest, "sold_qty", columns, limit)


def register_marts(tables: dict[str, DataFrame], tie_breaks: list[Column]) -> None:
    """Names every mart as a global view: ``global_temp.<name>`` in all sessions of the application.

    ``tables`` holds the base tables under their names; views stay lazy, and
    registering again replaces a view in one step.
    """
    t = tables
    latest = latest_product_snapshot(t["products"], t["product_snapshot"], tie_breaks)
    runs, reports = t["pipeline_runs"], t["data_quality_reports"]
    category_tables = [t["categories"], t["product_category_map"]]
    marts = {
        "vw_category_product_counts": category_product_counts(*category_tables),
        "vw_dm_category_performance": category_performance(
            *category_tables, t["products"], t["product_snapshot"]
        ),
        "vw_dm_pipeline_health_daily": pipeline_health_daily(
            runs, reports, t["rejected_products"], t["pipeline_task_audit"]
        ),
        "vw_pipeline_quality_runs": pipeline_quality_runs(runs, reports),
        "vw_pipeline_failure_rate": failure_rate(runs, reports),
        "vw_dm_price_daily": price_daily(*category_tables, t["product_snapshot"]),
        "vw_latest_product_snapshot": latest,
        "vw_top_discount_products": top_discount(latest),
        "vw_top_sold_products": top_sold(latest),
    }
    for name, mart in marts.items():
        mart.createOrReplaceGlobalTempView(name)
