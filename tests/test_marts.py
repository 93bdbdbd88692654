"""Marts on small tables with the awkward cases the large ones lack."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from listingloom.plans import marts


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    snapshot = make(
        [
            (1, "2024-01-01", "10.00", "9.00", "10.00", True, 1),
            (1, "2024-01-02", "20.00", "18.00", "10.00", True, 2),
            (1, "2024-01-02", "30.00", "27.00", None, False, 3),
            (2, "2024-01-02", "0.01", "0.01", "0.00", False, None),
            (2, None, "99.00", "99.00", "99.00", True, 99),
            (3, None, "5.00", "5.00", "50.00", True, 5),
            (9, "2024-01-01", "7.00", "7.00", "1.00", True, 7),
        ],
        "product_id int, t string, price string, final_price string, discount_percent string, "
        "stock_available boolean, sold_qty bigint",
    ).select(
        "product_id",
        F.col("t").cast("timestamp_ntz").alias("processed_time"),
        *[F.col(c).cast("decimal(18,2)").alias(c) for c in ("price", "final_price", "discount_percent")],
        "stock_available",
        "sold_qty",
    )
    return {
        "categories": make([(10, "A"), (20, "B"), (30, "none")], "category_id int, category_name string"),
        # product 1 is mapped twice to A; 9 is not a known product
        "product_category_map": make(
            [(1, 10), (1, 10), (2, 10), (3, 20), (9, 20)], "product_id int, category_id int"
        ),
        "products": make([(i, f"p{i}", "u", "i") for i in (1, 2, 3)],
                         "product_id int, product_name string, product_url string, image_src string"),
        "product_snapshot": snapshot,
        "pipeline_runs": make(
            [(1, "2024-01-01", "s", "f", 5), (2, "2024-01-01", "s", "f", 0), (3, "2024-01-03", "s", "f", 1)],
            "process_run_id int, t string, source_name string, raw_file_minio string, total_raw_records int",
        ).withColumn("processed_at", F.col("t").cast("timestamp_ntz")),
        "data_quality_reports": make(
            [(1, *[3] * 10), (2, *[0] * 10)],
            "process_run_id int, " + ", ".join(f"{c} bigint" for c in marts.REPORT_COUNTERS),
        ),
        "rejected_products": make([("2024-01-01",), ("2024-01-01",)], "t string").select(
            F.col("t").cast("timestamp_ntz").alias("rejected_at")
        ),
        "pipeline_task_audit": make([("2024-01-03", "success"), ("2024-01-03", "failed"), ("2024-01-03", "running")],
                                    "t string, status string").select(
            F.col("t").cast("timestamp_ntz").alias("finished_at"), "status"
        ),
    }


def test_category_performance(tables):
    keys = ["categories", "product_category_map", "products", "product_snapshot"]
    got = {r["category_id"]: r for r in marts.category_performance(*[tables[k] for k in keys]).collect()}
    a = got[10]
    # product 1 counts twice, with both snapshots of its latest time
    assert a["avg_price"] == Decimal("20.00")
    assert a["avg_sold_qty"] == Decimal("2.50") and a["avg_discount_percent"] == Decimal("6.67")
    assert (a["total_products"], a["in_stock_products"], a["out_stock_products"]) == (2, 1, 2)
    b = got[20]
    assert (b["total_products"], b["avg_price"], b["in_stock_products"]) == (2, None, 0)
    assert tuple(got[30])[2:] == (0, None, None, None, None, 0, 0)


def test_price_daily(tables):
    keys = ["categories", "product_category_map", "product_snapshot"]
    got = [tuple(r) for r in marts.price_daily(*[tables[k] for k in keys]).collect()]
    by_key = {(str(r[0]), r[1]): r[3:5] for r in got}
    assert by_key[("2024-01-02", 10)] == (2, Decimal("20.00"))
    assert by_key[("2024-01-01", 20)] == (1, Decimal("7.00"))
    assert by_key[("None", 10)] == (1, Decimal("99.00"))
    assert [r[0] for r in got] == sorted((r[0] for r in got), key=lambda d: (d is not None, d))


def test_health_daily(tables):
    keys = ["pipeline_runs", "data_quality_reports", "rejected_products", "pipeline_task_audit"]
    got = {str(r["run_date"]): tuple(r)[1:] for r in marts.pipeline_health_daily(*[tables[k] for k in keys]).collect()}
    assert got == {
        "2024-01-01": (2, 3, 3, 3, 3, Decimal("100.00"), 2, 0, 0, 0),
        "2024-01-03": (1, 0, 0, 0, 0, Decimal("0.00"), 0, 3, 1, 1),
    }


def test_failure_rate_is_null_without_products(tables):
    got = {r["process_run_id"]: r["failure_rate_percent"]
           for r in marts.failure_rate(tables["pipeline_runs"], tables["data_quality_reports"]).collect()}
    assert got == {1: Decimal("100.00"), 2: None}


def test_views_and_top_lists(spark, tables):
    marts.register_marts(tables, [F.col("price").desc()])
    latest = {r["product_id"]: r for r in spark.newSession().table("global_temp.vw_latest_product_snapshot").collect()}
    # of equal times the tie-break decides, and a NULL time only wins alone
    assert latest[1]["price"] == Decimal("30.00") and latest[2]["price"] == Decimal("0.01")
    assert latest[3]["processed_time"] is None and 9 not in latest
    top = [r["product_id"] for r in spark.newSession().table("global_temp.vw_top_discount_products").collect()]
    assert top == [3, 2]
    assert [r["product_id"] for r in spark.newSession().table("global_temp.vw_top_sold_products").collect()] == [3, 1]
    limited = marts.top_discount(spark.newSession().table("global_temp.vw_latest_product_snapshot"), limit=1)
    assert [r["product_id"] for r in limited.collect()] == [3]
    assert "TakeOrderedAndProject" in limited._jdf.queryExecution().executedPlan().toString()
    counts = spark.newSession().table("global_temp.vw_category_product_counts").collect()
    assert [(r["category_id"], r["total_products"]) for r in counts] in ([(10, 2), (20, 2)], [(20, 2), (10, 2)])
    for view in ("vw_dm_category_performance", "vw_dm_pipeline_health_daily", "vw_pipeline_quality_runs",
                 "vw_pipeline_failure_rate", "vw_dm_price_daily"):
        assert spark.newSession().table(f"global_temp.{view}").count() > 0


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_daily_sums_are_exact_for_long_and_negative_amounts(spark):
    amounts = ["-123456789012345.123456", "999999999999999.999999", "0.000001", "-0.99", "1000000000", None]
    rows = spark.createDataFrame(
        [(n, a) for n, a in enumerate(amounts)] + [(0, "99999999999999999.5")], "product_id int, a string"
    ).withColumn("processed_time", F.lit("2024-01-01").cast("timestamp_ntz"))
    money = [F.col("a").cast("decimal(28,6)").alias(m) for m in ("price", "final_price", "discount_percent")]
    snapshot = rows.select("product_id", "processed_time", *money, F.col("product_id").cast("bigint").alias("sold_qty"))
    mapping = spark.createDataFrame([(n, 1) for n in range(6)] + [(0, 1)], "product_id int, category_id int")
    sums = marts.daily_sums(mapping, snapshot)
    got = sums.first()
    known = [Decimal(a) for a in amounts if a]
    assert got["price_sum"] == sum(known) + known[0] + 2 * Decimal("99999999999999999.5") and got["price_n"] == 8
    assert got["sold_qty_sum"] == 15 and got["total_products"] == 6
    # Behind the join only whole numbers are added.
    assert "_parts" in plan_of(sums)


def test_views_count_products_without_a_copy_of_the_rows(spark, tables):
    from listingloom.plans.mart_views import mart_views

    for name, df in tables.items():
        df.createOrReplaceTempView(f"plain_{name}")
    for name in ("vw_dm_price_daily", "vw_dm_category_performance"):
        text = mart_views(["price"])[name].sql.format_map({t: f"plain_{t}" for t in tables})
        assert "Expand" not in plan_of(spark.sql(text)) and "distinct m.product_id" not in text and "distinct s.product_id" not in text
