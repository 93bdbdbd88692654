import pytest
from pyspark.sql import functions as F

from listingloom import schemas
from listingloom.operators import dedup, enrich, gate, project, quality
from listingloom.sinks import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_one_is_deterministic_and_null_times_lose(spark, rows):
    df = spark.createDataFrame(
        [("a", "2024", 2), ("a", "2024", 1), ("a", None, 0), ("b", None, 5), (None, "1", 6), (None, "2", 7)],
        "k string, t string, n int",
    )
    got = dedup.latest_one(df, ["k"], "t", [F.col("n").asc()])
    assert rows(got) == [("a", "2024", 1), ("b", None, 5), (None, "2", 7)]
    plan = plan_of(got)
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_latest_all_ties_keeps_ties_and_drops_null_times(spark, rows):
    df = spark.createDataFrame([("a", 2, 1), ("a", 2, 2), ("a", 1, 3), ("b", None, 4)], "k string, t int, n int")
    assert rows(dedup.latest_all_ties(df, ["k"], "t")) == [("a", 2, 1), ("a", 2, 2)]


def test_first_wins(spark, rows):
    df = spark.createDataFrame([("x", 2), ("x", 1), (None, 3), (None, 4)], "k string, pos int")
    assert rows(dedup.first_wins(df, ["k"], [F.col("pos")])) == [("x", 1)]
    both = dedup.first_wins(df, ["k"], [F.col("pos")], drop_null_keys=False)
    assert rows(both) == [("x", 1), (None, 3)]


def test_dedup_key_order(spark):
    df = spark.createDataFrame(
        [("1", "u", "n", "N"), (" ", "u", "n", "N"), (None, None, "n", "N"), (None, None, None, "漢"), (None, None, None, " ")],
        "i string, u string, k string, n string",
    )
    got = df.select(dedup.dedup_key(*[F.col(c) for c in "iukn"])).collect()
    assert [r[0] for r in got] == ["1", "u", "n", "漢", None]


def test_tolerant_columns(spark):
    df = spark.createDataFrame([(("x", ("5",)),)], "a struct<b: string, c: struct<d: string>>")
    got = df.select(
        project.column_or_null(df, "a.c.d", "bigint"),
        project.column_or_null(df, "a.b.d", "string"),
        project.column_or_null(df, "z", "int"),
    ).first()
    assert tuple(got) == (5, None, None)
    assert project.field_type(df.schema, "a.c.d").simpleString() == "string"
    assert project.field_type(df.schema, "a.x") is None
    assert project.has_column(df, "a") and not project.has_column(df, "b")


CHECKED = [("a", 1, 1), ("  ", -1, -2), (None, None, None)]


def test_validation_errors(spark):
    df = quality.add_validation_errors(
        spark.createDataFrame(CHECKED, "product_name string, price bigint, original_price bigint")
    )
    assert [r["validation_errors"] for r in df.collect()] == [
        [],
        ["missing_product_name", "invalid_price_negative", "invalid_original_price_negative"],
        ["missing_product_name"],
    ]
    assert quality.valid_rows(df).count() + quality.rejected_rows(df).count() == 3
    assert quality.valid_rows(df).columns == ["product_name", "price", "original_price"]


def test_stage_counts_have_zeros(spark, rows):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "source_name string")
    only_a = df.filter("source_name = 'a'")
    assert rows(quality.stage_counts(df, only_a, only_a.limit(0))) == [("a", 2, 2, 0), ("b", 1, 0, 0)]


def test_crawl_summary_of_absent_lists(spark):
    df = spark.createDataFrame(
        [("f", "c", ([("success",), ("error",), (None,)],)), ("f", "d", (None,)), ("f", "d", None)],
        "source_name string, source_category_name string, body struct<product_list: array<struct<detail_status: string>>>",
    )
    got = quality.crawl_summary(df).first()
    assert tuple(got) == ("f", 2, 3, 3, 1, 0, 0, 0, 1)


def test_data_quality_report_counts_repeats_of_hot_ids(spark):
    data = [("r", "1", "n", "u", 5, 5, 6)] * 30 + [("r", None, " ", None, -1, 5, None)] * 2
    df = spark.createDataFrame(
        data,
        "run string, product_id string, product_name string, product_url string, price bigint, original_price bigint, final_price bigint",
    )
    got = quality.data_quality_report(quality.add_validation_errors(df), "run").first().asDict()
    assert got == {
        "run": "r", "total_products_seen": 32, "products_passed": 30, "products_failed": 2,
        "missing_product_id": 2, "missing_product_name": 2, "missing_product_url": 2,
        "invalid_price_negative": 2, "invalid_final_price_negative": 0,
        "final_price_greater_than_price": 30, "duplicate_product_id": 29,
    }


def gate_of(spark, data):
    df = spark.createDataFrame(data, "source_name string, crawl_time string")
    return gate.dataset_gate(df)


def test_gate_passes_without_optional_source(spark):
    good = [(s, "2024-05-31T10:00:00.123") for s in schemas.REQUIRED_SOURCES]
    checked = gate_of(spark, good)
    got = {r["check_name"]: (r["passed"], r["detail"]) for r in checked.collect()}
    assert all(passed for passed, _ in got.values())
    assert got["optional_sources"] == (True, "fahasa")
    assert got["crawl_time"] == (True, "2024-05-31 10:00:00")
    gate.require_passed(checked)


def test_gate_fails(spark):
    empty = {r["check_name"]: r["passed"] for r in gate_of(spark, []).collect()}
    assert not any(empty[c] for c in ("has_rows", "required_sources", "source_count", "crawl_time"))
    bad = gate_of(spark, [("tiki", "yesterday"), ("other", None), (None, None), ("", None)])
    got = {r["check_name"]: (r["passed"], r["detail"]) for r in bad.collect()}
    assert got["required_sources"] == (False, "bookbuy,phuongnam,vinabook")
    assert got["unexpected_sources"] == (False, "1")
    assert got["source_count"] == (False, "2")
    assert got["crawl_time"] == (False, "none")
    with pytest.raises(ValueError, match="required_sources"):
        gate.require_passed(bad)


def test_detail_outcomes(spark):
    products = spark.createDataFrame(
        [(u, None, 5) for u in ("/s", "/z", "/e", "/t", "/n", "/q", "", None)],
        "product_url string, stock_available int, sold_qty bigint",
    )
    details = spark.createDataFrame(
        [("/s", True, None, 3, 9, "t"), ("/z", True, None, None, 0, "t"), ("/e", False, "boom", None, None, "t"),
         ("/t", False, None, None, None, "t"), ("/n", True, None, None, None, "t")],
        "product_url string, has_response boolean, error string, buffer_value bigint, total_sold bigint, detail_crawl_time string",
    )
    got = {
        r["product_url"]: (r["detail_status"], r["stock_available"], r["sold_qty"], r["detail_error"])
        for r in enrich.enrich_detail(products, details).collect()
    }
    assert got["/s"] == ("success", 1, 9, None)
    assert got["/z"] == ("success", 0, 0, None)
    assert got["/e"] == ("error", None, 5, "boom")
    assert got["/t"][0] == "no_flashsale_response" and got["/n"][0] == "no_flashsale_data"
    assert got["/q"] == ("not_attempted", None, 5, None)
    assert got[""][0] == got[None][0] == "missing_product_url"


def test_partitioned_output_and_published_names(spark, tmp_path):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("source_name"))
    path = str(tmp_path / "by-source")
    tables.write_partitioned(df, path)
    assert sorted(p.name for p in (tmp_path / "by-source").iterdir() if "=" in p.name) == ["source_name=a", "source_name=b"]
    view = tables.publish_table(spark, "published_view", path)
    assert view.filter("source_name = 'b'").count() == 100
    first, second = str(tmp_path / "one"), str(tmp_path / "two")
    tables.write_table(df.limit(10), first)
    tables.write_table(df, second)
    table = tables.publish_external_table(spark, "published_table", first, df.schema)
    assert table.count() == 10
    again = tables.publish_external_table(spark, "published_table", second, df.schema)
    assert again.count() == spark.newSession().table("published_table").count() == 1000
    assert [tuple(r) for r in tables.describe_table(again).collect()] == [
        (0, "id", "bigint"), (1, "source_name", "string"),
    ]
    spark.sql("DROP TABLE published_table")
    assert spark.read.parquet(second).count() == 1000
    with pytest.raises(ValueError):
        tables.publish_table(spark, "x", "")


def test_published_products_have_the_fixed_columns(spark, tmp_path):
    from listingloom import schemas

    tables.write_table(spark.createDataFrame([("a", 5)], "product_id string, price long"), str(tmp_path / "p"))
    table = tables.publish_external_table(spark, "published_products", str(tmp_path / "p"))
    assert table.columns == [f.name for f in schemas.PRODUCT.fields] and len(table.columns) == 24
    assert [(r["product_id"], r["price"], r["image_url"]) for r in table.collect()] == [("a", 5, None)]
    spark.sql("DROP TABLE published_products")


def test_enrichment_takes_the_newest_lookup(spark):
    products = spark.createDataFrame(
        [("/a", None, 1), ("/a", None, 2), (None, None, 3), ("", None, 4)],
        "product_url string, stock_available int, sold_qty long",
    )
    details = spark.createDataFrame(
        [("/a", True, None, 5, 50, "2024-01-02"), ("/a", True, "old", 0, 0, "2024-01-01"), (None, True, None, 1, 1, "2024-01-03")],
        "product_url string, has_response boolean, error string, buffer_value long, total_sold long, detail_crawl_time string",
    )
    got = sorted((r["product_url"] or "", r["detail_status"], r["sold_qty"]) for r in enrich.enrich_detail(products, details).collect())
    assert got == [("", "missing_product_url", 3), ("", "missing_product_url", 4), ("/a", "success", 50), ("/a", "success", 50)]


def test_rows_that_nothing_identifies_all_stay(spark):
    df = spark.createDataFrame(
        [(" ", "", "", " ", "t"), (None, None, None, None, "t"), ("", "", "k", "n", "t"), ("", " ", "k", "n", "u")],
        "product_id string, product_url string, name_key string, product_name string, time string",
    )
    keyed = df.withColumn("key", dedup.dedup_key(*[F.col(c) for c in df.columns[:4]]))
    got = dedup.latest_or_keyless(keyed, ["key"], "key", "time", [F.col("product_name")])
    assert sorted((r["key"] or "", r["time"]) for r in got.collect()) == [("", "t"), ("", "t"), ("k", "u")]


def test_reports_are_whole_and_heads_ordered(spark, tmp_path):
    df = spark.range(5000).select(
        F.lit("s").alias("source_name"), F.lpad(F.col("id").cast("string"), 4, "0").alias("product_id"),
        F.lit("n").alias("product_name"), F.col("id").alias("price"), F.array(F.lit("e")).alias("validation_errors"),
    )
    tables.write_report(tables.reject_report(df), str(tmp_path / "r"), by="source_name")
    assert spark.read.json(str(tmp_path / "r")).count() == 5000
    got = [r["product_id"] for r in tables.report_head(tables.reject_report(df), 7).collect()]
    assert got == [f"{i:04}" for i in range(7)]
    tables.write_report(tables.reject_report(df.limit(0)), str(tmp_path / "empty"))
    assert spark.read.text(str(tmp_path / "empty")).count() == 0
