"""Marts from daily states, and marts as views that another application opens."""

import json
import random
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from listingloom.operators import distinct_state as ds
from listingloom.plans import marts
from listingloom.plans.mart_state import MartState
from listingloom.plans.mart_views import View, ViewBook, in_order, mart_views
from tests.test_marts import tables  # noqa: F401


def made(spark, pick, count):
    rows = [
        (
            pick.choice([None, *range(30)]), pick.choice([None, *(f"2024-01-{d:02d} {h:02d}:00:00" for d in range(1, 9) for h in (1, 2))]),
            pick.choice([None, "1.00", "2.50"]), pick.choice([None, True, False]), pick.choice([None, 1, 2]),
        )
        for _ in range(count)
    ]
    df = spark.createDataFrame(rows, "product_id int, t string, p string, stock_available boolean, sold_qty bigint")
    money = [F.col("p").cast("decimal(18,2)").alias(c) for c in ("price", "final_price", "discount_percent")]
    return df.select("product_id", F.col("t").cast("timestamp_ntz").alias("processed_time"), *money, "stock_available", "sold_qty")


def test_days_one_by_one_equal_the_marts(spark, tmp_path, rows):
    pick = random.Random(6)
    snapshot = made(spark, pick, 400)
    mapping = spark.createDataFrame([(pick.randrange(35), pick.choice([10, 20])) for _ in range(60)], "product_id int, category_id int")
    categories = spark.createDataFrame([(10, "A"), (20, "B"), (30, "none")], "category_id int, category_name string")
    products = mapping.select("product_id").union(spark.range(30).selectExpr("cast(id as int)")).distinct()
    state = MartState(spark, str(tmp_path))
    with pytest.raises(ValueError):
        state.price_daily(categories)
    state.add_categories(mapping)
    state.add_categories(mapping.limit(5))
    day = F.to_date("processed_time")
    for numbers in ((3,), (8, 1, 2), (4, 5, 6, 7)):
        state.add_days(snapshot.where(day.isin([f"2024-01-0{n}" for n in numbers])), mapping)
    before = {p: p.stat().st_mtime_ns for p in Path(tmp_path).rglob("*.parquet")}
    # A day again, and a batch that was not finished.
    state.add_days(snapshot.where(day == "2024-01-05"), mapping)
    assert all(p.stat().st_mtime_ns == at for p, at in before.items())
    spark.read.parquet(str(tmp_path / "seen" / "batch=1")).write.parquet(str(tmp_path / "seen" / "batch=5"))
    assert rows(state.category_product_counts(categories)) == rows(marts.category_product_counts(categories, mapping))
    whole = marts.category_performance(categories, mapping, products, snapshot)
    assert rows(state.category_stock(categories)) == rows(
        whole.select("category_id", "category_name", "total_products", "in_stock_products", "out_stock_products")
    )
    known = snapshot.where("processed_time is not null")
    assert rows(state.price_daily(categories)) == rows(marts.price_daily(categories, mapping, known))


def test_numbers_are_dense_and_stay(spark):
    first = ds.new_ids(None, spark.range(1000).selectExpr("concat('id', id) k").union(spark.sql("select cast(null as string)")), "k")
    more = ds.new_ids(first, spark.range(500, 1500).selectExpr("concat('id', id) k"), "k")
    assert sorted(r["number"] for r in first.union(more).collect()) == list(range(1500))
    assert more.count() == 500 and ds.new_ids(first, first.select("k"), "k").count() == 0


def test_bitmaps_over_many_buckets(spark):
    rows = spark.range(0, 200_000, 3).selectExpr("id as number", "id % 2 as g")
    one = ds.seen(rows.where("number < 120000"), ["g"], "number", {"all": F.lit(True), "even": F.col("number") % 4 == 0})
    two = ds.seen(rows.where("number > 60000"), ["g"], "number", {"all": F.lit(True), "even": F.col("number") % 4 == 0})
    got = {r["g"]: (r["n"], r["e"]) for r in ds.counts(one.union(two), ["g"], {"all": "n", "even": "e"}).collect()}
    numbers = range(0, 200_000, 3)
    assert got == {g: (sum(n % 2 == g for n in numbers), sum(n % 2 == g and n % 4 == 0 for n in numbers)) for g in (0, 1)}


def test_another_application_opens_the_book(spark, tables, tmp_path, rows):  # noqa: F811
    folders = {}
    for name, df in tables.items():
        folders[name] = str(tmp_path / "it's" / name)
        df.write.parquet(folders[name])
    book = ViewBook(spark, str(tmp_path / "book"))
    with pytest.raises(ValueError, match="no views"):
        book.open()
    views = mart_views(["price desc", "final_price"])
    assert book.publish(folders, views) == 1 and set(book.open("shop")) == set(views)
    marts.register_marts(tables, [F.col("price").desc()])
    for name in views:
        ours, theirs = spark.table(f"shop.{name}"), spark.table(f"global_temp.{name}")
        assert rows(ours.select(*sorted(theirs.columns))) == rows(theirs.select(*sorted(theirs.columns))), name
    script = f"""
        import sys, json
        sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
        from pyspark.sql import SparkSession
        from listingloom.plans.mart_views import ViewBook
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", False).config(
            "spark.sql.warehouse.dir", {str(tmp_path / "warehouse")!r}).getOrCreate()
        names = ViewBook(spark, {str(tmp_path / "book")!r}).open()
        print(json.dumps({{n: spark.table(n).count() for n in names}}))
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    counts = json.loads(done.stdout.strip().splitlines()[-1])
    assert counts == {name: spark.table(f"shop.{name}").count() for name in views}, done.stderr[-2000:]

    # A newer version replaces tables and views under their names, and the old one can still be opened.
    tables["categories"].where("category_id = 10").write.parquet(str(tmp_path / "few"))
    book.publish({**folders, "categories": str(tmp_path / "few")}, views)
    book.open("shop")
    assert [r["category_id"] for r in spark.newSession().table("shop.vw_dm_category_performance").collect()] == [10]
    book.open("shop", version=1)
    assert spark.table("shop.vw_dm_category_performance").count() == 3 and book.versions() == [1, 2]


def test_views_that_read_one_another_or_nothing_known():
    with pytest.raises(ValueError, match="one another"):
        in_order({"a": View("", ("b",)), "b": View("", ("a",))}, set())
    with pytest.raises(ValueError, match="gone"):
        in_order({"a": View("", ("gone",))}, {"here"})
    assert in_order({"b": View("", ("a", "t")), "a": View("", ("t",))}, {"t"}) == ["a", "b"]


def test_stock_is_kept_once_for_all_categories(spark, tmp_path, rows):
    """A batch counts under the categories it was filed under, and its bitmaps do not multiply with them."""
    snapshot = spark.createDataFrame(
        [(1, "2024-01-01", True), (2, "2024-01-01", True), (1, "2024-01-02", False), (1, "2024-01-02", True), (3, "2024-01-02", None)],
        "product_id int, t string, stock_available boolean",
    ).select(
        "product_id", F.col("t").cast("timestamp_ntz").alias("processed_time"), "stock_available", F.lit(1).cast("bigint").alias("sold_qty"),
        *[F.lit("1.00").cast("decimal(18,2)").alias(c) for c in ("price", "final_price", "discount_percent")],
    )
    first = spark.createDataFrame([(p, c) for p in (1, 2, 3) for c in range(40)], "product_id int, category_id int")
    second = spark.createDataFrame([(1, 40), (3, 40)], "product_id int, category_id int")
    state = MartState(spark, str(tmp_path))
    state.add_categories(first.union(second))
    state.add_days(snapshot.where("processed_time < '2024-01-02'"), first)
    state.add_days(snapshot.where("processed_time >= '2024-01-02'"), second)
    categories = spark.range(41).selectExpr("cast(id as int) category_id", "'c' category_name")
    # Product 2 was last seen in the first batch, 1 and 3 in the second, 3 without any word on its stock.
    assert rows(state.category_stock(categories)) == rows(
        spark.createDataFrame([(c, "c", 3, 1, 0) for c in range(40)] + [(40, "c", 2, 1, 1)])
    )
    assert spark.read.parquet(str(tmp_path / "seen")).count() == 2
    spark.range(1).write.parquet(str(tmp_path / "stock" / "batch=1"))
    with pytest.raises(ValueError, match="earlier layout"):
        state.category_stock(categories)
