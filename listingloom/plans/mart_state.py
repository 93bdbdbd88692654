"""The counting marts from states that grow by a day at a time.

Distinct products are bitmaps over dense product numbers, so days are joined by OR
and counted at any grouping; averages are sums and numbers of values. What is added
is a batch of whole days in folders of its own, and no earlier one is read. The
batch's list of days is written last: without it the batch does not count, and of
several batches with a day the newest counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from listingloom.operators import distinct_state as ds
from listingloom.operators.dedup import latest_all_ties
from listingloom.plans import marts
from listingloom.storage import stage

DAY = "snapshot_date"


class MartState:
    """Tables below ``root``: ``ids`` (product numbers), and by batch ``days``, ``seen``, ``filed`` and ``sums``.

    ``mapped`` holds the products of each category; what it has been given stays.
    ``seen`` holds a day's products, and which of them were in or out of stock, once
    for all categories; ``filed`` holds the categories that a batch was filed under.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str) -> DataFrame | None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        system = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        entries = system.listStatus(path) if system.exists(path) else []
        if all(entry.getPath().getName().startswith(("_", ".")) for entry in entries):
            return None
        return self.spark.read.parquet(f"{self.root}/{name}")

    def _needed(self, name: str) -> DataFrame:
        if self._table("stock") is not None:
            raise ValueError(f"{self.root} is of an earlier layout (stock by category): add its days to a new state")
        found = self._table(name)
        if found is None:
            raise ValueError(f"nothing has been added to {self.root}")
        return found

    def _numbers(self, product_ids: DataFrame) -> DataFrame:
        """All product numbers, the given ids included."""
        new = ds.new_ids(self._table("ids"), product_ids, "product_id")
        new.write.mode("append").parquet(f"{self.root}/ids")
        return self._needed("ids")

    def _days(self) -> DataFrame:
        """Each day with the newest batch that holds it."""
        return self._needed("days").groupBy(DAY).agg(F.max("batch").alias("batch"))

    def _by_day(self, name: str) -> DataFrame:
        return self._needed(name).join(self._days(), [DAY, "batch"], "left_semi").drop("batch")

    def add_categories(self, product_category_map: DataFrame) -> None:
        """Adds products to categories. Giving a row again changes nothing."""
        numbers = self._numbers(product_category_map.select("product_id"))
        numbered = product_category_map.join(numbers, "product_id", "inner")
        ds.seen(numbered, ["category_id"], "number").write.mode("append").parquet(f"{self.root}/mapped")

    def add_days(self, product_snapshot: DataFrame, product_category_map: DataFrame) -> None:
        """Adds the snapshots of one or more whole days, filed under the given categories.

        Snapshots without a time belong to no day and are left out, as they are in
        the marts.
        """
        rows = stage(
            product_snapshot.where(F.col("processed_time").isNotNull()).withColumn(DAY, F.to_date("processed_time")), "mart-days"
        )
        numbers = self._numbers(rows.select("product_id"))
        categories = product_category_map.select("product_id", "category_id").distinct()
        last = (
            latest_all_ties(rows, ["product_id", DAY], "processed_time")
            .groupBy("product_id", DAY)
            .agg(F.bool_or("stock_available").alias("has"), F.bool_or(~F.col("stock_available")).alias("lacks"))
            .join(numbers, "product_id", "inner")
        )
        tests = {ds.BITMAP: F.lit(True), "in_stock": F.col("has"), "out_stock": F.col("lacks")}
        states = {
            "seen": ds.seen(last, [DAY], "number", tests),
            "filed": ds.seen(categories.join(numbers, "product_id", "inner"), ["category_id"], "number"),
            "sums": marts.daily_sums(product_category_map, rows),
            "days": rows.select(DAY).distinct(),
        }
        known = self._table("days")
        batch = 1 + (known.agg(F.coalesce(F.max("batch"), F.lit(0))).first()[0] if known is not None else 0)
        for name, state in states.items():
            # What a batch that was never finished has left is overwritten.
            state.write.mode("overwrite").parquet(f"{self.root}/{name}/batch={batch}")

    def category_product_counts(self, categories: DataFrame) -> DataFrame:
        """As the mart of that name, from the mapped bitmaps."""
        counted = ds.counts(self._needed("mapped"), ["category_id"], {ds.BITMAP: "total_products"})
        known = categories.select("category_id", "category_name").distinct()
        return known.join(counted, "category_id", "inner").orderBy(F.desc("total_products"))

    def category_stock(self, categories: DataFrame) -> DataFrame:
        """The three product counts of the category performance mart.

        A product counts on the last day that saw it: a day's bitmaps lose the products
        seen on later days, and what is left of a batch's days is joined by OR before it
        meets the categories that the batch was filed under.
        """
        names = {"in_stock": "in_stock_products", "out_stock": "out_stock_products"}
        by_day = self._needed("seen").join(self._days(), [DAY, "batch"], "left_semi")
        later = Window.partitionBy(ds.BUCKET).orderBy(F.desc(DAY)).rowsBetween(Window.unboundedPreceding, -1)
        seen_later = by_day.select("batch", ds.BUCKET, *names, F.bitmap_or_agg(ds.BITMAP).over(later).alias("later"))
        own = ds.merged(ds.without(seen_later, list(names), "later"), ["batch"], list(names))
        filed = self._needed("filed").join(own, ["batch", ds.BUCKET], "inner")
        pairs = F.array(*[F.struct(F.lit(n).alias("name"), F.array(n, ds.BITMAP).alias("pair")) for n in names])
        both = filed.select("batch", "category_id", ds.BUCKET, F.explode(pairs).alias("of")).select(
            "batch", "category_id", ds.BUCKET, "of.name", F.explode("of.pair").alias(ds.BITMAP)
        )
        only_here = (
            both.groupBy("batch", "category_id", ds.BUCKET, "name")
            .agg(F.bitmap_count(F.bitmap_and_agg(ds.BITMAP)).alias("here"))
            .groupBy("category_id")
            .agg(*[F.sum(F.when(F.col("name") == n, F.col("here"))).alias(total) for n, total in names.items()])
        )
        counted = ds.counts(self._needed("mapped"), ["category_id"], {ds.BITMAP: "total_products"})
        known = categories.select("category_id", "category_name").distinct()
        joined = known.join(counted, "category_id", "left").join(only_here, "category_id", "left")
        totals = ["total_products", *names.values()]
        return joined.select("category_id", "category_name", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in totals])

    def price_daily(self, categories: DataFrame) -> DataFrame:
        """As the mart of that name, from the days' sums; a day's products need no joining with other days'."""
        known = categories.select("category_id", "category_name").distinct()
        return (
            self._by_day("sums")
            .join(known, "category_id", "inner")
            .select(DAY, "category_id", "category_name", "total_products", *marts._averages())
            .orderBy(DAY, "category_name")
        )
