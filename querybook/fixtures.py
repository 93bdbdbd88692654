"""The given tables in the shapes the operators work on.

Whole tables throughout: each function only renames, casts and derives columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_TS = "2024-06-01 00:00:00"
TIE_BREAKS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]


class Tables:
    """Lazy readers of one scale's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


# --- mart base tables ---------------------------------------------------------


def products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(F.lit("https://shop.example/p/"), "p_partkey").alias("product_url"),
        F.concat(F.lit("https://shop.example/i/"), "p_partkey").alias("image_src"),
    )


def categories(t: Tables) -> DataFrame:
    return t.nation.select(
        F.col("n_nationkey").alias("category_id"), F.col("n_name").alias("category_name")
    )


def product_category_map(t: Tables) -> DataFrame:
    supplied = t.lineitem.select("l_partkey", F.col("l_suppkey").alias("s_suppkey"))
    return (
        supplied.join(t.supplier.select("s_suppkey", "s_nationkey"), "s_suppkey")
        .select(F.col("l_partkey").alias("product_id"), F.col("s_nationkey").alias("category_id"))
        .distinct()
    )


def product_snapshot(t: Tables, keep: list[str] | None = None) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return t.lineitem.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("processed_time"),
        price.alias("price"),
        (price * (1 - F.col("l_discount")).cast("decimal(4,2)")).alias("final_price"),
        (F.col("l_discount") * 100).cast("decimal(6,2)").alias("discount_percent"),
        (F.col("l_linestatus") == "O").alias("stock_available"),
        F.col("l_quantity").cast("bigint").alias("sold_qty"),
        *(keep or []),
    )


def snapshot_ties() -> list[Column]:
    return [F.col(c).asc() for c in TIE_BREAKS]


def pipeline_runs(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("process_run_id"),
        F.col("o_orderdate").alias("processed_at"),
        F.col("o_orderpriority").alias("source_name"),
        F.concat(F.lit("raw/"), "o_orderkey").alias("raw_file_minio"),
        F.col("o_custkey").alias("total_raw_records"),
    )


def data_quality_reports(t: Tables) -> DataFrame:
    def rows(test: Column) -> Column:
        return F.count_if(test)

    returned = F.col("l_returnflag") == "R"
    return t.lineitem.groupBy(F.col("l_orderkey").alias("process_run_id")).agg(
        F.count(F.lit(1)).alias("total_products_seen"),
        rows(~returned).alias("products_passed"),
        rows(returned).alias("products_failed"),
        rows(F.col("l_linenumber") == 1).alias("missing_product_id"),
        rows(F.col("l_linenumber") == 2).alias("missing_product_name"),
        rows(F.col("l_linenumber") == 3).alias("missing_product_url"),
        rows(F.col("l_discount") == 0).alias("invalid_price_negative"),
        rows(F.col("l_tax") == 0).alias("invalid_final_price_negative"),
        rows(F.col("l_linestatus") == "O").alias("final_price_greater_than_price"),
        rows(F.col("l_quantity") > 25).alias("duplicate_product_id"),
    )


def rejected_products(t: Tables) -> DataFrame:
    returned = t.lineitem.filter(F.col("l_returnflag") == "R")
    return returned.select(F.col("l_shipdate").alias("rejected_at"))


def pipeline_task_audit(t: Tables) -> DataFrame:
    status = F.when(F.col("l_linestatus") == "F", "success").otherwise("failed")
    return t.lineitem.select(F.col("l_shipdate").alias("finished_at"), status.alias("status"))


# --- raw feeds ----------------------------------------------------------------


def listing_feed(t: Tables) -> DataFrame:
    """Parts as a listing feed: prices as numbers and as printed amounts."""
    price = F.round("p_retailprice").cast("bigint")
    return t.part.select(
        F.lit(None).cast("string").alias("standard_category"),
        F.col("p_size").alias("source_category_id"),
        F.col("p_type").alias("source_category_name"),
        F.col("p_brand").alias("source_parent_category_name"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        price.alias("price"),
        F.concat(price, F.lit(".000đ")).alias("original_price"),
        F.col("p_size").cast("string").alias("discount"),
        F.concat(F.col("p_size") % 5, F.lit(".5")).alias("rating_average"),
        F.col("p_size").cast("bigint").alias("review_count"),
        F.concat(F.col("p_size"), F.lit(" VND")).alias("sold_qty"),
        F.concat(F.lit("https://shop.example/p/"), "p_partkey").alias("product_url"),
        F.lit(1).alias("crawl_page"),
        F.lit("2024-05-31T10:00:00").alias("crawl_time"),
    )


def simple_feed(t: Tables) -> DataFrame:
    """Parts as a shop feed: a stock flag, no rating, sales or page columns."""
    return t.part.select(
        F.lit("TOYS").alias("standard_category"),
        F.col("p_type").alias("source_category_name"),
        F.concat(F.lit("https://shop.example/c/"), "p_type").alias("source_category_url"),
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").alias("price"),
        F.col("p_retailprice").alias("original_price"),
        (F.col("p_size") > 25).alias("stock_available"),
        F.lit("2024-05-31T11:00:00").alias("crawl_time"),
    )


def catalog_feed(t: Tables) -> DataFrame:
    """Each document as a catalog response, each of its lines as a product."""
    lines = F.split("text", "\n")
    status = F.array(*[F.lit(s) for s in ("success", "no_flashsale_data", "error", "missing_product_url", "no_flashsale_response")])

    def product(line: Column, i: Column) -> Column:
        return F.struct(
            F.concat_ws("-", F.col("doc_id"), i).alias("product_id"),
            line.alias("product_name"),
            F.concat(F.length(line), F.lit(".000 ₫")).alias("product_price"),
            F.length(line).cast("string").alias("product_finalprice"),
            F.concat(i % 100).alias("discount"),
            F.lit(None).cast("string").alias("sold_qty"),
            (i % 2).alias("stock_available"),
            F.concat(F.lit("/d/"), F.col("doc_id"), F.lit("/"), i).alias("product_url"),
            F.lit(None).cast("string").alias("image_src"),
            F.element_at(status, i % 5 + 1).alias("detail_status"),
        )

    return t.documents.select(
        F.col("doc_id"),
        F.col("lang").alias("source_category_name"),
        F.concat(F.lit("/c/"), "lang").alias("source_category_url"),
        F.col("source").alias("source_name"),
        F.lit("2024-05-31T12:00:00").alias("crawl_time"),
        F.struct(F.transform(lines, product).alias("product_list")).alias("body"),
    )


def account_feed(t: Tables) -> DataFrame:
    """Customers and suppliers as products: some balances negative, some names blank."""
    def rows(df: DataFrame, source: str, p: str) -> DataFrame:
        key = F.col(f"{p}key")
        balance = F.round(F.col(f"{p[0]}_acctbal")).cast("bigint")
        return df.select(
            F.lit(source).alias("source_name"),
            key.cast("string").alias("product_id"),
            F.when(key % 7 != 0, F.col(f"{p[0]}_name")).otherwise("  ").alias("product_name"),
            balance.alias("price"),
            (balance + 100).alias("original_price"),
            (balance * 2 - 4000).alias("final_price"),
            F.when(key % 5 != 0, F.concat(F.lit("/a/"), key)).alias("product_url"),
            F.col(f"{p[0]}_nationkey").alias("process_run_id"),
        )

    return rows(t.customer, "customer", "c_cust").unionByName(rows(t.supplier, "supplier", "s_supp"))


def event_feed(t: Tables) -> DataFrame:
    """Events as crawled rows: the event type as source, times as text."""
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.events.select(
        F.col("event_type").alias("source_name"),
        F.col("user_id").cast("string").alias("product_id"),
        F.col("event_id"),
        F.col("value"),
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), time))
        .otherwise(time)
        .alias("crawl_time"),
    )


def document_offers(t: Tables) -> DataFrame:
    """Documents as offers: the whole text is the name, its length the price."""
    from listingloom.functions.names import product_key

    return t.documents.select(
        F.col("source").alias("source_name"),
        F.col("doc_id").alias("product_id"),
        product_key(F.col("text")).alias("product_key"),
        F.col("n_chars").alias("price"),
    )


def shop_pages(t: Tables, shop: str) -> DataFrame:
    """Each document as a shop's listing page, each of its lines as a card."""
    def card(line: Column, i: Column) -> Column:
        title = line
        for mark, escaped in (("&", "&amp;"), ("<", "&lt;"), ('"', "&quot;")):
            title = F.replace(title, F.lit(mark), F.lit(escaped))
        doc, size = F.col("doc_id"), F.length(line)
        pieces = {
            "phuongnam": (
                '<div class="item product-item"><h3><a title="', title, '" href="/p/', F.floor(i / 2),
                '"></a></h3><span class="price">', size, '.000đ</span><del class="old-price">', size + 1,
                '.000đ</del><img data-src="//cdn.example/', doc, "/", i, '.jpg" src="/s.jpg"></div>',
            ),
            "vinabook": (
                '<li class="product-item"><div class="product-img"><img alt="', title, '" data-lazy="i/', i,
                '.jpg"></div><div class="product-detail"><p class="pro-name"><a href="/products/', doc, "-", i,
                '/"></a></p><span class="current-price">', size, '<sup>₫</sup></span></div>'
                '<div class="product-sale"><span>-', i % 100, "%</span></div>",
                F.when(i % 3 == 0, F.concat(F.lit("<a onclick=\"add_to_cart('"), i, F.lit("')\">+</a>"))).otherwise(""),
                F.when(i % 4 == 0, "Hết hàng").otherwise(""),
            ),
            "bookbuy": (
                '<div class="product-item"><div class="img-view" title="', title, '" productid="', i,
                "\" style=\"background:url('/v/", i, ".jpg')\"></div><div class=\"t-view\"><a href=\"/b/", doc, "/", i,
                '"></a></div><div class="p-view"><b class="price">', size, '</b><i class="real-price">', size + 1,
                '</i><i class="sale-off">', i % 100, "%</i></div></div>",
            ),
        }[shop]
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in pieces])

    cards = F.array_join(F.transform(F.split("text", "\n"), card), "\n")
    return t.documents.select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit("<html><body><div class='list'>"), cards, F.lit("</div></body></html>")).alias("html"),
        F.lit("BOOK").alias("standard_category"),
        F.col("lang").alias("source_category_name"),
        F.concat(F.lit("/c/"), "lang").alias("source_category_url"),
        F.col("doc_id").cast("int").alias("crawl_page"),
        F.lit("2024-05-31T12:00:00").alias("crawl_time"),
    )


def write_array_files(df: DataFrame, path: str) -> None:
    """Rows as JSON arrays, one file per task, whatever its size; no array is held in memory."""
    import pyarrow as pa

    def lay_out(batches):
        opening = "["
        for batch in batches:
            texts = batch.column(0).to_pylist()
            if texts:
                yield pa.RecordBatch.from_arrays([pa.array([opening + texts[0], *("," + t for t in texts[1:])])], ["value"])
                opening = ","
        yield pa.RecordBatch.from_arrays([pa.array(["]" if opening == "," else "[]"])], ["value"])

    df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(lay_out, "value string").write.text(path)
