"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom import schemas
from listingloom.functions import categories, names, numbers, web
from listingloom.operators import dedup, enrich, gate, normalize, project, quality, resolve
from listingloom.plans import mart_views, marts, processing
from listingloom.plans.mart_state import MartState
from listingloom.sinks import sized
from listingloom.sinks import tables as sinks
from listingloom.sinks.latest_state import LatestState
from listingloom.sources import feeds, html_cards, json_array, payloads, shop_pages, variant_feed
from listingloom.storage import work_dir
from querybook import fixtures as fx
from querybook.fixtures import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, so that both engines print them alike."""
    shown = {T.DecimalType: "double", T.DateType: "string"}
    return df.select(
        *[
            F.col(f.name).cast(shown[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in shown
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: _plain(build(Tables(spark, sf_dir)))
    return build


def _joined(array: str) -> Column:
    return F.concat_ws(",", array).alias(array)


# --- marts --------------------------------------------------------------------


@query
def category_product_counts(t: Tables) -> DataFrame:
    return marts.category_product_counts(fx.categories(t), fx.product_category_map(t))


@query
def category_performance(t: Tables) -> DataFrame:
    return marts.category_performance(
        fx.categories(t), fx.product_category_map(t), fx.products(t), fx.product_snapshot(t)
    )


@query
def price_daily(t: Tables) -> DataFrame:
    return marts.price_daily(fx.categories(t), fx.product_category_map(t), fx.product_snapshot(t))


@query
def rejected_daily(t: Tables) -> DataFrame:
    return marts.rejected_daily(fx.rejected_products(t))


@query
def task_audit_daily(t: Tables) -> DataFrame:
    return marts.task_audit_daily(fx.pipeline_task_audit(t))


@query
def health_daily(t: Tables) -> DataFrame:
    return marts.pipeline_health_daily(
        fx.pipeline_runs(t),
        fx.data_quality_reports(t),
        fx.rejected_products(t),
        fx.pipeline_task_audit(t),
    )


@query
def quality_runs(t: Tables) -> DataFrame:
    return marts.pipeline_quality_runs(fx.pipeline_runs(t), fx.data_quality_reports(t))


@query
def failure_rate(t: Tables) -> DataFrame:
    return marts.failure_rate(fx.pipeline_runs(t), fx.data_quality_reports(t))


def _latest(t: Tables) -> DataFrame:
    snapshot = fx.product_snapshot(t, fx.TIE_BREAKS)
    return marts.latest_product_snapshot(fx.products(t), snapshot, fx.snapshot_ties())


@query
def latest_one(t: Tables) -> DataFrame:
    return _latest(t)


@query
def latest_all_ties(t: Tables) -> DataFrame:
    snapshot = fx.product_snapshot(t, fx.TIE_BREAKS[:2])
    return dedup.latest_all_ties(snapshot, ["product_id"], "processed_time")


@query
def top_discount(t: Tables) -> DataFrame:
    return marts.top_discount(_latest(t))


@query
def top_sold(t: Tables) -> DataFrame:
    return marts.top_sold(_latest(t))


# --- column functions ---------------------------------------------------------


@query
def parse_long(t: Tables) -> DataFrame:
    printed = F.concat(F.round("p_retailprice").cast("bigint"), F.lit(".000 ₫"))
    grouped = F.concat(F.lit("-"), F.format_number("p_retailprice", 2), F.lit("đ"))
    return t.part.select(
        "p_partkey",
        numbers.parse_long(printed).alias("from_price"),
        numbers.parse_long(grouped).alias("from_negative"),
        numbers.parse_long(grouped, signed=True).alias("from_negative_signed"),
        numbers.parse_long(F.concat("p_size", F.lit(" VND"))).alias("from_currency_word"),
        numbers.parse_long(F.col("p_retailprice"), T.DoubleType()).alias("from_number"),
        numbers.parse_long(F.col("p_size") > 25, T.BooleanType()).alias("from_flag"),
        numbers.parse_long(F.repeat(F.col("p_size").cast("string"), 15)).alias("from_long_text"),
    )


@query
def parse_double(t: Tables) -> DataFrame:
    size = F.col("p_size").cast("string")
    return t.part.select(
        "p_partkey",
        numbers.parse_double(F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("from_text"),
        numbers.parse_double(F.concat(F.lit("-"), size, F.lit("."))).alias("from_open_point"),
        numbers.parse_double(F.concat(F.lit("."), size)).alias("from_bare_fraction"),
        numbers.parse_double(F.concat(size, F.lit("e3"))).alias("from_exponent"),
        numbers.parse_double(F.concat(size, F.lit(",5"))).alias("from_comma"),
    )


@query
def digits_price(t: Tables) -> DataFrame:
    amount = F.round("p_retailprice").cast("bigint")
    return t.part.select(
        "p_partkey",
        numbers.digits_price(F.concat(amount, F.lit(".000đ - "), F.col("p_size"))).alias("from_range"),
        numbers.digits_price(F.concat(F.lit("-"), F.col("p_size"), F.lit(" VND"))).alias("from_words"),
        numbers.digits_price(F.col("p_type")).alias("from_no_digits"),
    )


@query
def first_number(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey",
        numbers.first_number(F.col("p_brand")).alias("from_brand"),
        numbers.first_number(F.concat("p_brand", F.lit(" -"), "p_size", F.lit("%"))).alias("from_two"),
        numbers.first_number(F.col("p_type")).alias("from_none"),
    )


@query
def product_key(t: Tables) -> DataFrame:
    """Whole texts, and part names dressed up as shop titles."""
    dressed = F.concat(
        F.initcap("p_name"), F.lit(" (Tái Bản 2023) [HOT] - Bìa Mềm, Tặng Kèm "), F.col("p_brand")
    )
    texts = t.documents.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.col("text").alias("name"))
    titles = t.part.select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), dressed.alias("name"))
    keyed = texts.unionByName(titles).withColumn("key", names.product_key(F.col("name")))
    return keyed.select(
        "kind",
        "id",
        F.md5("key").alias("key_md5"),
        F.length("key").alias("key_length"),
        names.block_key(F.col("key")).alias("block_key"),
        F.size(names.word_list(F.col("key"))).alias("words"),
    )


ENGLISH_RULES = [
    ("RINGS", ["ring", "wheel"]),
    ("COLOURED", ["red", "blue", "green"]),
    ("CHEAP", ["economy", "small"]),
    ("PROMOTED", ["promo"]),
]


@query
def classify_category(t: Tables) -> DataFrame:
    shop_names = F.concat(F.col("p_type"), F.lit(" Sách"))
    return t.part.select(
        "p_partkey",
        categories.classify_category(F.col("p_type"), F.col("p_name"), ENGLISH_RULES).alias("by_type_and_name"),
        categories.classify_category(F.lit(None).cast("string"), F.col("p_type"), ENGLISH_RULES).alias("by_type"),
        categories.classify_category(
            F.when(F.col("p_size") > 25, shop_names).otherwise("Đồ chơi"), F.col("p_name")
        ).alias("by_shop_rules"),
    )


@query
def absolute_url(t: Tables) -> DataFrame:
    base = "https://shop.example"
    path = F.regexp_replace("url", r"^https?://[^/]*", "")
    return t.pages.select(
        "page_id",
        web.absolute_url(F.col("url"), base).alias("from_full"),
        web.absolute_url(path, base).alias("from_rooted"),
        web.absolute_url(F.concat(F.lit("/"), path), base).alias("from_scheme_relative"),
        web.absolute_url(F.regexp_replace(path, "^/", ""), base).alias("from_relative"),
        web.absolute_url(F.concat(F.lit("?page="), "page_id"), base).alias("from_query"),
        web.absolute_url(F.lit(""), base).alias("from_empty"),
    )


# --- sources ------------------------------------------------------------------


@query
def scan_jsonl(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "feed") + "/part.jsonl"
    part = t.part
    part.write.json(path)
    rows = feeds.with_raw_file(feeds.read_feed(t.spark, path, part.schema))
    return rows.select(
        *part.columns,
        F.col("raw_file").contains("part.jsonl").alias("has_lineage"),
        F.col(feeds.CORRUPT).isNotNull().alias("is_corrupt"),
    )


@query
def scan_json_array(t: Tables) -> DataFrame:
    """Array files of at most 500 parts each: their number grows, not their size."""
    path = work_dir(t.spark, "feed") + "/arrays"
    part = t.part
    chunk = F.floor(F.col("p_partkey") / 500).alias("chunk")
    arrays = part.groupBy(chunk).agg(F.to_json(F.collect_list(F.struct(*part.columns))).alias("value"))
    arrays.repartition("chunk").write.partitionBy("chunk").text(path)
    return feeds.read_feed(t.spark, path, part.schema).select(*part.columns)


@query
def variant_feed_forms(t: Tables) -> DataFrame:
    """Parts as lines whose fields have several types, some broken, read without a layout."""
    root = work_dir(t.spark, "variant")
    p = F.col("p_partkey")
    price = (
        F.when(p % 5 == 0, F.concat(F.lit(', "price": '), p))
        .when(p % 5 == 1, F.concat(F.lit(', "price": "'), p % 900 + 1, F.lit('.000đ"')))
        .when(p % 5 == 2, F.lit(', "price": true'))
        .when(p % 5 == 3, F.concat(F.lit(', "price": {"value": '), p, F.lit("}")))
        .otherwise("")
    )
    item = F.when(p % 2 == 0, p.cast("string")).otherwise(F.concat(F.lit('"'), p, F.lit('"')))
    line = F.concat(
        F.lit('{"product_id": '), item, F.lit(', "product_name": "part '), p, F.lit('"'), price,
        F.when(p % 11 == 0, "").otherwise("}"),
    )
    t.part.select(line.alias("value")).write.text(f"{root}/parts.jsonl")
    feed = variant_feed.read_variant_feed(t.spark, f"{root}/parts.jsonl")
    rows = variant_feed.normalize_variant(feed, "vinabook", normalize.SIMPLE, fx.RUN_TS)
    return rows.select("product_id", "product_name", "price", F.md5(feeds.CORRUPT).alias("broken_md5"))


@query
def scan_json_array_ranges(t: Tables) -> DataFrame:
    """All documents, texts of many lines and escapes, as array files read in ranges of 64 KB."""
    path = work_dir(t.spark, "feed") + "/documents.json"
    docs = t.documents
    fx.write_array_files(docs, path)
    rows = json_array.read_json_array(t.spark, path, docs.schema, feeds.CORRUPT, range_bytes=1 << 16)
    return rows.select(
        "doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars",
        F.col("raw_file").contains("documents.json").alias("has_lineage"),
        F.col(feeds.CORRUPT).isNotNull().alias("is_corrupt"),
    )


@query
def latest_raw_file(t: Tables) -> DataFrame:
    """Two runs and a later side file per source; the second run's file is newest."""
    root = work_dir(t.spark, "raw")
    types = t.events.select("event_type", "event_id", "value")
    for run in ("run1", "run2", "run2_stats"):
        named = types.withColumn("run", F.lit(run))
        named.write.mode("append").partitionBy("event_type", "run").json(root)
    files = feeds.list_feed_files(t.spark, root)
    source = F.regexp_extract(feeds.below(root), "event_type=([^/]*)", 1)
    newest = feeds.latest_feed_file(files.withColumn("source_name", source), ["source_name"])
    return newest.select("source_name", F.regexp_extract("path", "run=([^/]*)", 1).alias("newest_run"))


@query
def nested_catalog_explode(t: Tables) -> DataFrame:
    rows = normalize.normalize(fx.catalog_feed(t), "fahasa", normalize.CATALOG, fx.RUN_TS)
    return rows.select(
        "source_name", "standard_category", "source_category_name", "source_category_url",
        "product_id", F.md5("product_name").alias("name_md5"), "price", "original_price",
        "final_price", "discount", "rating_average", "sold_qty", "stock_available", "product_url",
        "image_url", "crawl_page", "crawl_time", "processed_time",
    )


@query
def catalog_envelope(t: Tables) -> DataFrame:
    """The same responses captured as JSON text, parsed back into the feed layout."""
    captured = fx.catalog_feed(t).select(
        "source_category_name", "source_category_url", "crawl_time",
        F.concat(F.lit("/api/"), "doc_id").alias("response_url"),
        F.lit(200).alias("status"),
        F.create_map(F.lit("content-type"), F.lit("application/json")).alias("headers"),
        F.to_json("body").alias("body_text"),
    )
    feed = payloads.catalog_envelope(captured, "body_text", "fahasa", "run-1")
    return feed.select(
        "source_name", "run_id", "step", "source_category_name", "response_url", "status",
        F.col("headers").getItem("content-type").alias("content_type"), "is_success",
        F.size("body.product_list").alias("products"),
        F.md5(F.element_at("body.product_list", -1)["product_name"]).alias("last_name_md5"),
    )


@query
def nested_empty(t: Tables) -> DataFrame:
    """A catalog feed without its product array adds no row and stops no other source."""
    broken = t.documents.select("doc_id", F.col("source").alias("source_name"))
    empty = normalize.normalize_source(broken, "fahasa", fx.RUN_TS)
    listing = normalize.normalize_source(fx.listing_feed(t), "tiki", fx.RUN_TS)
    return normalize.union_sources([empty, listing]).select("source_name", "product_id", "product_name")


@query
def listing_api_explode(t: Tables) -> DataFrame:
    """Each document as a stored listing page, each of its lines as an item."""
    def item(line: Column, i: Column) -> Column:
        sold = F.when(i % 3 == 0, F.struct(F.length(line).cast("bigint").alias("value")))
        return F.struct(
            (F.col("doc_id") * 100000 + i).alias("id"),
            line.alias("name"),
            F.length(line).cast("bigint").alias("price"),
            (F.length(line) + 1).cast("bigint").alias("original_price"),
            (i % 50).cast("bigint").alias("discount"),
            (i % 5 + 0.5).cast("double").alias("rating_average"),
            i.cast("bigint").alias("review_count"),
            sold.alias("quantity_sold"),
            F.when(i % 4 != 0, F.concat_ws("/", F.lit("d"), "doc_id", i)).alias("url_path"),
        )

    pages = t.documents.select(
        "doc_id",
        "lang",
        F.to_json(F.struct(F.transform(F.split("text", "\n"), item).alias("data"))).alias("body"),
    )
    rows = payloads.listing_products(
        pages, "body", "https://shop.example", "tiki", F.lit("2024-05-31T12:00:00"),
        F.lit(1), F.col("doc_id"), F.col("lang"), F.lit("Sách"),
    )
    return rows.select(
        "standard_category", "source_category_id", "source_category_name", "product_id",
        F.md5("product_name").alias("name_md5"), "price", "original_price", "discount",
        "rating_average", "review_count", "sold_qty", "product_url", "crawl_page",
        F.get_json_object("raw", "$.id").alias("raw_id"),
    )


@query
def category_tree_flatten(t: Tables) -> DataFrame:
    """Regions, below them nations, below them the customers' market segments."""
    regions = t.region.select(
        F.concat(F.lit("r"), "r_regionkey").alias("category_id"),
        F.col("r_name").alias("category_name"),
        F.lower("r_name").alias("url_key"),
        F.lit(None).cast("string").alias("parent_id"),
    )
    nations = t.nation.select(
        F.concat(F.lit("n"), "n_nationkey"),
        "n_name",
        F.when(F.col("n_nationkey") % 6 != 0, F.lower("n_name")),
        F.concat(F.lit("r"), "n_regionkey"),
    )
    segments = t.customer.select("c_nationkey", "c_mktsegment").distinct().select(
        F.concat_ws("-", F.lit("s"), "c_nationkey", "c_mktsegment"),
        "c_mktsegment",
        F.lower("c_mktsegment"),
        F.concat(F.lit("n"), "c_nationkey"),
    )
    return payloads.flatten_category_tree(regions.union(nations).union(segments))


@query
def nested_category_payloads(t: Tables) -> DataFrame:
    """Each document as a stored category payload, its lines as children, each with a child of its own."""
    def category(id_: Column, name: Column, key: Column, children: Column | None = None) -> Column:
        fields = [id_.alias("id"), name.alias("name"), key.alias("url_key")]
        return F.struct(*fields, *([] if children is None else [children.alias("children")]))

    def line(text: Column, i: Column) -> Column:
        id_ = F.concat_ws("-", "doc_id", i)
        inner = F.array(category(F.concat(id_, F.lit("-n")), F.length(text).cast("string"), F.lit("size")))
        return category(id_, F.md5(text), F.when(i % 4 > 0, F.concat(F.lit("l"), i)), inner)

    lines = F.transform(F.split("text", "\n"), line)
    body = F.to_json(category(F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), lines)).alias("body")
    nodes = payloads.nested_categories(t.documents.select(body), "body")
    return payloads.flatten_category_tree(nodes)


@query
def category_chain(t: Tables) -> DataFrame:
    """All customers as one chain of categories in the order of their keys, and a cycle of three beside it."""
    key = F.col("c_custkey")
    chain = t.customer.select(
        key.cast("string").alias("category_id"),
        F.col("c_mktsegment").alias("category_name"),
        F.lit("k").alias("url_key"),
        F.when(key > 0, (key - 1).cast("string")).alias("parent_id"),
    )
    cycle = t.customer.select(
        F.concat(F.lit("c"), key % 3), "c_mktsegment", F.lit("k"), F.concat(F.lit("c"), (key + 1) % 3)
    )
    return payloads.flatten_category_tree(chain.union(cycle))


LINKS = html_cards.CardSpec("li a", {"name_text": ("", "text"), "link": ("", "href")})


@query
def html_cards_query(t: Tables) -> DataFrame:
    return html_cards.extract_cards(t.pages, LINKS, ["page_id"])


QUERIES["html_cards"] = QUERIES.pop("html_cards_query")


@query
def html_field_fallbacks(t: Tables) -> DataFrame:
    """Cards with the shops' id, link, image and stock markup on them."""
    cards = html_cards.extract_cards(t.pages, LINKS, ["page_id"])
    tenth = F.col("pos") % 10
    dressed = cards.select(
        "page_id",
        "pos",
        F.when(tenth == 1, F.lit("")).otherwise(F.concat(F.lit(" "), "name_text")).alias("name_title"),
        F.concat_ws(" ", F.lit("alt"), "name_text").alias("name_text"),
        F.col("link"),
        F.when(tenth < 5, F.concat(F.lit("add_to_cart('"), "page_id", F.lit("')"))).alias("cart_call"),
        F.lit("").alias("image_data_src"),
        F.when(tenth < 7, F.concat(F.lit("//img.example"), "link")).alias("image_src"),
        F.concat(F.lit("background:url('"), "link", F.lit("') left")).alias("view_style"),
        F.concat("pos", F.lit(".000đ")).alias("price_text"),
        F.concat(F.lit("- "), "pos", F.lit("%")).alias("discount_text"),
        F.concat("name_text", F.when(tenth == 0, F.lit(" HẾT HÀNG")).otherwise("")).alias("card_text"),
    )
    return shop_pages.clean_cards(dressed, "https://shop.example").select(
        "page_id", "pos", "product_name", "product_url", "image_url", "product_id", "price",
        "original_price", "discount", "stock_available",
    )


def _shop_cards(t: Tables, shop: shop_pages.Shop) -> DataFrame:
    rows = shop_pages.shop_products(fx.shop_pages(t, shop.source_name), shop)
    return rows.select(
        "source_name", "source_category_name", "crawl_page", "product_id",
        F.md5("product_name").alias("name_md5"), "price", "original_price", "discount",
        "stock_available", "product_url", "image_url",
    )


@query
def html_phuongnam(t: Tables) -> DataFrame:
    return _shop_cards(t, shop_pages.PHUONGNAM)


@query
def html_vinabook(t: Tables) -> DataFrame:
    return _shop_cards(t, shop_pages.VINABOOK)


@query
def html_bookbuy(t: Tables) -> DataFrame:
    return _shop_cards(t, shop_pages.BOOKBUY)


# --- projection and normalization ---------------------------------------------


@query
def project_tolerant(t: Tables) -> DataFrame:
    part = t.part
    return part.select(
        project.column_or_null(part, "p_partkey", "string").alias("p_partkey"),
        project.column_or_null(part, "p_name", "string").alias("p_name"),
        project.column_or_null(part, "p_weight", "bigint").alias("p_weight"),
    )


@query
def project_nested_tolerant(t: Tables) -> DataFrame:
    nested = t.orders.select(
        "o_orderkey", F.struct("o_orderstatus", F.struct("o_totalprice").alias("sum")).alias("o")
    )
    return nested.select(
        "o_orderkey",
        project.column_or_null(nested, "o.sum.o_totalprice", "double").alias("total"),
        project.column_or_null(nested, "o.sum.absent", "double").alias("absent"),
        project.column_or_null(nested, "o.o_orderstatus.deeper", "string").alias("too_deep"),
        F.lit(project.field_type(nested.schema, "o.sum.o_totalprice").simpleString()).alias("total_type"),
    )


def _canonical(df: DataFrame) -> DataFrame:
    return df.select(*[f.name for f in schemas.PRODUCT.fields if f.name != "raw_file"])


@query
def normalize_listing(t: Tables) -> DataFrame:
    return _canonical(normalize.normalize_source(fx.listing_feed(t), "tiki", fx.RUN_TS))


@query
def normalize_simple(t: Tables) -> DataFrame:
    return _canonical(normalize.normalize_source(fx.simple_feed(t), "vinabook", fx.RUN_TS))


@query
def normalize_union(t: Tables) -> DataFrame:
    listing = normalize.normalize_source(fx.listing_feed(t), "tiki", fx.RUN_TS)
    simple = normalize.normalize_source(fx.simple_feed(t), "bookbuy", fx.RUN_TS)
    lacking = simple.drop("stock_available", "original_price")
    return _canonical(normalize.union_sources([listing, lacking]))


@query
def category_allowlist(t: Tables) -> DataFrame:
    """Parts of the types and brands that have a part of the largest size."""
    large = t.part.filter(F.col("p_size") == 50).select("p_brand").distinct()
    return enrich.allow_categories(t.part, "p_brand", large).select("p_partkey", "p_brand", "p_type")


@query
def enrich_detail(t: Tables) -> DataFrame:
    orders = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("/o/"), "o_orderkey")).alias("product_url"),
        F.lit(None).cast("int").alias("stock_available"),
        F.lit(-1).cast("bigint").alias("sold_qty"),
    )
    lines = F.count(F.lit(1))
    quantity = F.sum("l_quantity").cast("bigint")
    details = t.lineitem.groupBy("l_orderkey").agg(
        (F.max("l_linenumber") > 1).alias("has_response"),
        F.when(lines == 3, F.lit("HTTP 500")).alias("error"),
        F.when(lines != 5, quantity - 100).alias("buffer_value"),
        F.when(lines != 5, quantity).alias("total_sold"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd").alias("detail_crawl_time"),
    )
    details = details.withColumn("product_url", F.concat(F.lit("/o/"), "l_orderkey")).drop("l_orderkey")
    older = details.withColumns({"error": F.lit("stale"), "detail_crawl_time": F.lit("1900-01-01")})
    nowhere = details.withColumn("product_url", F.lit(None).cast("string"))
    return enrich.enrich_detail(orders, details.unionByName(older).unionByName(nowhere))


# --- deduplication, validation, counts ----------------------------------------


@query
def dedup_key(t: Tables) -> DataFrame:
    part = t.part
    third = F.col("p_partkey") % 7
    name = F.when(third == 4, F.lit("漢字")).when(third == 5, F.lit("  ")).otherwise(F.col("p_name"))
    return part.select(
        "p_partkey",
        dedup.dedup_key(
            F.when(third == 0, F.col("p_partkey").cast("string")).when(third == 1, F.lit(" ")),
            F.when(third <= 2, F.concat(F.lit("/p/"), "p_partkey")).otherwise(" "),
            names.product_key(name),
            name,
        ).alias("dedup_key"),
    )


@query
def latest_per_source_key(t: Tables) -> DataFrame:
    """A third of the rows share one key, a tenth have none and all stay."""
    event = F.col("event_id")
    feed = fx.event_feed(t).withColumn(
        "product_id",
        F.when(event % 10 == 0, F.lit(None)).when(event % 3 == 0, "hot").otherwise(F.col("product_id")),
    )
    latest = dedup.latest_or_keyless(
        feed, ["source_name", "product_id"], "product_id", "crawl_time", [event.asc()]
    )
    return latest.select("source_name", "product_id", "event_id", "value", "crawl_time")


@query
def latest_state_two_feeds(t: Tables) -> DataFrame:
    """The same rows as two feeds, one added to the stored state of the other."""
    event = F.col("event_id")
    feed = fx.event_feed(t).withColumn(
        "product_id",
        F.when(event % 10 == 0, F.lit(None)).when(event % 3 == 0, "hot").otherwise(F.col("product_id")),
    )
    state = LatestState(t.spark, work_dir(t.spark, "state"), "source_name", "product_id", "crawl_time", [event.asc()], 8)
    earlier = F.crc32(event.cast("string").cast("binary")) % 3 > 0
    state.add(feed.where(earlier))
    state.add(feed.where(~earlier))
    return state.read().select("source_name", "product_id", "event_id", "value", "crawl_time")


@query
def first_wins_dedup(t: Tables) -> DataFrame:
    first = dedup.first_wins(t.documents, ["text"], [F.col("doc_id")])
    return first.select("doc_id", "source", "n_chars")


@query
def validate_rows(t: Tables) -> DataFrame:
    checked = quality.add_validation_errors(fx.account_feed(t))
    return checked.select("source_name", "product_id", "price", _joined("validation_errors"))


@query
def valid_rows(t: Tables) -> DataFrame:
    checked = quality.add_validation_errors(fx.account_feed(t))
    return quality.valid_rows(checked).select("source_name", "product_id", "product_name", "price")


@query
def rejected_rows(t: Tables) -> DataFrame:
    rejected = quality.rejected_rows(quality.add_validation_errors(fx.account_feed(t)))
    return rejected.select("source_name", "product_id", "price", _joined("validation_errors"))


@query
def reject_report(t: Tables) -> DataFrame:
    """The whole report as written by source and read back."""
    rejected = quality.rejected_rows(quality.add_validation_errors(fx.account_feed(t)))
    path = work_dir(t.spark, "rejects")
    sinks.write_report(sinks.reject_report(rejected), path, by="source_name")
    columns = "source_name string, product_id string, product_name string, price bigint, validation_errors array<string>"
    rows = t.spark.read.schema(columns).json(path)
    return rows.select("source_name", "product_id", "product_name", "price", _joined("validation_errors"))


@query
def data_quality_report(t: Tables) -> DataFrame:
    """Counters per nation over customers and suppliers, ids made to repeat."""
    repeated = F.when(
        F.col("product_id").cast("bigint") % 11 != 0, F.col("product_id").cast("bigint") % 40
    )
    checked = quality.add_validation_errors(fx.account_feed(t).withColumn("product_id", repeated))
    return quality.data_quality_report(checked, "process_run_id")


@query
def stage_counts(t: Tables) -> DataFrame:
    events = fx.event_feed(t)
    valid = events.filter(F.col("value") >= 20)
    return quality.stage_counts(events, valid, valid.filter(F.col("source_name") != "error"))


@query
def run_summary(t: Tables) -> DataFrame:
    """The summary as written and read back: a row per source and one for all."""
    events = fx.event_feed(t)
    valid = events.filter(F.col("value") >= 20)
    counts = quality.stage_counts(events, valid, valid.filter(F.col("source_name") != "error"))
    path = work_dir(t.spark, "summary")
    malformed = F.when(F.col("value") < 5, F.array(F.lit("malformed_record"))).otherwise(F.array().cast("array<string>"))
    rejected = events.filter(F.col("value") < 20).withColumn("validation_errors", malformed)
    files = {"click": "raw/click/1.jsonl", "view": "raw/view/7.jsonl"}
    sinks.write_report(sinks.run_summary(counts, rejected, fx.RUN_TS, {"products": "p"}, files), path)
    columns = [
        "processed_at string", "engine string", "source_name string", "source_file string",
        "total_before_validate bigint", "total_valid_before_dedup bigint", "total_after_dedup bigint",
        "bad_products bigint", "malformed_records bigint", "duplicate_products bigint",
    ]
    return t.spark.read.schema(", ".join(columns)).json(path)


@query
def feed_totals(t: Tables) -> DataFrame:
    runs = t.events.select("event_type", F.to_date("ts").alias("run_id"))
    return quality.feed_totals(runs, ["event_type", "run_id"])


@query
def crawl_summary(t: Tables) -> DataFrame:
    return quality.crawl_summary(fx.catalog_feed(t))


@query
def completeness_check(t: Tables) -> DataFrame:
    return quality.completeness_check(t.part, t.lineitem, "p_size")


# --- the published table ------------------------------------------------------


@query
def table_sample(t: Tables) -> DataFrame:
    return gate.table_sample(t.events.select("event_id", "event_type", "value"), order_by=["event_id"])


@query
def freshness_check(t: Tables) -> DataFrame:
    check = gate.freshness_check(fx.event_feed(t))
    return check.withColumn(
        "last_crawl_time", F.date_format("last_crawl_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


EVENT_SOURCES = {"required": ["click", "view", "purchase", "refund"], "optional": ["error", "share"]}


@query
def source_coverage(t: Tables) -> DataFrame:
    return gate.source_coverage(fx.event_feed(t), **EVENT_SOURCES)


@query
def dataset_gate(t: Tables) -> DataFrame:
    return gate.dataset_gate(fx.event_feed(t), **EVENT_SOURCES)


@query
def write_single_parquet(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "products")
    sinks.write_table(t.documents, path)
    return t.spark.read.parquet(path).select("doc_id", "source", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query
def write_sized_parquet(t: Tables) -> DataFrame:
    """Line items in files of about 256 KB, however many tasks wrote them first."""
    path = work_dir(t.spark, "sized")
    sized.write_sized(t.lineitem.repartition(16), path, 256 << 10)
    return t.spark.read.parquet(path).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_returnflag")


@query
def write_partitioned_parquet(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "products-by-source")
    sinks.write_partitioned(t.documents, path, "source")
    return t.spark.read.parquet(path).select("doc_id", "source", "lang", "n_chars", F.md5("text").alias("text_md5"))


@query
def publish_table(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "published")
    sinks.write_partitioned(t.events, path, "event_type")
    return sinks.publish_table(t.spark, "events_final", path).select("event_id", "event_type", "user_id", "value")


@query
def publish_external_table(t: Tables) -> DataFrame:
    """Published twice, the second time from another folder, and read by another session."""
    name = f"events_{uuid.uuid4().hex}"
    kept = t.events.select("event_id", "event_type", "user_id", "value")
    for rows in (kept.where("event_id % 2 = 0"), kept):
        path = work_dir(t.spark, "external")
        sinks.write_table(rows, path)
        sinks.publish_external_table(t.spark, name, path, kept.schema)
    return t.spark.newSession().table(name)


def _mart_tables(t: Tables) -> dict[str, DataFrame]:
    return {
        "categories": fx.categories(t),
        "product_category_map": fx.product_category_map(t),
        "products": fx.products(t),
        "product_snapshot": fx.product_snapshot(t, fx.TIE_BREAKS),
        "pipeline_runs": fx.pipeline_runs(t),
        "data_quality_reports": fx.data_quality_reports(t),
        "rejected_products": fx.rejected_products(t),
        "pipeline_task_audit": fx.pipeline_task_audit(t),
    }


def _mart_view(view: str) -> Callable[[Tables], DataFrame]:
    """The view from a view book over stored tables, read by a session that has not made it."""

    def read(t: Tables) -> DataFrame:
        views, needed = mart_views.mart_views(fx.TIE_BREAKS), {view}
        for name in (view, *views[view].reads):
            needed.update(views[name].reads if name in views else ())
        root = work_dir(t.spark, "marts")
        folders = {}
        for name, rows in _mart_tables(t).items():
            if name in needed:
                folders[name] = f"{root}/{name}"
                sinks.write_table(rows, folders[name])
        book = mart_views.ViewBook(t.spark, f"{root}/book")
        book.publish(folders, {name: views[name] for name in needed if name in views})
        other = t.spark.newSession()
        mart_views.ViewBook(other, book.root).open()
        return other.table(f"default.{view}")

    return read


#: The nine named views, each with the query that its rows equal.
MART_VIEWS = {
    "vw_category_product_counts": "category_product_counts",
    "vw_dm_category_performance": "category_performance",
    "vw_dm_pipeline_health_daily": "health_daily",
    "vw_pipeline_quality_runs": "quality_runs",
    "vw_pipeline_failure_rate": "failure_rate",
    "vw_dm_price_daily": "price_daily",
    "vw_latest_product_snapshot": "latest_one",
    "vw_top_discount_products": "top_discount",
    "vw_top_sold_products": "top_sold",
}
for _view in MART_VIEWS:
    _read = _mart_view(_view)
    _read.__name__ = _view
    query(_read)


def _mart_state(t: Tables) -> MartState:
    """Two thirds of the days, then the last third, added to the state of the first."""
    state = MartState(t.spark, work_dir(t.spark, "mart-state"))
    state.add_categories(fx.product_category_map(t))
    snapshot = fx.product_snapshot(t)
    late = F.crc32(F.to_date("processed_time").cast("string").cast("binary")) % 3 == 0
    for days in (snapshot.where(~late), snapshot.where(late)):
        state.add_days(days, fx.product_category_map(t))
    return state


@query
def merged_category_counts(t: Tables) -> DataFrame:
    return _mart_state(t).category_product_counts(fx.categories(t))


@query
def merged_category_stock(t: Tables) -> DataFrame:
    return _mart_state(t).category_stock(fx.categories(t))


@query
def merged_price_daily(t: Tables) -> DataFrame:
    return _mart_state(t).price_daily(fx.categories(t))


@query
def describe_table(t: Tables) -> DataFrame:
    path = work_dir(t.spark, "published")
    sinks.write_table(t.events, path)
    return sinks.describe_table(sinks.publish_table(t.spark, "events_described", path))


# --- entity resolution --------------------------------------------------------

ID = ["product_id"]


@query
def er_candidate_pairs(t: Tables) -> DataFrame:
    offers = resolve.offers(fx.document_offers(t), ID)
    sets = resolve.word_sets(offers)
    posted = resolve.postings(resolve.numbered(sets), resolve.by_number(resolve.distinct_offers(offers), sets))
    return resolve.named_pairs(resolve.candidate_pairs(posted), sets)


def _scored(t: Tables) -> DataFrame:
    return resolve.scored_pairs(resolve.offers(fx.document_offers(t), ID), ID)


def _rounded(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns(
        {c: F.round(c, 6) for c in ("name_score", "similarity_score")}
    )


@query
def er_scored_pairs(t: Tables) -> DataFrame:
    return _rounded(_scored(t))


@query
def er_matched_pairs(t: Tables) -> DataFrame:
    return _rounded(resolve.matched_pairs(_scored(t)))


@query
def er_duplicates(t: Tables) -> DataFrame:
    offers = fx.document_offers(t)
    found = resolve.duplicates(offers, resolve.find_duplicates(offers, ID))
    return found.select("source_name", "product_id", "price")


@query
def er_survivors(t: Tables) -> DataFrame:
    offers = fx.document_offers(t)
    kept = resolve.survivors(offers, resolve.find_duplicates(offers, ID))
    return kept.select("source_name", "product_id", "price")


@query
def er_exact_survivors(t: Tables) -> DataFrame:
    """Equal names across sources merged as well."""
    offers = fx.document_offers(t)
    kept = resolve.survivors(offers, resolve.find_duplicates(offers, ID, include_exact=True))
    return kept.select("source_name", "product_id", "price")


@query
def duplicate_report(t: Tables) -> DataFrame:
    offers = fx.document_offers(t).withColumns(
        {"product_name": F.col("source_name"), "processed_time": F.lit(fx.RUN_TS)}
    )
    found = resolve.duplicates(offers, resolve.find_duplicates(offers, ID))
    return sinks.duplicate_report(found)


# --- the whole run ------------------------------------------------------------


def _document_feeds(t: Tables, documents: DataFrame, root: str) -> dict[str, str]:
    """Documents as raw feeds of the five shops."""
    feed_no = F.regexp_extract("source", "([0-9]+)", 1).cast("int") % 5
    documents = documents.withColumn("feed_no", feed_no)
    crawl_time = F.concat(F.lit("2024-05-01 "), F.lpad(F.col("n_chars").cast("string"), 8, "0"))
    flat = [
        F.col("doc_id").alias("product_id"),
        F.col("text").alias("product_name"),
        F.col("n_chars").alias("price"),
        F.concat(F.lit("/d/"), F.floor(F.col("doc_id") / 2)).alias("product_url"),
        crawl_time.alias("crawl_time"),
    ]
    nested = F.array(
        F.struct(
            F.col("doc_id").cast("string").alias("product_id"),
            F.col("text").alias("product_name"),
            F.concat("n_chars", F.lit(" ₫")).alias("product_price"),
            F.concat(F.lit("/d/"), "doc_id").alias("product_url"),
        )
    )
    paths = {}
    for number, source in enumerate(schemas.SOURCES):
        paths[source] = f"{root}/{source}/{source}_raw.jsonl"
        rows = documents.filter(F.col("feed_no") == number)
        if source == "fahasa":
            rows = rows.select(F.struct(nested.alias("product_list")).alias("body"), crawl_time.alias("crawl_time"))
        elif source == "phuongnam":
            rows = rows.select(*flat[1:])
        else:
            rows = rows.select(*flat)
        rows.write.option("compression", "gzip").json(paths[source])
    return paths


def _processed_products(t: Tables, path: str) -> DataFrame:
    return t.spark.read.parquet(path).select(
        "source_name", "product_id", "price", "final_price", "product_url",
        F.md5("product_name").alias("name_md5"), "crawl_time", "processed_time",
    )


@query
def process_end_to_end(t: Tables) -> DataFrame:
    """Documents written as five raw feeds, processed, and the product table read back."""
    root = work_dir(t.spark, "run")
    paths = _document_feeds(t, t.documents, f"{root}/raw")
    return _processed_products(t, processing.run(t.spark, paths, f"{root}/processed", fx.RUN_TS).products)


@query
def process_two_updates(t: Tables) -> DataFrame:
    """The same documents as two deliveries, the second added to the state of the first."""
    root = work_dir(t.spark, "updates")
    first = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    for number, rows in enumerate([t.documents.where(first), t.documents.where(~first)]):
        paths = _document_feeds(t, rows, f"{root}/raw{number}")
        out = processing.run_update(t.spark, f"{root}/state", paths, f"{root}/processed{number}", fx.RUN_TS, buckets=4)
    return _processed_products(t, out.products)


@query
def raw_feed_forms(t: Tables) -> DataFrame:
    """Parts as lines with every form of number and some broken ones, through the whole run."""
    root = work_dir(t.spark, "forms")
    p, form = F.col("p_partkey"), F.col("p_partkey") % 7
    price = (
        F.when(form == 0, p.cast("string"))
        .when(form == 1, F.concat(p, F.lit(".0")))
        .when(form == 2, F.concat(p, F.lit(".5e3")))
        .when(form == 3, F.concat(F.lit('"'), p % 900 + 1, F.lit('.000đ"')))
        .when(form == 4, F.concat(F.lit('"'), p, F.lit('"')))
        .otherwise(F.concat(F.lit("-"), p))
    )
    stock = F.when(p % 3 == 0, F.lit("7")).when(p % 3 == 1, F.lit("true")).otherwise(F.lit("false"))
    line = F.concat(
        F.lit('{"product_id": "'), p, F.lit('", "product_name": "part '), p, F.lit('", "stock_available": '), stock,
        F.lit(', "price": '), F.when(form == 6, F.lit("")).otherwise(F.concat(price, F.lit("}"))),
    )
    feed = f"{root}/raw/vinabook/lines.jsonl"
    t.part.select(line.alias("value")).repartition(5).write.text(feed)
    out = processing.run(t.spark, {"vinabook": feed}, f"{root}/out", fx.RUN_TS)
    products = t.spark.read.parquet(out.products).select(
        F.col("product_id").alias("item"), "price", F.col("stock_available").cast("bigint").alias("stock")
    )
    rejects = t.spark.read.schema("validation_errors array<string>").json(out.rejects)
    rules = rejects.select(F.explode("validation_errors").alias("item")).groupBy("item")
    return products.unionByName(rules.agg(F.count(F.lit(1)).alias("price")), allowMissingColumns=True)


@query
def latest_raw_folder(t: Tables) -> DataFrame:
    """Two feeds of several parts for each of two shops; all parts of the newer one are read."""
    root = work_dir(t.spark, "folders")
    for run, step in (("a", 0), ("b", 1)):
        for source, base in (("vinabook", 0), ("bookbuy", 10**9)):
            rows = t.part.select(
                F.col("p_partkey").cast("string").alias("product_id"),
                F.concat(F.lit("part "), "p_partkey").alias("product_name"),
                (F.col("p_partkey") + base + step).alias("price"),
            )
            rows.repartition(4).write.json(f"{root}/raw/{source}/{run}.jsonl")
    out = processing.run_latest(t.spark, f"{root}/raw", f"{root}/out", fx.RUN_TS)
    rows = t.spark.read.parquet(out.products)
    return rows.select("source_name", "product_id", "price", F.substring_index("raw_file", "/", -1).alias("feed"))
