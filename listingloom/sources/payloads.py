"""API payloads kept as JSON text: listing pages, catalog responses, category trees."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingloom import schemas
from listingloom.functions.categories import classify_category
from listingloom.functions.numbers import double_by_form, long_by_form
from listingloom.functions.web import non_empty
from listingloom.storage import stage


def listing_products(
    pages: DataFrame,
    body: str,
    site: str,
    source_name: str,
    crawl_time: Column,
    crawl_page: Column | None = None,
    category_id: Column | None = None,
    category_name: Column | None = None,
    parent_name: Column | None = None,
) -> DataFrame:
    """One flat product row per item in the ``data`` array of a listing page.

    Items are split off as text first, so the untouched item is kept as
    ``raw`` while the typed fields are parsed from it.
    """
    nothing = F.lit(None).cast("string")
    category_name = nothing if category_name is None else category_name
    parent_name = nothing if parent_name is None else parent_name
    items = pages.select(
        F.lit(source_name).alias("source_name"),
        classify_category(parent_name, category_name).alias("standard_category"),
        (nothing if category_id is None else category_id).cast("string").alias("source_category_id"),
        category_name.alias("source_category_name"),
        parent_name.alias("source_parent_category_name"),
        (F.lit(None) if crawl_page is None else crawl_page).cast("int").alias("crawl_page"),
        crawl_time.cast("string").alias("crawl_time"),
        F.explode(F.from_json(body, schemas.LISTING_PAGE)["data"]).alias("raw"),
    ).withColumn("item", F.from_json("raw", schemas.LISTING_ITEM))
    path = non_empty(F.col("item.url_path"))
    return items.select(
        "source_name",
        "standard_category",
        "source_category_id",
        "source_category_name",
        "source_parent_category_name",
        F.col("item.id").alias("product_id"),
        F.col("item.name").alias("product_name"),
        long_by_form(F.col("item.price")).alias("price"),
        long_by_form(F.col("item.original_price")).alias("original_price"),
        long_by_form(F.col("item.discount")).alias("discount"),
        double_by_form(F.col("item.rating_average")).alias("rating_average"),
        long_by_form(F.col("item.review_count")).alias("review_count"),
        long_by_form(F.col("item.quantity_sold.value")).alias("sold_qty"),
        F.concat(F.lit(site.rstrip("/") + "/"), path).alias("product_url"),
        F.col("item.thumbnail_url").alias("image_url"),
        "crawl_page",
        "crawl_time",
        "raw",
    )


def catalog_envelope(responses: DataFrame, body: str, source_name: str, run_id: str) -> DataFrame:
    """Captured catalog responses in the catalog feed layout, body parsed."""
    return responses.select(
        F.lit(source_name).alias("source_name"),
        F.lit(run_id).alias("run_id"),
        F.lit("catalog").alias("step"),
        "source_category_name",
        "source_category_url",
        "response_url",
        "status",
        "headers",
        "crawl_time",
        F.lit(True).alias("is_success"),
        F.lit(None).cast("string").alias("error_message"),
        F.from_json(body, schemas.CATALOG_BODY).alias("body"),
    )


# Fixed values. From so many categories on, one in LANDMARK_SHARE is a landmark. Of a path of 8 times that
# many, 2^LANDMARK_ROUNDS, all but three in ten thousand hold one; the others are followed on like landmarks.
LANDMARKS_FROM = 250_000
LANDMARK_SHARE = 16
LANDMARK_ROUNDS = 7


def category_depths(nodes: DataFrame) -> DataFrame:
    """``category_id`` and ``depth`` (steps to the nearest root) of every category below a root.

    Pointers double: after round k each open category points at its ancestors
    2^k steps up, or has come to its root. So a chain of n categories takes log n
    rounds. What is open after pointers longer than there are categories hangs on a
    cycle, or on a parent that is no category, and has no depth.

    Where the categories are many, a fixed number of rounds takes all of them to the
    nearest landmarks above, and only the landmarks go on to the roots. So what is
    joined as a whole is joined a fixed number of times, however deep the tree.
    """
    ids = nodes.where("category_id is not null and (parent_id is null or parent_id <> category_id)")
    # Of one type with the ids, so that both ends of a pointer hash alike.
    above = F.col("parent_id").cast(nodes.schema["category_id"].dataType).alias("above")
    own = F.when(F.col("parent_id").isNull(), 0).otherwise(1).cast("long").alias("step")
    pointers = stage(ids.select("category_id", above, own).distinct(), "tree-jumps")
    count = pointers.agg(F.count_distinct("category_id").alias("ids"), F.count(F.lit(1)).alias("rows")).first()
    several = count["rows"] > count["ids"]
    if count["ids"] < LANDMARKS_FROM:
        return _depths(_doubled(pointers, _is_open(), count["ids"].bit_length(), several, "tree-reached"))
    going_on = _is_open() & ~_is_landmark("above")
    near = _doubled(pointers, going_on, LANDMARK_ROUNDS, several, "tree-jumps")
    left = near.where(going_on)
    # Neither end of a pointer that has met no landmark can be left out.
    ends = left.select("category_id").union(left.select("above")).distinct()
    others = near.where(~_is_landmark("category_id")).join(ends, "category_id", "left_semi")
    kept = stage(near.where(_is_landmark("category_id")).unionByName(others), "tree-landmarks")
    roots = _doubled(kept, _is_open(), kept.count().bit_length(), several, "tree-reached")
    depths = stage(_depths(roots), "tree-landmarks")
    rest = near.where(_is_open()).join(depths.withColumnRenamed("category_id", "above"), "above")
    through = rest.select("category_id", (F.col("step") + F.col("depth")).alias("depth"))
    found = near.where(~_is_open()).select("category_id", F.col("step").alias("depth"))
    return found.unionByName(through).groupBy("category_id").agg(F.min("depth").alias("depth"))


def _is_open() -> Column:
    return F.col("above").isNotNull()


def _is_landmark(category: str) -> Column:
    return F.pmod(F.xxhash64(category), F.lit(LANDMARK_SHARE)) == 0


def _depths(pointers: DataFrame) -> DataFrame:
    """Depths of the categories that have come to a root."""
    return pointers.where(~_is_open()).groupBy("category_id").agg(F.min("step").alias("depth"))


def _doubled(pointers: DataFrame, going_on: Column, rounds: int, several: bool, label: str) -> DataFrame:
    """Pointers that go on take over those of the category they point at, ``rounds`` times.

    Each round is stored, as the next one reads it more than once. Of ``several``
    parents those are dropped that lead no nearer to a root than one that is found.
    """
    for _ in range(rounds):
        ahead = pointers.where(going_on)
        if ahead.isEmpty():
            break
        further = pointers.select(
            F.col("category_id").alias("above"), F.col("above").alias("further"), F.col("step").alias("more")
        )
        moved = ahead.join(further, "above").select(
            "category_id", F.col("further").alias("above"), (F.col("step") + F.col("more")).alias("step")
        )
        moved = pointers.where(~going_on).unionByName(moved)
        if several:
            at_root = F.when(~_is_open(), F.col("step"))
            moved = (
                moved.withColumn("found", F.min(at_root).over(Window.partitionBy("category_id")))
                .where(~_is_open() | F.col("found").isNull() | (F.col("step") < F.col("found")))
                .groupBy("category_id", "above")
                .agg(F.min("step").alias("step"))
            )
        pointers = stage(moved, label)
    return pointers


def flatten_category_tree(nodes: DataFrame) -> DataFrame:
    """Every category reachable from a root, with its parent's name and depth.

    ``nodes`` holds ``category_id, category_name, url_key, parent_id``; roots
    have no parent. Nodes without id or address key are walked through but not
    returned. A category that is given several parents belongs to those nearest
    to a root; cycles end and no depth is too deep.
    """
    depths = stage(category_depths(nodes), "tree-known")
    above = depths.select(F.col("category_id").alias("parent_id"), F.col("depth").alias("parent_depth"))
    own = F.coalesce(F.col("parent_depth") + 1, F.lit(0).cast("long"))
    placed = (
        nodes.join(depths, "category_id", "inner")
        .join(above, "parent_id", "left")
        .where((F.col("depth") == own) & (F.col("parent_id").isNull() | F.col("parent_depth").isNotNull()))
    )
    names = placed.select(F.col("category_id").alias("parent_id"), F.col("category_name").alias("parent_name")).distinct()
    return (
        placed.where("url_key is not null and url_key <> ''")
        .join(names, "parent_id", "left")
        .select("category_id", "category_name", "url_key", "parent_name", F.col("depth").cast("int").alias("depth"))
    )


def nested_categories(payloads: DataFrame, body: str) -> DataFrame:
    """Parent-linked rows of category payloads whose ``children`` hold more of them.

    A payload is one category or an array of them, each with ``id, name,
    url_key`` and ``children``. Every level is split off as text and stored,
    so categories may nest as deep as they like. The result is what
    :func:`flatten_category_tree` takes.
    """
    text = F.trim(F.col(body))
    level = payloads.select(
        F.explode(
            F.when(text.startswith("["), F.from_json(text, "array<string>")).otherwise(F.array(text))
        ).alias("node"),
        F.lit(None).cast("string").alias("parent_id"),
    )
    found = None
    while True:
        rows = stage(
            level.where(F.col("node").isNotNull()).select(
                F.get_json_object("node", "$.id").alias("category_id"),
                F.get_json_object("node", "$.name").alias("category_name"),
                F.get_json_object("node", "$.url_key").alias("url_key"),
                "parent_id",
                F.get_json_object("node", "$.children").alias("children"),
            ),
            "tree-payload",
        )
        found = rows if found is None else found.unionByName(rows)
        level = rows.select(
            F.explode(F.from_json("children", "array<string>")).alias("node"),
            F.col("category_id").alias("parent_id"),
        )
        if rows.isEmpty():
            return found.drop("children")
