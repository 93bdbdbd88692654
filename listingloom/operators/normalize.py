"""Every source's rows in the one canonical product layout."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom import schemas
from listingloom.functions.names import product_key
from listingloom.functions.numbers import double_by_form, long_by_form, parse_double, parse_long
from listingloom.operators.project import field_type
from listingloom.sources.feeds import CORRUPT

log = logging.getLogger(__name__)

ADDED = ["source_name", "product_key", "name_key", "processed_time", "raw_file"]
MAPPED = [f for f in schemas.PRODUCT.fields if f.name not in ADDED]


@dataclass(frozen=True)
class Mapping:
    """How a source's fields fill the canonical columns.

    A canonical column comes from the field of its own name unless ``paths``
    names another one, or None where the source has no such field. ``nested``
    is the array of products inside each record, if records are not products;
    its element is reachable as ``item``.
    """

    paths: dict[str, str | None] = field(default_factory=dict)
    nested: str | None = None


LISTING = Mapping(
    {"final_price": "price", "source_category_url": None, "stock_available": None}
)
SIMPLE = Mapping(
    {"final_price": "price", "source_category_id": None, "source_parent_category_name": None}
)
CATALOG = Mapping(
    {
        "standard_category": None,
        "source_category_id": None,
        "source_parent_category_name": None,
        "product_id": "item.product_id",
        "product_name": "item.product_name",
        "price": "item.product_price",
        "original_price": "item.product_price",
        "final_price": "item.product_finalprice",
        "discount": "item.discount",
        "rating_average": None,
        "review_count": None,
        "sold_qty": "item.sold_qty",
        "stock_available": "item.stock_available",
        "product_url": "item.product_url",
        "image_url": "item.image_src",
        "crawl_page": None,
    },
    nested="body.product_list",
)
MAPPINGS = {
    "tiki": LISTING,
    "phuongnam": SIMPLE,
    "vinabook": SIMPLE,
    "bookbuy": SIMPLE,
    "fahasa": CATALOG,
}
FEED_SCHEMAS = {
    name: schemas.CATALOG_FEED if mapping.nested else schemas.FLAT_FEED
    for name, mapping in MAPPINGS.items()
}


def _typed(path: str | None, found: T.DataType | None, target: T.DataType) -> Column:
    if path is None or found is None or isinstance(found, T.NullType):
        return F.lit(None).cast(target)
    value = F.col(path)
    is_text = isinstance(found, T.StringType)
    if isinstance(target, (T.LongType, T.IntegerType)):
        whole = long_by_form(value) if is_text else parse_long(value, found, signed=True)
        return whole.try_cast(target)
    if isinstance(target, T.DoubleType):
        return double_by_form(value) if is_text else parse_double(value, found)
    return value.cast("string")


def normalize(df: DataFrame, source_name: str, mapping: Mapping, run_ts: str) -> DataFrame:
    """Canonical rows of one source, stamped with the run's time."""
    if mapping.nested:
        if not isinstance(field_type(df.schema, mapping.nested), T.ArrayType):
            log.warning("%s: no array %s in the feed, no rows", source_name, mapping.nested)
            columns = [f for f in schemas.PRODUCT.fields if f.name != "raw_file"]
            return df.sparkSession.createDataFrame([], T.StructType(columns))
        df = df.withColumn("item", F.explode_outer(mapping.nested))
    columns = {}
    for target in MAPPED:
        path = mapping.paths.get(target.name, target.name)
        found = field_type(df.schema, path) if path else None
        columns[target.name] = _typed(path, found, target.dataType)
    columns["standard_category"] = F.coalesce(
        columns["standard_category"], F.lit(schemas.DEFAULT_CATEGORY)
    )
    out = df.select(
        F.lit(source_name).alias("source_name"),
        *[column.alias(name) for name, column in columns.items()],
        # Lines that are no record stay in sight until validation.
        *[CORRUPT for _ in df.columns if _ == CORRUPT],
    )
    return (
        out.withColumn("product_key", product_key(F.col("product_name")))
        .withColumn("name_key", F.col("product_key"))
        .withColumn("processed_time", F.lit(run_ts))
    )


def normalize_source(df: DataFrame, source_name: str, run_ts: str) -> DataFrame:
    """Canonical rows of a known source's feed."""
    if source_name not in MAPPINGS:
        raise ValueError(f"unknown source: {source_name}")
    return normalize(df, source_name, MAPPINGS[source_name], run_ts)


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All frames by column name; columns a frame lacks are NULL in its rows."""
    if not frames:
        raise ValueError("no source has any raw data")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
