"""Column layouts shared by the sources, the operators and the published table."""

from __future__ import annotations

from pyspark.sql import types as T

# The five feeds, and which of them the gate insists on.
SOURCES = ["tiki", "phuongnam", "fahasa", "vinabook", "bookbuy"]
REQUIRED_SOURCES = ["bookbuy", "phuongnam", "tiki", "vinabook"]
OPTIONAL_SOURCES = ["fahasa"]
DEFAULT_CATEGORY = "BOOK"
SAMPLE_ROWS = 5

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _struct(columns: str, **nested: T.DataType) -> T.StructType:
    """Struct of ``name type`` pairs, then the nested fields; needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    flat = [T.StructField(name, _TYPES[kind]) for name, kind in pairs]
    return T.StructType(flat + [T.StructField(name, kind) for name, kind in nested.items()])


PRODUCT = _struct(
    """
    source_name string, standard_category string, source_category_id string,
    source_category_name string, source_parent_category_name string,
    source_category_url string, product_id string, product_name string,
    price bigint, original_price bigint, final_price bigint, discount int,
    rating_average double, review_count bigint, sold_qty bigint,
    stock_available int, product_url string, image_url string, crawl_page int,
    crawl_time string, product_key string, name_key string,
    processed_time string, raw_file string
    """
)

# One flat record per product, as the capture side writes it. Scalars are read as
# text: shops print numbers as numbers, decimals, flags or words, and a typed
# reader would make NULL of what does not fit.
FLAT_FEED = _struct(
    """
    source_name string, standard_category string, source_category_id string,
    source_category_name string, source_parent_category_name string,
    source_category_url string, product_id string, product_name string,
    price string, original_price string, discount string,
    rating_average string, review_count string, sold_qty string,
    stock_available string, product_url string, image_url string,
    crawl_page string, crawl_time string
    """
)

CATALOG_PRODUCT = _struct(
    """
    product_id string, product_name string, product_price string,
    product_finalprice string, discount string, sold_qty string,
    stock_available string, product_url string, image_src string,
    detail_status string, detail_error string, detail_crawl_time string
    """
)

CATALOG_BODY = T.StructType([T.StructField("product_list", T.ArrayType(CATALOG_PRODUCT))])

# One record per captured catalog response, products nested in the body.
CATALOG_FEED = _struct(
    """
    source_name string, run_id string, step string,
    source_category_name string, source_category_url string,
    response_url string, status int, crawl_time string,
    is_success boolean, error_message string
    """,
    headers=T.MapType(T.StringType(), T.StringType()),
    body=CATALOG_BODY,
)

# One listing page as the shop's API returns it.
LISTING_ITEM = _struct(
    """
    id string, name string, price string, original_price string,
    discount string, rating_average string, review_count string,
    url_path string, thumbnail_url string
    """,
    quantity_sold=_struct("value string"),
)
LISTING_PAGE = T.StructType([T.StructField("data", T.ArrayType(T.StringType()))])

REJECT_COLUMNS = ["source_name", "product_id", "product_name", "price", "validation_errors"]
DUPLICATE_COLUMNS = ["source_name", "product_id", "product_name", "price", "processed_time"]
