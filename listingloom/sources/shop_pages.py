"""The shops' listing pages as flat product rows."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listingloom.functions.numbers import digits_price, first_number
from listingloom.functions.web import (
    absolute_url,
    cart_product_id,
    css_image,
    first_filled,
    non_empty,
    sold_out_flag,
    url_tail,
    visible_link,
)
from listingloom.operators.dedup import first_wins
from listingloom.sources.html_cards import CardSpec, extract_cards

# Where each shop's markup keeps the parts of a product card.
PHUONGNAM_CARDS = (
    ".product-item, .product-loop, .pro-loop, .product-block, "
    ".grid__item, .product, .item_product_main, .product-resize"
)
PHUONGNAM_NAME = (
    ".product-name a, .pro-name a, .product-title a, h3 a, h2 a, a[title]"
)
PHUONGNAM_PRICE = (
    ".price, .product-price, .pro-price, .special-price, .current-price, .price-new"
)
PHUONGNAM_OLD_PRICE = ".compare-price, .old-price, .price-compare, .price-old"
VINABOOK_NAME = ".product-detail .pro-name a, .pro-name a"
VINABOOK_IMAGE = ".product-img img, img"
VINABOOK_LINK = ".product-img a[href*='/products/'], a[href*='/products/']"
BOOKBUY_IMAGE = ".img-view img, img"
BOOKBUY_NAME = ".t-view a, a[title]"


@dataclass(frozen=True)
class Shop:
    source_name: str
    base_url: str
    spec: CardSpec
    dedup_by_url_only: bool = False


def _image_fields(selector: str, *attributes: str) -> dict[str, tuple[str, str]]:
    return {f"image_{a.replace('-', '_')}": (selector, a) for a in attributes}


PHUONGNAM = Shop(
    "phuongnam",
    "https://nhasachphuongnam.com",
    CardSpec(
        PHUONGNAM_CARDS,
        {
            "name_title": (PHUONGNAM_NAME, "title"),
            "name_text": (PHUONGNAM_NAME, "tight_text"),
            "link": ("a[href]", "href"),
            "price_text": (PHUONGNAM_PRICE, "text"),
            "old_price_text": (PHUONGNAM_OLD_PRICE, "text"),
            **_image_fields("img", "data-src", "data-original", "src"),
        },
    ),
    dedup_by_url_only=True,
)
VINABOOK = Shop(
    "vinabook",
    "https://www.vinabook.com",
    CardSpec(
        ".product-item",
        {
            "name_title": (VINABOOK_NAME, "title"),
            "name_text": (VINABOOK_NAME, "text"),
            "name_image_alt": (VINABOOK_IMAGE, "alt"),
            "link_name": (VINABOOK_NAME, "href"),
            "link": (VINABOOK_LINK, "href"),
            "price_text": (".product-detail .current-price, .current-price", "text"),
            "old_price_text": (".product-detail .compare-price, .compare-price", "text"),
            "discount_text": (".product-sale span, .product-sale", "text"),
            "cart_call": ("[onclick*='add_to_cart']", "onclick"),
            "card_text": ("", "text"),
            **_image_fields(VINABOOK_IMAGE, "data-src", "data-original", "data-lazy", "src"),
        },
        link_fallback="a[href*='/products/']",
    ),
)
BOOKBUY = Shop(
    "bookbuy",
    "https://bookbuy.vn",
    CardSpec(
        ".product-item",
        {
            "name_view": (".img-view", "title"),
            "name_title": (BOOKBUY_NAME, "title"),
            "name_text": (BOOKBUY_NAME, "text"),
            "product_id_text": (".img-view", "productid"),
            "link": (".img-view a[href], .t-view a[href]", "href"),
            "price_text": (".p-view .price", "text"),
            "old_price_text": (".p-view .real-price", "text"),
            "discount_text": (".p-view .sale-off", "text"),
            "view_style": (".img-view", "style"),
            **_image_fields(BOOKBUY_IMAGE, "data-src", "data-original", "data-lazy", "src"),
        },
        link_fallback="a[href]",
    ),
)
SHOPS = {shop.source_name: shop for shop in (PHUONGNAM, VINABOOK, BOOKBUY)}


def _first_of(cards: DataFrame, *prefixes: str) -> Column:
    names = [c for p in prefixes for c in cards.columns if c.startswith(p)]
    return first_filled(*[F.col(n) for n in names]) if names else F.lit(None).cast("string")


def _optional(cards: DataFrame, name: str, value) -> Column:
    return value(F.col(name)) if name in cards.columns else value(F.lit(None).cast("string"))


def clean_cards(cards: DataFrame, base_url: str) -> DataFrame:
    """Raw card fields, whichever are there, as typed product columns.

    Fields of one prefix are alternatives in column order: ``name*``, ``link*``
    and ``image*`` each give the first one filled. The link is chosen before it is
    cleaned, and read by a step of its own, so that each row's is cleaned once.
    """
    link_names = [c for c in cards.columns if c.startswith("link")]
    url = absolute_url(F.coalesce(*[visible_link(F.col(c)) for c in link_names]), base_url)
    image = first_filled(_first_of(cards, "image_"), _optional(cards, "view_style", css_image))
    name = F.regexp_replace(_first_of(cards, "name_"), r"^\s+|\s+$", "")
    own_id = first_filled(
        _optional(cards, "cart_call", cart_product_id),
        _optional(cards, "product_id_text", non_empty),
    )
    has_cart = "cart_call" in cards.columns
    linked = cards.withColumns({"product_name": name, "product_url": url})
    return linked.withColumns(
        {
            "image_url": absolute_url(image, base_url),
            "product_id": F.coalesce(own_id, url_tail(F.col("product_url"))) if has_cart else own_id,
            "price": _optional(cards, "price_text", digits_price),
            "original_price": _optional(cards, "old_price_text", digits_price),
            "discount": _optional(cards, "discount_text", first_number),
            "stock_available": _optional(cards, "card_text", sold_out_flag),
        }
    )


def shop_products(pages: DataFrame, shop: Shop, html: str = "html") -> DataFrame:
    """Flat product rows of a shop's stored listing pages.

    ``pages`` holds ``page_id``, the markup and the page's ``standard_category,
    source_category_name, source_category_url, crawl_page, crawl_time``. Cards
    without a name are skipped, and of equal cards on a page the first stays.
    """
    about = ["standard_category", "source_category_name", "source_category_url"]
    crawl = ["crawl_page", "crawl_time"]
    cards = extract_cards(pages, shop.spec, ["page_id", *about, *crawl], html)
    named = cards.filter(_first_of(cards, "name_").isNotNull())
    key = F.col("product_url")
    if not shop.dedup_by_url_only:
        # Cards that would have no key go before anything of them is cleaned.
        links = [visible_link(F.col(c)).isNotNull() for c in cards.columns if c.startswith("link")]
        has_name = _first_of(cards, "name_").rlike(r"\S")
        named = named.filter(F.col("page_id").isNotNull() & reduce(or_, [*links, has_name]))
        key = first_filled(key, F.col("product_name"))
    kept = first_wins(
        clean_cards(named, shop.base_url).withColumn("_card_key", key),
        ["page_id", "_card_key"],
        [F.col("pos")],
        drop_null_keys=False,
    )
    nothing = F.lit(None)
    return kept.select(
        F.lit(shop.source_name).alias("source_name"),
        *about,
        "product_id",
        "product_name",
        "price",
        "original_price",
        "discount",
        nothing.cast("double").alias("rating_average"),
        nothing.cast("bigint").alias("review_count"),
        nothing.cast("bigint").alias("sold_qty"),
        "stock_available",
        "product_url",
        "image_url",
        *crawl,
    )
