"""Links, identifiers and flags found in scraped shop markup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markup the shops use.
CART_CALL = r"add_to_cart\(['\"]?([0-9]+)['\"]?\)"
CSS_URL = r"url\(['\"]?(.*?)['\"]?\)"
SOLD_OUT = "hết hàng"


def non_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_filled(*candidates: Column) -> Column:
    """The first candidate that is neither NULL nor empty."""
    return F.coalesce(*[non_empty(c) for c in candidates])


def absolute_url(href: Column, base: str) -> Column:
    """``href`` joined to the shop's root address; NULL and empty links stay NULL.

    A chain of anchored replacements, each reading the last one once: a CASE
    over the same link would repeat its clean-up in every branch.
    """
    root = base.rstrip("/").replace("\\", "\\\\").replace("$", "\\$")
    steps = [
        (r"^[\x00-\x20]+|[\t\r\n]", ""),
        (r"^//", "https://"),
        (r"^(\.{1,2}/)+", "/"),
        (r"^(?=[/?#])", root),
        (r"^(?![A-Za-z][A-Za-z0-9+.\-]*:)(?=.)", root + "/"),
    ]
    link = href
    for pattern, replacement in steps:
        link = F.regexp_replace(link, pattern, replacement)
    return non_empty(link)


def visible_link(href: Column) -> Column:
    """``href`` where :func:`absolute_url` makes a link of it, else NULL."""
    return F.when(href.rlike(r"[^\x00-\x20]"), href)


def url_tail(url: Column) -> Column:
    """Last path segment, ignoring slashes at the end."""
    return non_empty(F.element_at(F.split(F.regexp_replace(url, r"/+$", ""), "/"), -1))


def cart_product_id(onclick: Column) -> Column:
    """Product id in an add-to-cart handler."""
    return non_empty(F.regexp_extract(onclick, CART_CALL, 1))


def css_image(style: Column) -> Column:
    """Image address in an inline ``background: url(..)``."""
    return non_empty(F.regexp_extract(style, CSS_URL, 1))


def sold_out_flag(text: Column) -> Column:
    """False where the card says the product is sold out, else NULL (not known)."""
    return F.when(F.lower(text).contains(SOLD_OUT), F.lit(False))
