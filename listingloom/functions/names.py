"""Normalized product names and what entity resolution derives from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bracketed remarks, then edition and gift remarks, blanked out
# in this order.
BRACKETED = [r"\(.*?\)", r"\[.*?\]"]
REMARKS = [
    "tái bản",
    "bìa mềm",
    "bìa cứng",
    "phiên bản đặc biệt",
    "ấn bản đặc biệt",
    "tặng kèm",
    "kèm bookmark",
    "kèm quà tặng",
    "khổ lớn",
]
# All but 0-9A-Za-zÀ-ỹ. Low characters are named one by one: Java then looks them up in
# a table, which a negated class of ranges makes several times slower.
_LOW = "".join(rf"\x{c:02x}" for c in range(ord("À")) if not (c < 128 and chr(c).isalnum()))
NOT_A_NAME_CHARACTER = rf"[{_LOW}\x{{1efa}}-\x{{10ffff}}]+"

BLOCK_LENGTH = 6


def product_key(name: Column) -> Column:
    """Lower-case words of a product name without remarks; NULL if none is left."""
    blank = F.lit(" ")
    bare = F.lower(name.cast("string"))
    for pattern in BRACKETED:
        bare = F.regexp_replace(bare, pattern, " ")
    for remark in REMARKS:
        bare = F.replace(bare, F.lit(remark), blank)
    return F.nullif(F.trim(F.regexp_replace(bare, NOT_A_NAME_CHARACTER, " ")), F.lit(""))


def block_key(key: Column, length: int = BLOCK_LENGTH) -> Column:
    """Leading characters of a normalized name; only equal blocks are compared."""
    return F.substring(key, 1, length)


def word_list(key: Column) -> Column:
    return F.split(key, " ")


def word_set_text(key: Column) -> Column:
    """The distinct words of a key in sorted order, as one text."""
    return F.array_join(F.sort_array(F.array_distinct(word_list(key))), " ")


def jaccard(left: Column, right: Column) -> Column:
    """Shared over all words of two word lists, 0 where both are empty."""
    shared = F.size(F.array_intersect(left, right))
    total = F.size(F.array_union(left, right))
    return F.coalesce(F.try_divide(shared.cast("double"), total), F.lit(0.0))
