"""Standard category from the shop's own category names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The first rule with a keyword in the category names wins.
CATEGORY_RULES = [
    ("BOOK", ["sách", "văn học", "kinh tế", "ngoại ngữ", "giáo khoa"]),
    ("ELECTRONICS", ["điện thoại", "máy tính bảng", "laptop", "thiết bị số", "linh kiện"]),
    ("HOME_LIVING", ["điện gia dụng", "nhà cửa", "đời sống", "nội thất"]),
    ("BEAUTY_HEALTH", ["làm đẹp", "sức khỏe", "mỹ phẩm", "chăm sóc"]),
    ("MOM_BABY", ["mẹ", "bé", "đồ chơi"]),
    ("FASHION", ["thời trang", "giày", "dép", "túi", "đồng hồ", "trang sức"]),
    ("GROCERY", ["bách hóa", "thực phẩm", "đồ uống"]),
    ("SPORT", ["thể thao", "dã ngoại"]),
    ("AUTO", ["ô tô", "xe máy", "xe đạp"]),
]
OTHER_CATEGORY = "OTHER"


def classify_category(
    parent_name: Column,
    category_name: Column,
    rules: list[tuple[str, list[str]]] | None = None,
    other: str = OTHER_CATEGORY,
) -> Column:
    """Label of the first rule whose keyword occurs in "parent name category name"."""
    blank = F.lit("")
    text = F.lower(
        F.concat_ws(" ", F.coalesce(parent_name, blank), F.coalesce(category_name, blank))
    )
    # Built from the last rule outwards, so the first rule is tested first.
    return reduce(
        lambda rest, rule: F.when(
            reduce(lambda a, b: a | b, [text.contains(word) for word in rule[1]]),
            F.lit(rule[0]),
        ).otherwise(rest),
        reversed(CATEGORY_RULES if rules is None else rules),
        F.lit(other),
    )
