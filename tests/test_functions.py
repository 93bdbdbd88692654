import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listingloom.functions import categories, names, numbers, web


def one(spark, column_of, value, dtype="string"):
    frame = spark.createDataFrame([(value,)], f"x {dtype}")
    return frame.select(column_of(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("89.000đ", 89000),
        ("1 200 ₫", 1200),
        ("4.5", 45),
        ("4,5", 45),
        (".5", 5),
        ("-5", None),
        ("12 VND", None),
        ("true", None),
        ("1.0E7", None),
        ("", None),
        (None, None),
        ("12345678901234567890", None),
    ],
)
def test_parse_long_text(spark, text, expected):
    assert one(spark, numbers.parse_long, text) == expected


def test_parse_long_keeps_sign_when_asked(spark):
    assert one(spark, lambda c: numbers.parse_long(c, signed=True), "-5.000đ") == -5000


def test_parse_long_of_numbers_and_flags(spark):
    as_double = lambda c: numbers.parse_long(c, T.DoubleType())
    assert one(spark, as_double, 89000.0, "double") == 89000
    assert one(spark, as_double, 1.25e7, "double") == 12500000
    assert one(spark, as_double, 1e30, "double") is None
    as_flag = lambda c: numbers.parse_long(c, T.BooleanType())
    assert [one(spark, as_flag, v, "boolean") for v in (True, False, None)] == [1, 0, None]


@pytest.mark.parametrize(
    "text, expected",
    [("4.5", 4.5), ("-4.", -4.0), (".5", None), ("1e3", None), ("4,5", None), (None, None)],
)
def test_parse_double(spark, text, expected):
    assert one(spark, numbers.parse_double, text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [("89.000đ - 99.000đ", 8900099000), ("-5", 5), ("12 VND", 12), ("1e3", 13), ("free", None), (None, None)],
)
def test_digits_price(spark, text, expected):
    assert one(spark, numbers.digits_price, text) == expected


@pytest.mark.parametrize("text, expected", [("-25%", 25), ("a1b2", 1), ("sale", None), (None, None)])
def test_first_number(spark, text, expected):
    assert one(spark, numbers.first_number, text) == expected


@pytest.mark.parametrize(
    "name, expected",
    [
        ("Đắc Nhân Tâm (Tái Bản 2023) - Bìa Mềm", "đắc nhân tâm"),
        ("Mắt Biếc tặng kèm bookmark", "mắt biếc bookmark"),
        ("A (b (c) d) e", "a d e"),
        ("A [x] b\tc\n d", "a b c d"),
        ("漢字 only", "only"),
        ("tái (x) bản", "tái bản"),
        ("  ", None),
        ("漢字", None),
        (None, None),
    ],
)
def test_product_key(spark, name, expected):
    assert one(spark, names.product_key, name) == expected


def test_product_key_is_not_idempotent(spark):
    assert one(spark, names.product_key, "tái bản") is None


def test_block_key_counts_characters_not_bytes(spark):
    assert one(spark, names.block_key, "đắc nhân tâm") == "đắc nh"


def test_jaccard(spark):
    def score(a, b):
        frame = spark.createDataFrame([(a, b)], "a array<string>, b array<string>")
        return frame.select(names.jaccard(F.col("a"), F.col("b"))).first()[0]

    assert score(["x", "y"], ["y", "z"]) == pytest.approx(1 / 3)
    assert score(["y", "z"], ["x", "y"]) == pytest.approx(1 / 3)
    assert score(["x", "x"], ["x"]) == 1.0
    assert score([], []) == 0.0


@pytest.mark.parametrize(
    "parent, name, expected",
    [
        ("Nhà Sách", None, "BOOK"),
        (None, "Laptop & Sách", "BOOK"),
        (None, "Laptop", "ELECTRONICS"),
        ("Mẹ", "x", "MOM_BABY"),
        (None, "Ô Tô", "AUTO"),
        (None, None, "OTHER"),
    ],
)
def test_classify_category(spark, parent, name, expected):
    frame = spark.createDataFrame([(parent, name)], "p string, n string")
    assert frame.select(categories.classify_category(F.col("p"), F.col("n"))).first()[0] == expected


@pytest.mark.parametrize(
    "href, expected",
    [
        ("/a/b", "https://s.example/a/b"),
        ("a/b", "https://s.example/a/b"),
        ("./a", "https://s.example/a"),
        ("../a", "https://s.example/a"),
        ("//cdn.example/a", "https://cdn.example/a"),
        ("http://o.example/a", "http://o.example/a"),
        ("?p=2", "https://s.example?p=2"),
        (" /a", "https://s.example/a"),
        ("", None),
        (None, None),
    ],
)
def test_absolute_url(spark, href, expected):
    assert one(spark, lambda c: web.absolute_url(c, "https://s.example/"), href) == expected


def test_card_markup(spark):
    assert one(spark, web.url_tail, "https://s.example/products/abc//") == "abc"
    assert one(spark, web.cart_product_id, "add_to_cart('12')") == "12"
    assert one(spark, web.cart_product_id, "add_to_cart(12)") == "12"
    assert one(spark, web.cart_product_id, "buy(12)") is None
    assert one(spark, web.css_image, 'background: url("/i.jpg") left') == "/i.jpg"
    assert one(spark, web.sold_out_flag, "Hết Hàng rồi") is False
    assert one(spark, web.sold_out_flag, "còn hàng") is None


def test_two_decimal_rounding_goes_away_from_zero(spark):
    frame = spark.createDataFrame([("2.675", 1), ("-0.25", 2), ("1", 0)], "t string, n int").select(
        numbers.mean_2dp(F.col("t").cast("decimal(18,3)"), F.col("n")).cast("string")
    )
    assert [r[0] for r in frame.collect()] == ["2.68", "-0.13", None]
    frame = spark.createDataFrame([(1, 3), (2, 3), (1, 0)], "p bigint, w bigint").select(
        numbers.percent_2dp(F.col("p"), F.col("w")).cast("string")
    )
    assert [r[0] for r in frame.collect()] == ["33.33", "66.67", None]


def test_numbers_by_form(spark):
    texts = ["89000", "89000.0", "89.000", "89.000đ", "1.250.000", "1.5e3", "-5", "true", "FALSE", "4.5", "", None, "x",
             " 12 VND", "99999999999999999999", "9007199254740993"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(numbers.long_by_form(F.col("t")), numbers.double_by_form(F.col("t"))).collect()]
    assert [g[0] for g in got] == [
        89000, 89000, 89000, 89000, 1250000, 1500, -5, 1, 0, 4, None, None, None, None, None, 9007199254740993,
    ]
    assert got[5][1] == 1500.0 and got[9][1] == 4.5 and got[7][1] is None
