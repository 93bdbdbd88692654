import json
import random

import pytest
from pyspark.sql import functions as F

from listingloom import schemas
from listingloom.operators import normalize
from listingloom.sources import feeds, html_cards, payloads, shop_pages

RUN_TS = "2024-06-01 00:00:00"


def write(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines), encoding="utf-8")
    return str(path)


def test_jsonl_keeps_broken_lines(spark, tmp_path):
    path = write(tmp_path / "a.jsonl", '{"product_id": "1", "price": 5}', "{broken", '{"product_id": "2"}')
    got = feeds.read_feed(spark, path, schemas.FLAT_FEED).select("product_id", "price", feeds.CORRUPT).collect()
    assert [tuple(r) for r in got] == [("1", "5", None), (None, None, "{broken"), ("2", None, None)]
    assert feeds.CORRUPT not in schemas.FLAT_FEED.names


def test_array_file_and_inferred_schema(spark, tmp_path):
    path = write(tmp_path / "a.json", json.dumps([{"a": 1}, {"a": 2, "b": {"c": "x"}}], indent=2))
    got = feeds.read_feed(spark, path).select("a", "b.c").collect()
    assert sorted(tuple(r) for r in got) == [(1, None), (2, "x")]


def test_newest_feed_skips_side_files_and_absent_sources(spark, tmp_path):
    import os

    for age, name in enumerate(["tiki/new.jsonl", "tiki/old.jsonl", "fahasa/x.jsonl"]):
        os.utime(write(tmp_path / "raw" / name, "{}"), (2000 - age, 2000 - age))
    for name in ["tiki/tiki_SUMMARY_1.json", "tiki/run_stats.json", "bookbuy/bookbuy_summary.json"]:
        os.utime(write(tmp_path / "raw" / name, "{}"), (9000, 9000))
    found = feeds.find_latest_feeds(spark, str(tmp_path / "raw"), schemas.SOURCES)
    assert {k: v.rsplit("/", 2)[1:] for k, v in found.items()} == {
        "tiki": ["tiki", "new.jsonl"],
        "fahasa": ["fahasa", "x.jsonl"],
    }


def test_equally_old_files_go_by_path(spark, tmp_path):
    import os

    for name in ["b.jsonl", "a.jsonl"]:
        os.utime(write(tmp_path / name, "{}"), (1000, 1000))
    newest = feeds.latest_feed_file(feeds.list_feed_files(spark, str(tmp_path)))
    assert newest.first()["path"].endswith("b.jsonl")


def test_empty_catalog_feed_gives_typed_empty_frame(spark, tmp_path):
    raw = feeds.read_feed(spark, write(tmp_path / "e.jsonl", ""))
    out = normalize.normalize_source(raw, "fahasa", RUN_TS)
    assert out.count() == 0
    assert [f.name for f in schemas.PRODUCT.fields if f.name != "raw_file"] == out.columns
    assert out.schema["price"].dataType == schemas.PRODUCT["price"].dataType


def test_empty_product_list_gives_one_bare_row(spark, tmp_path):
    path = write(tmp_path / "c.jsonl", '{"source_category_name": "c", "body": {"product_list": []}}')
    raw = feeds.read_feed(spark, path, schemas.CATALOG_FEED)
    got = normalize.normalize_source(raw, "fahasa", RUN_TS).first()
    assert (got["source_category_name"], got["product_id"], got["product_name"]) == ("c", None, None)


def test_catalog_prices(spark, tmp_path):
    product = {"product_id": "7", "product_name": "A", "product_price": "120.000", "product_finalprice": "99.000 đ"}
    path = write(tmp_path / "c.jsonl", json.dumps({"body": {"product_list": [product]}}))
    got = normalize.normalize_source(feeds.read_feed(spark, path, schemas.CATALOG_FEED), "fahasa", RUN_TS).first()
    assert (got["price"], got["original_price"], got["final_price"]) == (120000, 120000, 99000)
    assert got["standard_category"] == "BOOK" and got["processed_time"] == RUN_TS


def test_unknown_source(spark):
    with pytest.raises(ValueError):
        normalize.normalize_source(spark.range(1), "nowhere", RUN_TS)
    with pytest.raises(ValueError):
        normalize.union_sources([])


def test_listing_page(spark):
    body = {"data": [
        {"id": 1, "name": "A", "price": 10, "quantity_sold": {"value": 3}, "url_path": "a.html", "extra": [1]},
        {"id": 2, "name": "B", "quantity_sold": 5, "url_path": ""},
    ]}
    pages = spark.createDataFrame([(json.dumps(body),), ('{"data": []}',), (None,)], "body string")
    out = payloads.listing_products(pages, "body", "https://t.example/", "tiki", F.lit("now"), F.lit(3))
    got = {r["product_id"]: r for r in out.collect()}
    assert (got["1"]["sold_qty"], got["1"]["product_url"], got["1"]["crawl_page"]) == (3, "https://t.example/a.html", 3)
    assert (got["2"]["sold_qty"], got["2"]["product_url"]) == (None, None)
    assert json.loads(got["1"]["raw"])["extra"] == [1]


def test_category_tree(spark):
    nodes = spark.createDataFrame(
        [(1, "Books", "books", None), (2, "Novels", "novels", 1), (3, "No key", None, 1), (4, "Deep", "deep", 3),
         (9, "Orphan", "orphan", 8)],
        "category_id bigint, category_name string, url_key string, parent_id bigint",
    )
    got = {r["category_id"]: (r["parent_name"], r["depth"]) for r in payloads.flatten_category_tree(nodes).collect()}
    assert got == {1: (None, 0), 2: ("Books", 1), 4: ("No key", 2)}


ABOUT = ("BOOK", "c", "https://c.example", 1, "2024-05-31")
PAGE = (
    "page_id bigint, html string, standard_category string, source_category_name string, "
    "source_category_url string, crawl_page int, crawl_time string"
)


def shop_rows(spark, shop, *markup):
    pages = spark.createDataFrame([(i, m, *ABOUT) for i, m in enumerate(markup)], PAGE)
    return [r.asDict() for r in shop_pages.shop_products(pages, shop).orderBy("product_url").collect()]


def test_phuongnam_cards(spark):
    card = (
        '<div class="product-item"><h3><a title="{t}" href="{h}">T &amp;<b> x</b></a></h3>'
        '<span class="price">89.000<sup>đ</sup></span><del class="compare-price">100.000đ</del>'
        '<img src="/s.jpg" data-src="//cdn/i.jpg"></div>'
    )
    got = shop_rows(
        spark, shop_pages.PHUONGNAM,
        card.format(t="Book", h="/a") + card.format(t="Again", h="/a") + card.format(t="", h="/b")
        + '<div class="product"><a href="/none"></a></div>',
    )
    assert [(r["product_name"], r["product_url"]) for r in got] == [
        ("Book", "https://nhasachphuongnam.com/a"),
        ("T &x", "https://nhasachphuongnam.com/b"),
    ]
    assert (got[0]["price"], got[0]["original_price"], got[0]["image_url"]) == (89000, 100000, "https://cdn/i.jpg")
    assert got[0]["product_id"] is None and got[0]["crawl_page"] == 1


def test_vinabook_cards(spark):
    full = (
        '<li class="product-item x"><div class="product-detail"><p class="pro-name"><a href="/products/n-1/"> Name </a></p>'
        '<span class="current-price">1.000</span></div><div class="product-sale"><span>-15%</span></div>'
        "<a onclick=\"add_to_cart('55')\">buy</a> Hết hàng</li>"
    )
    image_only = '<li class="product-item"><div class="product-img"><a href="/products/p-2"><img alt="Alt" data-lazy="l.jpg"></a></div></li>'
    got = shop_rows(spark, shop_pages.VINABOOK, "<ul>" + full + image_only)
    assert [(r["product_id"], r["product_name"], r["discount"], r["stock_available"]) for r in got] == [
        ("55", "Name", 15, False),
        ("p-2", "Alt", None, None),
    ]
    assert got[1]["image_url"] == "https://www.vinabook.com/l.jpg"


@pytest.mark.parametrize("shop", [shop_pages.VINABOOK, shop_pages.BOOKBUY, shop_pages.PHUONGNAM])
def test_links_are_cleaned_once(spark, shop):
    """Not again in each filter and column that rests on them: once the card's link, once its image."""
    rows = shop_pages.shop_products(spark.createDataFrame([], PAGE), shop)
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert 1 <= plan.count("(?=[/?#])") <= 2


def test_blank_links_are_none(spark):
    """A link of blanks leaves the word to the next one; a card with neither link nor name is none."""
    card = '<li class="product-item"><p class="pro-name"><a href="{h}" title="{t}"></a></p><a href="{p}"></a></li>'
    got = shop_rows(
        spark, shop_pages.VINABOOK,
        card.format(h=" \t", t="A", p="/products/1") + card.format(h=" ", t=" ", p="") + card.format(h="", t=" B ", p=""),
    )
    assert [(r["product_name"], r["product_url"]) for r in got] == [("B", None), ("A", "https://www.vinabook.com/products/1")]


def test_vinabook_falls_back_to_links(spark):
    markup = '<div><div><div><a href="/products/q"><img alt="Q"></a></div></div></div>'
    got = shop_rows(spark, shop_pages.VINABOOK, markup)
    assert [(r["product_name"], r["product_id"]) for r in got] == [("Q", "q")]


def test_bookbuy_cards(spark):
    card = (
        '<div class="product-item"><div class="img-view" title="View" productid="9" style="background:url(/v.jpg)">'
        '<a href="/v"></a></div><div class="p-view"><b class="price">5.000</b><i class="real-price">6.000</i>'
        '<i class="sale-off">-17%</i></div></div>'
    )
    (got,) = shop_rows(spark, shop_pages.BOOKBUY, card)
    assert (got["product_id"], got["product_name"], got["price"], got["original_price"], got["discount"]) == (
        "9", "View", 5000, 6000, 17,
    )
    assert got["image_url"] == "https://bookbuy.vn/v.jpg"


def test_cards_of_pages_without_markup(spark):
    pages = spark.createDataFrame([(1, None), (2, ""), (3, "<p>")], "page_id bigint, html string")
    spec = html_cards.CardSpec("li a", {"t": ("", "text")})
    assert html_cards.extract_cards(pages, spec, ["page_id"]).collect() == []


def test_tree_without_limit_and_with_a_cycle(spark):
    chain = [(f"n{i}", f"name {i}", f"k{i}", f"n{i - 1}" if i else None) for i in range(105)]
    cycle = [("a", "A", "a", "n3"), ("b", "B", "b", "a"), ("a", "A", "a", "b")]
    nodes = spark.createDataFrame(chain + cycle, "category_id string, category_name string, url_key string, parent_id string")
    got = {(r["category_id"], r["depth"]) for r in payloads.flatten_category_tree(nodes).collect()}
    assert got == {(f"n{i}", i) for i in range(105)} | {("a", 4), ("b", 5)}


def test_long_chain_takes_rounds_by_its_logarithm(spark, monkeypatch):
    rounds = []
    kept = payloads.stage
    monkeypatch.setattr(payloads, "stage", lambda df, label: rounds.append(label) or kept(df, label))
    chain = spark.range(100_000).selectExpr(
        "concat('n', id) category_id", "concat('name ', id) category_name", "'k' url_key",
        "case when id > 0 then concat('n', id - 1) end parent_id",
    )
    ring = spark.range(7).selectExpr("concat('r', id)", "'ring'", "'k'", "concat('r', (id + 1) % 7)")
    got = payloads.flatten_category_tree(chain.union(ring))
    wrong = got.where("category_id <> concat('n', depth) or depth > 0 and parent_name <> concat('name ', depth - 1)")
    assert got.count() == 100_000 and wrong.isEmpty()
    assert rounds.count("tree-reached") == 17


def test_landmarks_bound_the_rounds_over_all_categories(spark, monkeypatch):
    """However long the chain, a fixed number of rounds joins more than a sixth of it."""
    sizes = []
    kept = payloads.stage

    def noted(df, label):
        stored = kept(df, label)
        sizes.append(stored.count())
        return stored

    monkeypatch.setattr(payloads, "stage", noted)
    monkeypatch.setattr(payloads, "LANDMARKS_FROM", 1, raising=False)
    for n in (3_000, 30_000):
        sizes.clear()
        chain = spark.range(n).selectExpr(
            "concat('n', id) category_id", "'x' category_name", "'k' url_key", "case when id > 0 then concat('n', id - 1) end parent_id"
        )
        ring = spark.range(3).selectExpr("concat('r', id)", "'ring'", "'k'", "concat('r', (id + 1) % 3)")
        depths = payloads.category_depths(chain.union(ring))
        assert depths.count() == n and depths.where("category_id <> concat('n', depth)").isEmpty()
        assert sum(size > n / 6 for size in sizes) <= 8


@pytest.mark.parametrize("landmarks_from", [1, 10**9])
@pytest.mark.parametrize("parents", [1, 2, 3])
def test_depths_are_those_of_a_walk_from_the_roots(spark, monkeypatch, parents, landmarks_from):
    """Trees, lattices with shortcuts, cycles, roots with parents, parents that are nowhere, ids given as numbers."""
    monkeypatch.setattr(payloads, "LANDMARKS_FROM", landmarks_from, raising=False)
    monkeypatch.setattr(payloads, "LANDMARK_ROUNDS", 2, raising=False)
    pick = random.Random(parents)
    rows = {(i, pick.randrange(max(i - 6, 0), i)) for i in range(1, 400) for _ in range(parents)} | {(0, None), (200, None)}
    rows |= {(i, 500 + (i + 1) % 9) for i in range(500, 509)} | {(600, 601), (602, 600), (503, 503)}
    if parents > 1:
        rows |= {(0, 399), (504, 300), (100, 380), (610, 504)}
    expected, edge = {0: 0, 200: 0}, {0, 200}
    while edge:
        edge = {c for c, p in rows if p in edge} - set(expected)
        expected.update(dict.fromkeys(edge, max(expected.values()) + 1))
    # Parents of another type of number meet the ids all the same.
    shape = "category_id bigint, category_name string, url_key string, parent_id int"
    nodes = spark.createDataFrame([(c, "x", "k", p) for c, p in sorted(rows, key=str)], shape)
    assert {r["category_id"]: r["depth"] for r in payloads.category_depths(nodes).collect()} == expected


def test_several_parents_blank_ids_and_no_rows(spark):
    rows = [
        ("r", "R", "r", None), ("a", "A", "a", "r"), ("b", "B", "b", "a"), ("c", "C", "c", "b"),
        # nearer to the root by its second parent, and equally near by two
        ("d", "D", "d", "c"), ("d", "D2", "d", "a"), ("e", "E", "e", "a"), ("e", "E", "e", "x"), ("x", "X", "", "r"),
        ("self", "S", "s", "self"), ("lost", "L", "l", "nowhere"), (None, "N", "n", "r"), ("below", "O", "o", "lost"),
    ]
    shape = "category_id string, category_name string, url_key string, parent_id string"
    df = spark.createDataFrame(rows, shape)
    got = sorted(tuple(r) for r in payloads.flatten_category_tree(df).select("category_id", "category_name", "parent_name", "depth").collect() if r[0] != "r")
    assert got == [("a", "A", "R", 1), ("b", "B", "A", 2), ("c", "C", "B", 3), ("d", "D2", "A", 2), ("e", "E", "A", 2), ("e", "E", "X", 2)]
    assert payloads.flatten_category_tree(spark.createDataFrame([], shape)).count() == 0


def test_children_inside_payloads(spark):
    body = '[{"id": 1, "name": "x", "url_key": "x", "children": [{"id": 2, "name": "y", "url_key": "", "children": [{"id": 3}]}]}]'
    df = spark.createDataFrame([(body,), (None,), ('{"id": 9, "name": "z"}',)], "body string")
    got = sorted((r["category_id"], r["parent_id"], r["url_key"]) for r in payloads.nested_categories(df, "body").collect())
    assert got == [("1", None, "x"), ("2", "1", ""), ("3", "2", None), ("9", None, None)]


def test_deeply_nested_and_large_pages(spark):
    deep = "<li><a href='/x'>" + "<b>" * 5000 + "name" + "</a></li>"
    wide = "<ul>" + "<li><a href='/y'>n</a></li>" * 9000 + "</ul>"
    pages = spark.createDataFrame([(1, deep), (2, wide), (3, None)], "page_id long, html string")
    spec = html_cards.CardSpec("li a", {"name": ("", "text")})
    got = html_cards.extract_cards(pages, spec, ["page_id"])
    assert got.where("page_id = 1").first()["name"] == "name"
    assert got.where("page_id = 2").agg({"pos": "max"}).first()[0] == 8999


def test_a_feed_is_a_file_or_a_folder_of_parts(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) product_id").repartition(4).write.json(str(tmp_path / "tiki" / "one.jsonl"))
    (tmp_path / "bookbuy").mkdir()
    (tmp_path / "bookbuy" / "b.jsonl").write_text("{}")
    found = feeds.find_latest_feeds(spark, str(tmp_path), ["tiki", "bookbuy", "fahasa"])
    assert {k: v.rsplit("/", 2)[1:] for k, v in found.items()} == {"tiki": ["tiki", "one.jsonl"], "bookbuy": ["bookbuy", "b.jsonl"]}
    assert feeds.read_feed(spark, found["tiki"], schemas.FLAT_FEED).count() == 100
