"""Files of a wanted size; feeds whose fields have no one type."""

import json

import pytest
from pyspark.sql import functions as F

from listingloom.operators import normalize
from listingloom.sinks import sized
from listingloom.sinks.sized import compact, measured_parts, write_sized
from listingloom.sources import feeds, variant_feed
from tests.test_processing import RUN_TS


def made(spark, rows, tasks):
    text = F.concat_ws(" ", *[F.md5((F.col("id") * k).cast("string")) for k in range(1, 4)])
    return spark.range(0, rows, 1, tasks).select("id", text.alias("text"), (F.col("id") % 7).alias("kind"))


@pytest.mark.parametrize(("rows", "tasks", "target"), [(6_000, 40, 150_000), (40_000, 2, 400_000), (90_000, 9, 1_500_000)])
def test_files_are_near_the_target(spark, tmp_path, rows, tasks, target):
    files = write_sized(made(spark, rows, tasks), str(tmp_path / "out"), target)
    parts = [r["bytes"] for r in measured_parts(spark, str(tmp_path / "out")).collect()]
    assert len(parts) == files > 2
    assert all(abs(size - target) < 0.2 * target for size in parts), parts
    assert spark.read.parquet(str(tmp_path / "out")).exceptAll(made(spark, rows, 1)).isEmpty()
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows


def test_one_file_and_no_rows(spark, tmp_path):
    made(spark, 2_000, 8).write.parquet(str(tmp_path / "many"))
    assert compact(spark, str(tmp_path / "many"), str(tmp_path / "one")) == 1
    assert len(list((tmp_path / "one").glob("*.parquet"))) == 1
    # Parts are laid end to end, so their order stays.
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "one")).select("id").collect()] == list(range(2_000))
    assert write_sized(made(spark, 0, 3), str(tmp_path / "none")) == 0
    assert spark.read.parquet(str(tmp_path / "none")).columns == ["id", "text", "kind"]


def test_rows_are_not_shuffled_to_meet_their_places(spark, tmp_path, monkeypatch):
    plans, write = [], sized._write_pieces

    def seen(placed, *rest):
        plans.append(placed._jdf.queryExecution().executedPlan().toString())
        write(placed, *rest)

    monkeypatch.setattr(sized, "_write_pieces", seen)
    # To Spark this table is too large to be broadcast, as one of many gigabytes is by default.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        write_sized(made(spark, 40_000, 6), str(tmp_path / "out"), 400_000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The trial and the whole table.
    assert len(plans) == 2
    assert not any("hashpartitioning" in plan for plan in plans)


def test_records_of_any_form(spark, tmp_path):
    lines = [
        json.dumps({"product_id": 1, "product_name": "Number", "price": 89000, "stock_available": True}),
        json.dumps({"product_id": "2", "product_name": "Text", "price": "89.000đ", "stock_available": 0}),
        json.dumps({"product_id": 3.5, "product_name": ["a", "b"], "price": {"value": 5}, "odd 'key'": {"x": [1]}}),
        json.dumps({"product_id": None, "price": None}), "", "{broken", "[1, 2]", "7",
    ]
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(lines), encoding="utf-8")
    feed = variant_feed.read_variant_feed(spark, str(path))
    assert [r[0] for r in feed.select(feeds.CORRUPT).collect()] == [None] * 4 + ["{broken", None, None]
    assert "price: VARIANT" in variant_feed.feed_schema(feed.limit(3))
    out = variant_feed.normalize_variant(feed, "tiki", normalize.LISTING, RUN_TS)
    got = [tuple(r) for r in out.select("product_id", "product_name", "price", feeds.CORRUPT).collect()]
    assert got == [
        ("1", "Number", 89000, None), ("2", "Text", 89000, None), ("3.5", '["a","b"]', None, None), (None, None, None, None),
        (None, None, None, "{broken"), (None, None, None, None), (None, None, None, None),
    ]
    assert feed.select(variant_feed.field("price.value", "int"), variant_feed.field("price", "int")).collect()[2] == (5, None)


@pytest.mark.parametrize("name", ["tiki", "vinabook", "fahasa"])
def test_same_rows_as_the_typed_feed(spark, tmp_path, name):
    flat = [{"product_id": str(n), "product_name": f"Name {n}", "price": n * 1000, "original_price": f"{n}.000 ₫", "discount": n,
             "rating_average": n / 2, "stock_available": n % 2 == 0, "crawl_time": "2024-05-31"} for n in range(20)]
    nested = [{"crawl_time": "t", "body": {"product_list": [{"product_id": str(n), "product_name": f"N {n}", "product_price": "9.000"}] * (n % 3)}}
              for n in range(6)] + [{"body": None}, {"body": {"product_list": None}}]
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(map(json.dumps, nested if name == "fahasa" else flat)))
    mapping = normalize.MAPPINGS[name]
    typed = normalize.normalize(feeds.read_feed(spark, str(path), normalize.FEED_SCHEMAS[name]), name, mapping, RUN_TS)
    loose = variant_feed.normalize_variant(variant_feed.read_variant_feed(spark, str(path)), name, mapping, RUN_TS)
    assert dict(typed.dtypes) == dict(loose.dtypes)
    assert sorted(map(repr, typed.collect())) == sorted(map(repr, loose.select(*typed.columns).collect()))
