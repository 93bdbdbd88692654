import json
import os

import pytest

from listingloom import schemas
from listingloom.operators import gate
from listingloom.plans import processing

RUN_TS = "2024-06-01 00:00:00"
LONG = "Lịch sử thế giới cổ đại toàn tập quyển một hai ba bốn năm sáu bảy tám"


def flat(name, price, **more):
    return {"product_name": name, "price": price, "crawl_time": "2024-05-31T10:00:00", **more}


def put(root, source, name, records):
    path = root / source / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in records), encoding="utf-8")
    return path


@pytest.fixture(scope="module")
def outputs(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    old = put(root / "raw", "tiki", "old.jsonl", [flat("Stale", 1, product_id=99)])
    os.utime(old, (1000, 1000))
    put(root / "raw", "tiki", "tiki_raw.jsonl", [
        flat(LONG, 100, product_id=1),
        flat("Twice", 5, product_id=2),
        flat("Twice again", 6, product_id=2, crawl_time="2024-05-31T11:00:00"),
        flat("  ", 5, product_id=3),
    ])
    put(root / "raw", "tiki", "tiki_summary.json", [{"total_products": 4}])
    put(root / "raw", "phuongnam", "p.jsonl", [
        flat("Same", 5, product_url="/same"),
        flat("Same", 5, product_url="/same"),
        flat("Other", 5, product_url="/other"),
        flat("Below", -5, product_url="/below"),
    ])
    put(root / "raw", "vinabook", "v.jsonl", [flat(LONG + " tái bản", 110, product_id="v1", stock_available=False),
                                              flat(LONG + " chín", 110, product_id="v2")])
    put(root / "raw", "fahasa", "f.jsonl", [
        {"crawl_time": "2024-05-31", "body": {"product_list": [
            {"product_id": "f1", "product_name": "Nested", "product_price": "9.000", "product_finalprice": "8.000"}]}},
        {"crawl_time": "2024-05-31", "body": {"product_list": []}},
    ])
    out = processing.run_latest(spark, str(root / "raw"), str(root / "run1"), RUN_TS)
    return spark, out


def test_products(outputs):
    spark, out = outputs
    products = spark.read.parquet(out.products)
    assert [(f.name, f.dataType) for f in products.schema.fields] == [
        (f.name, f.dataType) for f in schemas.PRODUCT.fields
    ]
    got = {(r["source_name"], r["product_name"]) for r in products.collect()}
    assert got == {
        ("tiki", LONG), ("tiki", "Twice again"), ("phuongnam", "Same"), ("phuongnam", "Other"),
        # its remark is dropped, so the name equals the first one's, and equal names stay
        ("vinabook", LONG + " tái bản"), ("fahasa", "Nested"),
    }
    by_name = {r["product_name"]: r for r in products.collect()}
    assert by_name["Nested"]["final_price"] == 8000
    assert by_name[LONG + " tái bản"]["stock_available"] == 0
    assert by_name[LONG]["raw_file"].endswith("tiki_raw.jsonl")
    assert {r["processed_time"] for r in by_name.values()} == {RUN_TS}


def test_partitioned_copy_has_the_same_rows(outputs):
    spark, out = outputs
    names = [f.name for f in schemas.PRODUCT.fields]
    a, b = spark.read.parquet(out.products), spark.read.parquet(out.partitioned).select(*names)
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_reports(outputs):
    spark, out = outputs
    rejects = spark.read.json(out.rejects)
    assert {(r["source_name"], tuple(r["validation_errors"])) for r in rejects.collect()} == {
        ("tiki", ("missing_product_name",)),
        ("phuongnam", ("invalid_price_negative",)),
        ("fahasa", ("missing_product_name",)),
    }
    duplicates = spark.read.json(out.duplicates)
    assert [r["product_name"] for r in duplicates.collect()] == [LONG + " chín"]
    summaries = {r["source_name"]: r for r in spark.read.json(out.summary).collect()}
    summary = summaries.pop("all sources")
    assert summary["total_valid_before_dedup"] == 7
    assert summaries["tiki"]["source_file"].endswith("tiki_raw.jsonl")
    assert (summary["total_after_dedup"], summary["bad_products"], summary["duplicate_products"]) == (6, 3, 1)
    stages = ("total_before_validate", "total_valid_before_dedup", "total_after_dedup")
    counts = {name: tuple(r[k] for k in stages) for name, r in summaries.items()}
    assert counts == {"tiki": (4, 2, 2), "phuongnam": (4, 2, 2), "vinabook": (2, 2, 1), "fahasa": (2, 1, 1)}


def test_gate_on_the_product(outputs):
    spark, out = outputs
    got = {r["check_name"]: r["passed"] for r in gate.dataset_gate(spark.read.parquet(out.partitioned)).collect()}
    assert got["required_sources"] is False and got["has_rows"] and got["crawl_time"]


def test_nothing_to_process(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    with pytest.raises(ValueError):
        processing.run_latest(spark, str(tmp_path / "raw"), str(tmp_path / "out"), RUN_TS)
    with pytest.raises(ValueError):
        processing.run(spark, {"nowhere": "x"}, str(tmp_path / "out"), RUN_TS)
