"""Stored newest rows, added to feed by feed; and counts that writes bring along."""

import json
import random
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from listingloom.operators.dedup import latest_or_keyless
from listingloom.operators.observed import CountedRows
from listingloom.plans import processing
from listingloom.sinks.latest_state import KEYLESS, LatestState
from tests.test_processing import RUN_TS, flat, put

SHAPE = "s string, k string, t string, n int"


def state_at(spark, root, **more):
    return LatestState(spark, str(root), "s", "k", "t", [F.col("n").asc_nulls_last()], **{"buckets": 4, **more})


def files(state, parts):
    return {f"{folder}/{p.name}" for _, _, folder in parts for p in Path(state.root, folder).iterdir() if p.suffix == ".parquet"}


def test_feeds_one_by_one_equal_all_at_once(spark, tmp_path, rows):
    pick = random.Random(4)
    feeds = [
        [
            (pick.choice(["a", "b/ =%", None, ""]), pick.choice([None, *map(str, range(30))]), pick.choice([None, "1", "2", "3"]), n)
            for n in range(base, base + 60)
        ]
        for base in range(0, 300, 60)
    ]
    state = state_at(spark, tmp_path)
    assert state.read() is None
    for feed in feeds:
        state.add(spark.createDataFrame(feed, SHAPE))
    everything = spark.createDataFrame([r for feed in feeds for r in feed], SHAPE)
    ties = [F.col("n").asc_nulls_last()]
    # An empty value of the first column is stored like NULL's folder name would be, not as NULL.
    assert rows(state.read()) == rows(latest_or_keyless(everything, ["s", "k"], "k", "t", ties))
    assert rows(state.read(2)) == rows(
        latest_or_keyless(spark.createDataFrame(feeds[0] + feeds[1], SHAPE), ["s", "k"], "k", "t", ties)
    )


def test_untouched_files_keep_their_names(spark, tmp_path):
    state = state_at(spark, tmp_path)
    first = state.add(spark.createDataFrame([(s, str(k), "1", k) for s in "ab" for k in range(40)], SHAPE))
    second = state.add(spark.createDataFrame([("b", "3", "2", 7), ("b", None, None, 8)], SHAPE), {"b": 2})
    kept = set(first.parts) & set(second.parts)
    (changed,) = set(first.parts) - kept
    assert changed[0] == "b" and len(first.parts) == 8 and len(second.parts) == 9
    assert files(state, kept) <= files(state, first.parts) & files(state, second.parts)
    assert [p[1] for p in second.parts].count(KEYLESS) == 1 and dict(second.rows_read) == {"b": 2}
    assert {r["n"] for r in state.read().where("s = 'b' and (k = '3' or k is null)").collect()} == {7, 8}
    # An older version never wins, whatever the order of feeds.
    state.add(spark.createDataFrame([("b", "3", "0", 9)], SHAPE), {"b": 1})
    assert state.read().where("s = 'b' and k = '3'").first()["n"] == 7 and dict(state.manifest().rows_read) == {"b": 3}


def test_runs_side_by_side_and_clean_up(spark, tmp_path):
    state = state_at(spark, tmp_path)
    state.add(spark.createDataFrame([("a", "1", "1", 1)], SHAPE))
    stale = state.manifest()
    state.add(spark.createDataFrame([("a", "2", "1", 2)], SHAPE))
    late = state_at(spark, tmp_path)
    late.manifest = lambda version=None: stale
    with pytest.raises(RuntimeError, match="version 2"):
        late.add(spark.createDataFrame([("a", "3", "1", 3)], SHAPE))
    assert state.read().count() == 2 and state.versions() == [1, 2]
    state.add(spark.createDataFrame([("a", "4", "1", 4)], SHAPE))
    gone = state.expire(keep=1)
    assert gone and state.versions() == [3] and sorted(r["n"] for r in state.read().collect()) == [1, 2, 4]


def test_updates_equal_one_run(spark, tmp_path):
    one = [flat("Old name", 5, product_id=1), flat("Stays", 6, product_id=2), flat(" ", 1, product_id=3)]
    two = [flat("New name", 7, product_id=1, crawl_time="2024-06-01T00:00:00"), flat("Third", -8, product_id=4)]
    paths = [str(put(tmp_path / str(n), "tiki", "f.jsonl", rows)) for n, rows in enumerate([one, two])]
    for path in paths:
        out = processing.run_update(spark, str(tmp_path / "state"), {"tiki": path}, str(tmp_path / "out" / Path(path).parts[-3]), RUN_TS, buckets=2)
    both = tmp_path / "both.jsonl"
    both.write_text("\n".join(Path(p).read_text() for p in paths))
    whole = processing.run(spark, {"tiki": str(both)}, str(tmp_path / "whole"), RUN_TS)
    names = ["product_id", "product_name", "price", "processed_time"]
    a, b = (sorted(map(tuple, spark.read.parquet(o.products).select(names).collect())) for o in (out, whole))
    assert a == b and len(a) == 2
    summaries = [
        {k: v for k, v in spark.read.json(o.summary).where("source_name = 'tiki'").first().asDict().items() if k.startswith(("total", "bad"))}
        for o in (out, whole)
    ]
    assert summaries[0] == summaries[1] and summaries[0]["total_before_validate"] == 5
    empty = tmp_path / "empty.jsonl"
    empty.write_text("")
    out = processing.run_update(spark, str(tmp_path / "none"), {"tiki": str(empty)}, str(tmp_path / "no"), RUN_TS, buckets=2)
    assert spark.read.parquet(out.products).count() == 0


def test_counts_come_with_the_write(spark, tmp_path):
    df = spark.range(1000).selectExpr("concat('s', id % 3) s", "id")
    counted = CountedRows(df.repartition(7), ["s0", "s1", "nowhere"], {"all": F.lit(True), "big": F.col("id") > 500}, by="s")
    counted.frame.write.parquet(str(tmp_path / "t"))
    assert counted.counts() == {"s0": {"all": 334, "big": 167}, "s1": {"all": 333, "big": 166}, "nowhere": {"all": 0, "big": 0}}
    spark.read.parquet(str(tmp_path / "t")).count()
    assert counted.counts()["s0"]["all"] == 334
    none = CountedRows(df.where("1 = 0"), ["s0"], {"all": F.lit(True)}, by="s")
    none.frame.write.parquet(str(tmp_path / "u"))
    assert none.counts() == {"s0": {"all": 0}}
    assert CountedRows(df, [], {"all": F.lit(True)}, by="s").counts() == {}


def test_failed_attempts_are_not_counted(tmp_path):
    """Every task fails once after it has seen its rows; an application of its own that allows it."""
    script = f"""
        import sys, json
        sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
        from pyspark import TaskContext
        from pyspark.sql import SparkSession, functions as F
        from listingloom.operators.observed import CountedRows
        spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", False).getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        def once(batches):
            for batch in batches:
                yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise ValueError("lost")
        df = spark.range(0, 5000, 1, 4).mapInArrow(once, "id long").repartition(3).mapInArrow(once, "id long")
        counted = CountedRows(df.selectExpr("id", "'s' as source_name"), ["s"], {{"rows": F.lit(True)}})
        counted.frame.write.parquet({str(tmp_path / "out")!r})
        print(json.dumps([counted.counts()["s"]["rows"], spark.read.parquet({str(tmp_path / "out")!r}).count()]))
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script)], capture_output=True, text=True, timeout=300)
    assert json.loads(done.stdout.strip().splitlines()[-1]) == [5000, 5000], done.stderr[-2000:]


def test_merged_folders_of_a_feed_go(spark, tmp_path):
    """What a feed brought to buckets that were there before lies in the merged folders alone."""
    state = LatestState(spark, str(tmp_path / "state"), "source", "key", "time", [F.col("value")], buckets=2)
    rows = "source string, key string, time string, value int"
    for time in ("1", "2"):
        state.add(spark.createDataFrame([("a", str(i), time, i) for i in range(40)] + [("a", None, time, 7)], rows))
    named = {folder for version in state.versions() for _, _, folder in state.manifest(version).parts}
    there = {str(f.parent.relative_to(tmp_path / "state")) for f in (tmp_path / "state/data").rglob("*.parquet")}
    assert there == named
    assert state.read().count() == 42
