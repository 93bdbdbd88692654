"""The processing run: raw feeds to one deduplicated product table and its reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingloom.operators import quality, resolve
from listingloom.operators.dedup import dedup_key, latest_or_keyless
from listingloom.operators.normalize import (
    FEED_SCHEMAS,
    MAPPINGS,
    normalize_source,
    union_sources,
)
from listingloom.operators.observed import CountedRows
from listingloom.sinks import tables
from listingloom.sinks.latest_state import BUCKETS, LatestState
from listingloom.sources.feeds import CORRUPT, find_latest_feeds, read_feed, with_raw_file
from listingloom.storage import stage, temporary_stages

KEY = "_dedup_key"


@dataclass
class Outputs:
    """Folders of a run, and its stored result tables."""

    products: str
    partitioned: str
    rejects: str
    duplicates: str
    summary: str


def read_sources(spark: SparkSession, feeds: dict[str, str], run_ts: str) -> DataFrame:
    """Canonical rows of all given feeds (source name to path)."""
    unknown = set(feeds) - set(MAPPINGS)
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    frames = []
    for source, path in feeds.items():
        raw = read_feed(spark, path, FEED_SCHEMAS[source])
        frames.append(with_raw_file(normalize_source(raw, source, run_ts), path))
    return union_sources(frames)


def with_dedup_key(df: DataFrame) -> DataFrame:
    key = dedup_key(
        F.col("product_id"), F.col("product_url"), F.col("product_key"), F.col("product_name")
    )
    if CORRUPT in df.columns:
        # What is no record is nobody's newer version.
        key = F.when(F.col(CORRUPT).isNull(), key)
    return df.withColumn(KEY, key)


def latest_products(df: DataFrame) -> DataFrame:
    """The newest row per source and key; remaining ties by all else that differs.

    Rows without a key all stay, for validation to report them.
    """
    return latest_or_keyless(with_dedup_key(df), ["source_name", KEY], KEY, "crawl_time", product_ties())


def product_ties() -> list[Column]:
    ties = ["product_id", "product_url", "product_name", "price", "original_price", "final_price"]
    return [F.col(c).asc_nulls_last() for c in [*ties, "crawl_page", "raw_file"]]


def run(
    spark: SparkSession,
    feeds: dict[str, str],
    out_dir: str,
    run_ts: str,
    include_exact: bool = False,
) -> Outputs:
    """Processes the feeds into ``out_dir``, a folder of this run alone.

    The raw text is parsed once, into a stored table; the valid rows and the
    flagged ids are stored as well, since several outputs read each of them.
    These tables go when the outputs are written. The summary's numbers are
    counted by the writes.
    """
    out = _folders(out_dir)
    with temporary_stages(spark):
        everything, read = _parsed(spark, feeds, run_ts)
        _write_outputs(spark, latest_products(everything), read, feeds, out, run_ts, include_exact)
    return out


def run_update(
    spark: SparkSession,
    state_root: str,
    feeds: dict[str, str],
    out_dir: str,
    run_ts: str,
    include_exact: bool = False,
    buckets: int = BUCKETS,
) -> Outputs:
    """Adds the feeds to the stored state of earlier ones and processes all of it.

    The outputs are those of one run over all feeds so far, but only the new feeds
    are parsed, and only the buckets of the state that they touch are rewritten.
    ``processed_time`` tells which run a row came with. A feed counts as read each
    time that it is added.
    """
    state = product_state(spark, state_root, buckets)
    out = _folders(out_dir)
    with temporary_stages(spark):
        everything, read = _parsed(spark, feeds, run_ts)
        rows = with_dedup_key(everything)
        manifest = state.add(rows, read)
        latest = state.read() if manifest.parts else rows
        _write_outputs(spark, latest, dict(manifest.rows_read), feeds, out, run_ts, include_exact)
    return out


def product_state(spark: SparkSession, root: str, buckets: int = BUCKETS) -> LatestState:
    """The stored newest rows of every source's products; ``buckets`` per source, for a new state."""
    return LatestState(spark, root, "source_name", KEY, "crawl_time", product_ties(), buckets)


def _folders(out_dir: str) -> Outputs:
    names = ("products", "products_by_source", "rejects", "duplicates", "summary")
    return Outputs(*[f"{out_dir.rstrip('/')}/{name}" for name in names])


def _parsed(spark: SparkSession, feeds: dict[str, str], run_ts: str) -> tuple[DataFrame, dict[str, int]]:
    """The feeds' rows as a stored table, and how many each source has."""
    counted = CountedRows(read_sources(spark, feeds, run_ts), list(feeds), {"read": F.lit(True)})
    return stage(counted.frame, "canonical"), {source: n["read"] for source, n in counted.counts().items()}


def _write_outputs(
    spark: SparkSession,
    latest: DataFrame,
    read: dict[str, int],
    feeds: dict[str, str],
    out: Outputs,
    run_ts: str,
    include_exact: bool,
) -> None:
    sources = list(read)
    is_valid = F.size("validation_errors") == 0
    checking = CountedRows(
        quality.add_validation_errors(latest),
        sources,
        {
            "after_validate": is_valid,
            "bad_products": ~is_valid,
            "malformed_records": F.array_contains("validation_errors", "malformed_record"),
        },
    )
    checked = stage(checking.frame, "checked")
    valid = quality.valid_rows(checked).drop(CORRUPT)
    rejected = quality.rejected_rows(checked)

    flagged = resolve.find_duplicates(valid, [KEY], include_exact)
    found = resolve.duplicates(valid, flagged).drop(KEY)
    keeping = CountedRows(
        resolve.survivors(valid, flagged).drop(KEY), sources, {"after_dedup": F.lit(True)}
    )

    tables.write_table(keeping.frame, out.products)
    kept = spark.read.parquet(out.products)
    tables.write_partitioned(kept, out.partitioned)
    tables.write_report(tables.reject_report(rejected), out.rejects, by="source_name")
    tables.write_report(tables.duplicate_report(found), out.duplicates, by="source_name")
    counts = tables.count_table(spark, read, checking.counts(), keeping.counts())
    tables.write_report(tables.run_summary(counts, None, run_ts, vars(out), feeds), out.summary)


def run_latest(
    spark: SparkSession, raw_root: str, out_dir: str, run_ts: str, include_exact: bool = False
) -> Outputs:
    """The same over the newest feed of each source below ``raw_root``."""
    return run(
        spark, find_latest_feeds(spark, raw_root, list(MAPPINGS)), out_dir, run_ts, include_exact
    )
