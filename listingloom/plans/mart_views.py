"""The nine marts as SQL views that outlive the session that made them.

A view book is a folder of numbered versions. Each names the stored tables and the
views, every view as SQL text with what it reads. A version is written whole and
appears in one step; a new application opens the newest one, which puts its tables
and views into the session's catalog, each in one statement, what is read before
what reads it. With a catalog that is itself stored the views are there anyway, and
opening a newer book replaces them.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from listingloom.plans.marts import REPORT_COUNTERS

BASE_TABLES = [
    "products",
    "categories",
    "product_category_map",
    "product_snapshot",
    "pipeline_runs",
    "data_quality_reports",
    "rejected_products",
    "pipeline_task_audit",
]


@dataclass(frozen=True)
class View:
    sql: str
    reads: tuple[str, ...]


MEASURES = ["price", "final_price", "discount_percent", "sold_qty"]


def _mean(measure: str, total: str, rows: str) -> str:
    """Average to two decimals, halves away from zero, from a total and the number of its values."""
    quotient = f"try_divide(cast({total} as decimal(28,6)), cast({rows} as decimal(20,0)))"
    return f"cast(round(cast({quotient} as decimal(38,10)), 2) as decimal(18,2)) as avg_{measure}"


def _limbs(measure: str) -> str:
    """A sum as three longs, as in the mart: what follows multiplies and adds whole numbers only."""
    total, short = f"{measure}_sum", f"abs({measure}_sum) < 1000000000000000000"
    return (
        f"case when {short} then cast({total} as bigint) div 1000000000 else {total} div 1000000000 end as {measure}_high, "
        f"case when {short} then cast({total} as bigint) % 1000000000 else cast({total} % 1000000000 as bigint) end as {measure}_ones, "
        f"case when {short} then cast(({total} - cast({total} as bigint)) * 1000000000 as bigint) "
        f"else cast({total} % 1 * 1000000000 as bigint) end as {measure}_parts, {measure}_n"
    )


def _joined_limbs(measure: str) -> str:
    high, ones, parts = (f"cast({measure}_{part} as decimal(19,0))" for part in ("high", "ones", "parts"))
    return f"cast({high} * 1000000000 + {ones} as decimal(29,0)) + {parts} * 0.000000001"


def _percent(part: str, whole: str) -> str:
    quotient = f"try_divide(cast({part} * 100 as decimal(22,0)), cast(nullif({whole}, 0) as decimal(20,0)))"
    return f"cast(round(cast({quotient} as decimal(38,10)), 2) as decimal(18,2))"


def mart_views(tie_breaks: list[str]) -> dict[str, View]:
    """SQL of the marts in Spark's dialect; names in braces are put in when they are created.

    ``tie_breaks`` order snapshots of equal times: columns, with ``desc`` if wanted.
    """
    sums = ", ".join(f"sum({m}) as {m}_sum, count({m}) as {m}_n" for m in MEASURES)
    means = ", ".join(_mean(m, f"{m}_sum", f"{m}_n") for m in MEASURES)
    times = ", ".join(f"sum({m}_{part} * mapped * listed) as {m}_{part}" for m in MEASURES for part in ("sum", "n"))
    wide_sums = ", ".join(f"cast(sum({m}) as decimal(36,6)) as {m}_sum, count({m}) as {m}_n" for m in MEASURES)
    limbs = ", ".join(_limbs(m) for m in MEASURES)
    parts = [f"{m}_{part}" for m in MEASURES for part in ("high", "ones", "parts", "n")]
    weighted = ", ".join(f"sum({part} * weight) as {part}" for part in parts)
    day_means = ", ".join(_mean(m, _joined_limbs(m), f"{m}_n") for m in MEASURES)
    ties = "".join(f", {c}" for c in tie_breaks)
    counters = ", ".join(REPORT_COUNTERS)
    return {
        "vw_category_product_counts": View(
            """
            select c.category_id, c.category_name, count(distinct m.product_id) as total_products
            from (select distinct category_id, category_name from {categories}) c
            join {product_category_map} m on m.category_id = c.category_id
            group by c.category_id, c.category_name order by total_products desc
            """,
            ("categories", "product_category_map"),
        ),
        "vw_dm_category_performance": View(
            f"""
            with newest as (
                select s.* from {{product_snapshot}} s
                join (select product_id, max(processed_time) as processed_time from {{product_snapshot}} group by product_id) n
                  on n.product_id = s.product_id and n.processed_time = s.processed_time),
            latest as (
                select product_id, {sums}, bool_or(stock_available) as in_stock, bool_or(not stock_available) as out_stock
                from newest group by product_id),
            known as (select product_id, count(*) as listed from {{products}} group by product_id),
            filed as (
                select category_id, product_id, count(*) as mapped from {{product_category_map}} group by category_id, product_id),
            totals as (
                select f.category_id, count(f.product_id) as total_products, {times},
                       count_if(in_stock) as in_stock_products, count_if(out_stock) as out_stock_products
                from filed f left join known k on k.product_id = f.product_id
                left join latest l on l.product_id = k.product_id
                group by f.category_id)
            select c.category_id, c.category_name, coalesce(total_products, 0) as total_products, {means},
                   coalesce(in_stock_products, 0) as in_stock_products, coalesce(out_stock_products, 0) as out_stock_products
            from (select distinct category_id, category_name from {{categories}}) c
            left join totals t on t.category_id = c.category_id
            """,
            ("categories", "product_category_map", "products", "product_snapshot"),
        ),
        "vw_dm_pipeline_health_daily": View(
            f"""
            with rejected as (
                select to_date(rejected_at) as run_date, count(*) as total_rejected
                from {{rejected_products}} group by to_date(rejected_at)),
            tasks as (
                select to_date(finished_at) as run_date, count(*) as total_tasks,
                       count_if(status = 'success') as success_tasks, count_if(status = 'failed') as failed_tasks
                from {{pipeline_task_audit}} group by to_date(finished_at)),
            runs as (
                select to_date(r.processed_at) as run_date, count(distinct r.process_run_id) as total_runs,
                       coalesce(sum(q.total_products_seen), 0) as total_products_seen,
                       coalesce(sum(q.products_passed), 0) as total_products_passed,
                       coalesce(sum(q.products_failed), 0) as total_products_failed,
                       coalesce(sum(q.duplicate_product_id), 0) as total_duplicate_product_id
                from {{pipeline_runs}} r
                left join {{data_quality_reports}} q on q.process_run_id = r.process_run_id
                group by to_date(r.processed_at))
            select runs.*,
                   cast(coalesce({_percent("total_products_failed", "total_products_seen")}, 0) as decimal(18,2))
                       as failure_rate_percent,
                   coalesce(total_rejected, 0) as total_rejected, coalesce(total_tasks, 0) as total_tasks,
                   coalesce(success_tasks, 0) as success_tasks, coalesce(failed_tasks, 0) as failed_tasks
            from runs left join rejected on rejected.run_date = runs.run_date left join tasks on tasks.run_date = runs.run_date
            """,
            ("pipeline_runs", "data_quality_reports", "rejected_products", "pipeline_task_audit"),
        ),
        "vw_pipeline_quality_runs": View(
            f"""
            select r.process_run_id, processed_at, source_name, raw_file_minio, total_raw_records, {counters}
            from {{pipeline_runs}} r join {{data_quality_reports}} q on q.process_run_id = r.process_run_id
            """,
            ("pipeline_runs", "data_quality_reports"),
        ),
        "vw_pipeline_failure_rate": View(
            f"""
            select process_run_id, processed_at, total_products_seen, products_failed,
                   {_percent("products_failed", "total_products_seen")} as failure_rate_percent
            from {{vw_pipeline_quality_runs}}
            """,
            ("vw_pipeline_quality_runs",),
        ),
        "vw_dm_price_daily": View(
            f"""
            with days as (
                select product_id, to_date(processed_time) as snapshot_date, {wide_sums}
                from {{product_snapshot}} group by product_id, to_date(processed_time)),
            split as (select product_id, snapshot_date, {limbs} from days),
            weights as (
                select product_id, category_id, count(*) as weight from {{product_category_map}} group by product_id, category_id),
            totals as (
                select snapshot_date, category_id, count(*) as total_products, {weighted}
                from split join weights on weights.product_id = split.product_id
                group by snapshot_date, category_id)
            select snapshot_date, c.category_id, c.category_name, total_products, {day_means}
            from totals join (select distinct category_id, category_name from {{categories}}) c
              on c.category_id = totals.category_id
            order by snapshot_date, category_name
            """,
            ("product_snapshot", "product_category_map", "categories"),
        ),
        "vw_latest_product_snapshot": View(
            f"""
            with ranked as (
                select *, row_number() over (
                    partition by product_id order by processed_time desc nulls last{ties}) as place
                from {{product_snapshot}})
            select p.product_id, product_name, product_url, image_src, price, final_price, discount_percent,
                   stock_available, sold_qty, processed_time
            from {{products}} p join ranked on ranked.product_id = p.product_id where place = 1
            """,
            ("products", "product_snapshot"),
        ),
        "vw_top_discount_products": View(
            """
            select product_id, product_name, price, final_price, discount_percent, processed_time
            from {vw_latest_product_snapshot} where discount_percent is not null
            order by discount_percent desc, processed_time desc nulls first, product_id
            """,
            ("vw_latest_product_snapshot",),
        ),
        "vw_top_sold_products": View(
            """
            select product_id, product_name, sold_qty, final_price, discount_percent, processed_time
            from {vw_latest_product_snapshot} where sold_qty is not null
            order by sold_qty desc, processed_time desc nulls first, product_id
            """,
            ("vw_latest_product_snapshot",),
        ),
    }


def in_order(views: dict[str, View], tables: set[str]) -> list[str]:
    """Names of the views, each after all that it reads."""
    done, order = set(tables), []
    while len(order) < len(views):
        ready = [name for name, view in views.items() if name not in done and done.issuperset(view.reads)]
        if not ready:
            left = sorted(set(views) - done)
            missing = sorted({r for n in left for r in views[n].reads} - set(tables) - set(views))
            raise ValueError(f"views {left} read {missing or 'one another'}")
        order += ready
        done.update(ready)
    return order


class ViewBook:
    """Versions of tables and views below ``root``, a folder that all applications share."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    def _path(self, name: str):
        path = self._hadoop.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, system = self._path("")
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d+\.json", n))

    def publish(self, tables: dict[str, str], views: dict[str, View]) -> int:
        """Writes the next version: table names with their Parquet folders, and views. Returns its number."""
        in_order(views, set(tables))
        version = (self.versions() or [0])[-1] + 1
        body = {"tables": tables, "views": {n: {"sql": v.sql, "reads": v.reads} for n, v in views.items()}}
        draft, system = self._path(f".{uuid.uuid4().hex}")
        out = system.create(draft, False)
        out.write(bytearray(json.dumps(body, ensure_ascii=False).encode()))
        out.close()
        final, _ = self._path(f"{version:010d}.json")
        if system.exists(final) or not system.rename(draft, final):
            system.delete(draft, False)
            raise RuntimeError(f"version {version} of {self.root} was written by another application")
        return version

    def read(self, version: int | None = None) -> tuple[dict[str, str], dict[str, View]]:
        known = self.versions()
        if not known:
            raise ValueError(f"no views have been published to {self.root}")
        path = f"{self.root}/{version or known[-1]:010d}.json"
        found = json.loads(self.spark.read.option("wholetext", True).text(path).first()[0])
        return found["tables"], {n: View(v["sql"], tuple(v["reads"])) for n, v in found["views"].items()}

    def open(self, database: str = "default", version: int | None = None) -> list[str]:
        """Puts the book's tables and views into a database of the session's catalog; returns the views' names.

        The views read each other by their full names, so they hold in any session
        of the catalog, whichever database it is in.
        """
        tables, views = self.read(version)
        full = {name: f"`{database}`.`{name}`" for name in (*tables, *views)}
        self.spark.sql(f"create database if not exists `{database}`")
        for name, folder in tables.items():
            if self.spark.catalog.tableExists(f"{database}.{name}"):
                place = folder.replace("\\", "\\\\").replace("'", "\\'")
                self.spark.sql(f"alter table {full[name]} set location '{place}'")
                self.spark.catalog.refreshTable(full[name])
            else:
                self.spark.catalog.createTable(f"{database}.{name}", path=folder, source="parquet")
        for name in in_order(views, set(tables)):
            self.spark.sql(f"create or replace view {full[name]} as {views[name].sql.format_map(full)}")
        return list(views)
