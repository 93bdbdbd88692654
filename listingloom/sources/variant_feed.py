"""Feeds of unknown layout, each record kept as one VARIANT value.

Nothing is inferred over the text and no field has a type of its own: records of
any form stand side by side, and a projection asks each of them for a path. What is
missing, or does not fit the type asked for, is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingloom import schemas
from listingloom.functions.names import product_key
from listingloom.functions.numbers import double_by_form, long_by_form
from listingloom.operators.normalize import MAPPED, Mapping
from listingloom.sources.feeds import CORRUPT

RECORD = "record"


def read_variant_feed(spark: SparkSession, path: str) -> DataFrame:
    """``record`` of every line that is not blank, NULL where it is no JSON; the line is then in ``_corrupt_record``."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.try_parse_json("value").alias(RECORD), "value").select(
        RECORD, F.when(F.col(RECORD).isNull(), F.col("value")).alias(CORRUPT)
    )


def json_path(dotted: str) -> str:
    return "$" + "".join(f"['{step}']" for step in dotted.split("."))


def field(dotted: str, type_name: str = "string", record: str = RECORD) -> Column:
    """The value at a dotted path as a type, NULL where it is absent, JSON null or of another form."""
    return F.try_variant_get(record, json_path(dotted), type_name)


def elements(df: DataFrame, dotted: str, item: str = "item") -> DataFrame:
    """A row per element of the array at a path, as VARIANT ``item``; one row of NULL where there is none."""
    return df.withColumn(item, F.explode_outer(field(dotted, "array<variant>")))


def feed_schema(df: DataFrame) -> str:
    """The layout that all records together have, as a type: one aggregation, only when someone asks.

    Fields that records fill with several types are VARIANT in it.
    """
    return df.agg(F.schema_of_variant_agg(RECORD)).first()[0]


def normalize_variant(df: DataFrame, source_name: str, mapping: Mapping, run_ts: str) -> DataFrame:
    """Canonical rows of one source's VARIANT feed, as :func:`normalize` makes them of a typed one.

    Every value is taken as text and read by its form, so a field may be a number in
    one record, printed text in the next and a flag in a third. A whole object or
    array where a value is expected is NULL for numbers.
    """
    base = RECORD
    if mapping.nested:
        df = elements(df, mapping.nested)
    columns = {}
    for target in MAPPED:
        path = mapping.paths.get(target.name, target.name)
        if path is None:
            columns[target.name] = F.lit(None).cast(target.dataType)
            continue
        record, inner = ("item", path[5:]) if mapping.nested and path.startswith("item.") else (base, path)
        text = field(inner, "string", record)
        kind = target.dataType.typeName()
        if kind in ("long", "integer"):
            text = long_by_form(text).try_cast(target.dataType)
        elif kind == "double":
            text = double_by_form(text)
        columns[target.name] = text
    columns["standard_category"] = F.coalesce(columns["standard_category"], F.lit(schemas.DEFAULT_CATEGORY))
    return (
        df.select(F.lit(source_name).alias("source_name"), *[c.alias(n) for n, c in columns.items()], CORRUPT)
        .withColumn("product_key", product_key(F.col("product_name")))
        .withColumn("name_key", F.col("product_key"))
        .withColumn("processed_time", F.lit(run_ts))
    )
