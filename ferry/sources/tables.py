"""Table and SQL sources (S1, S2) and catalog lookups."""

from __future__ import annotations

from typing import Any, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

PAYLOAD = "data_payload"


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A table by catalog name, or a parquet dataset by path."""
    if "/" in name or name.endswith(".parquet"):
        return spark.read.parquet(name)
    return spark.read.table(name)


def sql_source(spark: SparkSession, query: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """The outbound query, kept lazy. Parameters are bound, never pasted."""
    return spark.sql(query, args=dict(args) if args else None)


def existing_payload_schema(spark: SparkSession, table: str | None) -> StructType:
    """The record schema already stored in a landed table (empty if none)."""
    if not table or not table_exists(spark, table):
        return StructType([])
    if "/" in table or table.endswith(".parquet"):
        from ferry.operators.sink import load_schema

        stored = load_schema(spark, table)
        if stored is not None:
            return stored
        # no stored schema: every load's footer counts (a later load may have added fields)
        schema = spark.read.option("mergeSchema", "true").parquet(table).schema
    else:
        schema = spark.read.table(table).schema
    if PAYLOAD in schema.fieldNames():
        dt = schema[PAYLOAD].dataType
        if isinstance(dt, StructType):
            return dt
    return StructType([])


def ignore_fields(settings: DataFrame | None, table: str | None) -> list[str]:
    """Field names to drop for one table, from a settings table.

    ``settings`` has columns ``table_name`` and ``field_name``; nested fields
    are written as dotted paths. The result is small (one row per ignored
    field), so it is brought to the driver.
    """
    if settings is None or not table:
        return []
    rows = (
        settings.filter(F.col("table_name") == F.lit(table))
        .select("field_name")
        .distinct()
        .orderBy("field_name")
        .collect()
    )
    return [r["field_name"] for r in rows]


def table_exists(spark: SparkSession, table: str) -> bool:
    if "/" in table or table.endswith(".parquet"):
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(table)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.exists(p)) and any(
            not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p)
        )
    return spark.catalog.tableExists(table)


def union_all_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Accumulate frames whose columns may differ; missing columns become null."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
