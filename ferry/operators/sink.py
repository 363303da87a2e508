"""Sinks: idempotent load append (K1, K2), views and materialised tables (K4, K5).

A landed table is a parquet dataset partitioned by ``source_id/load_id``.
Writes use dynamic partition overwrite: a new load adds its partition, a
rerun of the same load replaces only its own partition, so a rerun never
duplicates rows. Readers use the schema stored beside the table, so fields
added by later loads come back NULL in older rows.
"""

from __future__ import annotations

import json
import re
import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

PARTITION_COLUMNS = ("source_id", "load_id")
_SAFE = re.compile(r"^[A-Za-z0-9_.\-]+$")


def check_partition_value(value: str) -> str:
    if not _SAFE.match(str(value)):
        raise ValueError(f"partition value {value!r} must match {_SAFE.pattern}")
    return str(value)


def write_partitions(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = PARTITION_COLUMNS,
    max_records_per_file: int | None = None,
    name: str = "ferry_write",
) -> int:
    """K1: dynamic-overwrite the partitions present in ``df``; returns rows written.

    The row count comes from an ``Observation`` on the write itself, so the
    data is not read a second time to count it.
    """
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(path)
    return int(obs.get.get("rows", 0) or 0)


def drop_partition(spark: SparkSession, path: str, values: Mapping[str, str]) -> bool:
    """Remove one partition directory (an empty rerun must not leave old rows)."""
    sub = "/".join(f"{k}={check_partition_value(v)}" for k, v in values.items())
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{sub}")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(target) and fs.delete(target, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


SCHEMA_DIR = "_ferry_schema"  # "_" prefix: skipped by Spark's file listing


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def save_schema(spark: SparkSession, path: str, payload: StructType) -> None:
    """Store the payload schema beside the table (one small JSON file).

    Written before the data of a load, so it is always a superset of the
    stored types; the next load reads it instead of merging every footer.
    Written to a temporary name and renamed, so a reader never sees half a file.
    """
    jvm, target, fs = _fs(spark, f"{path.rstrip('/')}/{SCHEMA_DIR}/schema.json")
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{SCHEMA_DIR}/.schema-{uuid.uuid4().hex}.json")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(payload.json().encode("utf-8")))
    finally:
        out.close()
    # FileContext renames over the old file in one step where the store can
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(tmp), fs.makeQualified(target), _overwrite(spark))


def _overwrite(spark: SparkSession):
    sc = spark.sparkContext
    options = sc._gateway.new_array(sc._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = sc._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    return options


def load_schema(spark: SparkSession, path: str) -> StructType | None:
    jvm, target, fs = _fs(spark, f"{path.rstrip('/')}/{SCHEMA_DIR}/schema.json")
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return StructType.fromJson(json.loads(text))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a landed table with the schema stored beside it; without one, by merging every file's.

    The payload type comes from the stored schema (a superset of all loads'),
    so no footer is opened before the scan.
    """
    payload = load_schema(spark, path)
    if payload is None:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(table_schema(payload)).parquet(path)


def table_schema(payload: StructType) -> StructType:
    """The landed table's columns, around a payload type."""
    names = [("surrogate_key_id", "string"), ("created_by", "string"), ("created_timestamp", "timestamp"), ("updated_by", "string"),
             ("updated_timestamp", "timestamp"), ("data_payload", payload), ("page", "long"), ("pos", "long"),
             ("source_id", "string"), ("load_id", "string")]
    out = StructType()
    for name, kind in names:
        out = out.add(name, kind)
    return out


def register_table(spark: SparkSession, path: str, name: str) -> None:
    """K1: make the landed table readable as catalog table ``name`` (external, with all its partitions).

    The entry is made anew only when the stored schema has changed.
    """
    payload = load_schema(spark, path)
    if payload is None:
        return
    schema = table_schema(payload)
    if spark.catalog.tableExists(name) and {f.name: f.dataType for f in spark.table(name).schema} != {f.name: f.dataType for f in schema}:
        spark.sql(f"DROP TABLE {name}")  # external: the data stays
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString() if f.name != 'data_payload' else _ddl(f.dataType)}" for f in schema)
    by = ", ".join(PARTITION_COLUMNS)
    where = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY ({by}) LOCATION '{where}'")
    spark.catalog.recoverPartitions(name)


def _ddl(kind: DataType) -> str:
    """A type as DDL with every field name quoted."""
    if isinstance(kind, StructType):
        return "struct<" + ", ".join(f"`{f.name.replace('`', '``')}`: {_ddl(f.dataType)}" for f in kind) + ">"
    if isinstance(kind, ArrayType):
        return f"array<{_ddl(kind.elementType)}>"
    return kind.simpleString()


def define_view(df: DataFrame, name: str) -> DataFrame:
    """K5: register a view; it is recomputed each time it is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def materialize(df: DataFrame, target: str, mode: str = "overwrite") -> None:
    """K4: write the result of a view query as a table (catalog name or path)."""
    if "/" in target:
        df.write.mode(mode).parquet(target)
    else:
        df.write.mode(mode).saveAsTable(target)
