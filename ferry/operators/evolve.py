"""Type widening of a landed table (the "stored type never changes" rule).

Parquet files cannot hold one field as BIGINT in old files and DOUBLE in new
ones, so when a load brings a wider type (BIGINT -> DOUBLE, anything ->
STRING) the stored rows are rewritten once with the widened payload type:

  * the payload is rebuilt field by field (``reshape``), casting only where
    the type changed: integral -> DOUBLE, scalar -> STRING by cast, struct
    or array -> STRING as JSON text (the same text a new record would carry);
  * fields the old rows lack come back NULL;
  * the rewrite is one Spark job into a sibling folder, then the folders are
    swapped with two renames, so readers never see a half-written table.

This touches the whole table and is meant for rare drift events; a table
whose types drift often should be landed with those fields as STRING.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from ferry.operators.sink import PARTITION_COLUMNS, read_table, save_schema

PAYLOAD = "data_payload"


def reshape(col: Column, old: DataType, new: DataType) -> Column:
    """Rebuild ``col`` (of type ``old``) as type ``new`` without losing values."""
    if old == new:
        return col
    if isinstance(new, StringType):
        if isinstance(old, (StructType, ArrayType)):
            return F.to_json(col, {"ignoreNullFields": "true"})
        return col.cast("string")
    if isinstance(new, StructType) and isinstance(old, StructType):
        have = {f.name: f.dataType for f in old.fields}
        fields = [
            (reshape(col[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in new.fields
        ]
        return F.when(col.isNull(), F.lit(None).cast(new)).otherwise(F.struct(*fields))
    if isinstance(new, ArrayType) and isinstance(old, ArrayType):
        return F.transform(col, lambda x: reshape(x, old.elementType, new.elementType))
    return col.cast(new)


def widened(df: DataFrame, payload_type: StructType) -> DataFrame:
    """The table's rows with ``data_payload`` rebuilt as ``payload_type``."""
    old = df.schema[PAYLOAD].dataType
    cols = [reshape(F.col(PAYLOAD), old, payload_type).alias(PAYLOAD) if c == PAYLOAD else F.col(f"`{c}`") for c in df.columns]
    return df.select(*cols)


def widen_table(spark: SparkSession, path: str, payload_type: StructType) -> None:
    """Rewrite the table at ``path`` so its payload has ``payload_type``."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    tag = uuid.uuid4().hex[:12]
    base = path.rstrip("/")
    tmp, old = f"{base}.widen-{tag}", f"{base}.old-{tag}"
    widened(read_table(spark, base), payload_type).write.partitionBy(*PARTITION_COLUMNS).parquet(tmp)
    save_schema(spark, tmp, payload_type)  # moves with the data in the swap below
    P = jvm.org.apache.hadoop.fs.Path
    fs = P(base).getFileSystem(conf)
    if not fs.rename(P(base), P(old)):
        raise RuntimeError(f"could not move {base} aside")
    if not fs.rename(P(tmp), P(base)):
        fs.rename(P(old), P(base))
        raise RuntimeError(f"could not move the widened table into {base}")
    fs.delete(P(old), True)
