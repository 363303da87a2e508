"""Contiguous shards of near-equal size (operator 9, native).

The rows are put in one global order (document id, then content), sorted by
range partitions. Each partition's total size gives the bytes that lie before
it; together with a running sum inside the partition every row knows the
bytes before it. The shard is the equal share of the total into which a row's
first byte falls, so a shard is a contiguous stretch of the order and differs
from its target by less than one row at each end. No task sees more than one
range partition, and only one row per partition is gathered for the totals.

Defined cases: a null text has size 1 and CRC 0; null ids come first in the
order; rows that repeat an id are ordered by content, and equal rows by their
place in the input; an empty table gives no rows; fewer rows than shards
leave shards empty. Columns other than id and text are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import written


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32``: UTF-8 bytes of the text plus one, and its unsigned CRC-32."""
    text = F.col(f"`{text_col}`")
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )


def byte_shards(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``: every row in one of ``n_shards`` stretches of near-equal bytes.

    ``slot`` numbers the rows of a shard from 0 in the global order.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be at least 1")
    order = ["doc_id", "text_crc32", "size", "_place"]
    # the texts are read once; what follows moves three numbers a row
    sizes = written(measure(docs, id_col, text_col).withColumn("_place", F.monotonically_increasing_id()), "shard-sizes")
    parts = written(
        sizes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()),
        "shard-order",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    offsets = totals.select(  # one row per range partition
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_bytes").over(Window.partitionBy()).alias("_total"),
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    running = parts.select(
        "*",
        (F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("_sum"),
        (F.row_number().over(inside) - 1).cast("bigint").alias("_index"),
    ).join(F.broadcast(offsets), "_part")
    placed = written(
        running.select(
            "doc_id", "size", "text_crc32",
            F.expr(f"CAST(({n_shards} * (_bytes_before + _sum)) div _total AS INT)").alias("shard"),
            (F.col("_rows_before") + F.col("_index")).alias("_rank"),
        ),
        "shard-placed",
    )
    firsts = placed.groupBy("shard").agg(F.min("_rank").alias("_first"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_rank") - F.col("_first")).alias("slot")
    )
