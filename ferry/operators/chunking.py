"""Stable global row index and batches (K6).

``row_number().over(Window.orderBy(key))`` would move every row through one
task (``Exchange SinglePartition``). Instead:

  1. range-partition by the order key into ``n_blocks`` blocks and sort each
     block (``repartitionByRange`` + ``sortWithinPartitions``);
  2. ``checkpoint()`` to the shared checkpoint folder, which fixes block
     membership and in-block order even if executors are lost later;
  3. count rows per block (one partial-aggregate row per block), take the
     running sum of those counts and broadcast it back (one row per shuffle
     partition);
  4. index = block offset + position in block + 1.

Ties in the order key would make batches differ between reruns, so unless
the caller declares the key unique a tiebreak on the row's content is added
(two 64-bit hashes of the row, so no row text becomes a sort key).

``ordered_batches`` makes batches without a second shuffle of whole rows, for a
second sort of the keys (more CPU, less network): only the keys are indexed as above. The keys at which every n-th batch begins are the
edges of blocks that hold whole batches, all of one size however the keys are
spread. Rows go straight to their block, by a binary search among the edges, and
one shuffle serves the sort and the batches.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from ferry.session import ensure_checkpoint_dir, scratch_path


def _order_columns(df: DataFrame, order_by: Sequence[str | Column], unique: bool) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if not unique:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        cols += [F.xxhash64(row), F.xxhash64(F.lit("tie"), row)]
    return cols


def global_index_with_count(
    df: DataFrame,
    order_by: Sequence[str | Column],
    unique: bool = False,
    n_blocks: int | None = None,
    index_col: str = "rn",
) -> tuple[DataFrame, int]:
    """Add a 1-based ``index_col`` in ``order_by`` order; also return the row count.

    ``n_blocks`` defaults to the session's number of shuffle partitions, which
    is sized for the data; one count per block comes to the driver to form the
    offsets, which go back out as a broadcast of the same bounded size.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = int(n_blocks or spark.conf.get("spark.sql.shuffle.partitions"))
    if blocks < 1:
        raise ValueError("n_blocks must be at least 1")
    order = _order_columns(df, order_by, unique)
    fixed = df.repartitionByRange(blocks, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = fixed.select(
        "*",
        F.spark_partition_id().alias("_block"),
        (F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)).alias("_pos"),
    )
    counts = sorted((r["_block"], r["_n"]) for r in tagged.groupBy("_block").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, running = [], 0
    for block, n in counts:
        offsets.append((int(block), running))
        running += int(n)
    if not offsets:
        return tagged.drop("_block", "_pos").withColumn(index_col, F.lit(None).cast("bigint")), 0
    off_df = spark.createDataFrame(offsets, "_block int, _offset bigint")
    indexed = (
        tagged.join(F.broadcast(off_df), "_block")
        .withColumn(index_col, (F.col("_offset") + F.col("_pos") + 1).cast("bigint"))
        .drop("_block", "_pos", "_offset")
    )
    return indexed, running


def global_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    unique: bool = False,
    n_blocks: int | None = None,
    index_col: str = "rn",
) -> DataFrame:
    """Add a 1-based ``index_col`` that numbers rows in ``order_by`` order."""
    return global_index_with_count(df, order_by, unique, n_blocks, index_col)[0]


def batch_number(index: Column, size: int, start: int = 1) -> Column:
    """1-based index -> batch: floor((rn - 1) / size) + start."""
    if size < 1:
        raise ValueError("batch size must be at least 1")
    return (F.floor((index - 1) / F.lit(size)) + F.lit(start)).cast("bigint")


def collect_batches(
    indexed: DataFrame,
    size: int,
    payload_cols: Sequence[str] | None = None,
    start: int = 1,
    index_col: str = "rn",
) -> DataFrame:
    """``(batch_num, n, first_rn, items)``; items are the payload structs in index order.

    Each group holds at most ``size`` rows, so no task ever holds more than
    one batch per group, whatever the data size.
    """
    cols = list(payload_cols) if payload_cols is not None else [c for c in indexed.columns if c != index_col]
    item = F.struct(*[F.col(f"`{c}`") for c in cols])
    return _gather(indexed, [batch_number(F.col(index_col), size, start).alias("batch_num")], index_col, item)


def _gather(df: DataFrame, by: Sequence[Column], index_col: str, item: Column) -> DataFrame:
    grouped = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(index_col).alias("first_rn"),
        F.sort_array(F.collect_list(F.struct(F.col(index_col).alias("i"), item.alias("p")))).alias("_items"),
    )
    return grouped.select("batch_num", "n", "first_rn", F.transform("_items", lambda x: x["p"]).alias("items"))


def _in_blocks(rows: DataFrame, edges: Column, n: int, key: Column) -> DataFrame:
    """``rows`` with ``_block``, the place (from 0) of the last of ``n`` ascending ``edges`` that is not above ``key``.

    A binary search, a projection for each step; the first edge is the smallest key.
    """
    at = F.col("_block")
    rows = rows.withColumn("_block", F.lit(0))
    for step in (1 << i for i in reversed(range(n.bit_length()))):
        rows = rows.withColumn("_block", F.when(F.get(edges, at + step - 1) <= key, at + step).otherwise(at))
    return rows.withColumn("_block", at - 1)


def _plain(df: DataFrame, name: str) -> Column:
    """A column as a value of the same order that reaches the driver and comes back unchanged: times without a zone's rules."""
    kind, col = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, TimestampType):
        return F.unix_micros(col)
    return col.cast("string") if isinstance(kind, TimestampNTZType) else col


def ordered_batches(
    df: DataFrame,
    order_by: Sequence[str],
    size: int,
    unique: bool = False,
    n_blocks: int | None = None,
    start: int = 1,
    staged: str | None = None,
) -> tuple[DataFrame, int]:
    """``(batch_num, n, first_rn, items)`` as ``collect_batches`` over ``global_index`` gives, and the row count.

    ``order_by`` names columns, ascending. The rows are written once to the folder
    ``staged`` (by default below the scratch folder; the caller removes it when the
    batches have been used), so all passes see the same rows, and a row's place
    there tells equal rows apart: a key that many rows share is split as any other.
    """
    if size < 1:
        raise ValueError("batch size must be at least 1")
    spark = df.sparkSession
    staged = staged or scratch_path(spark, "batch-rows")
    ties = _order_columns(df, [], unique)
    order = [c.alias(f"k{i}") for i, c in enumerate([_plain(df, c) for c in order_by] + ties)]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.struct(*order).alias("_key"))
    rows.write.mode("overwrite").parquet(staged)
    names = [f"k{i}" for i in range(len(order))] + ["file", "row"]
    place = [F.xxhash64("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    keyed = spark.read.schema(rows.schema).parquet(staged).select("_row", "_key.*", *place)
    blocks = int(n_blocks or spark.conf.get("spark.sql.shuffle.partitions"))
    indexed, total = global_index_with_count(keyed.select(*names), names, unique=True, n_blocks=blocks)
    batches = -(-total // size)
    if not batches:
        empty = keyed.select(F.lit(0).cast("bigint").alias("rn"), "_row").filter(F.lit(False))
        return _gather(empty, [F.col("rn").alias("batch_num")], "rn", F.col("_row")), 0
    span = -(-batches // blocks) * size  # rows of a block: whole batches
    n = -(-total // span)
    key = F.struct(*names)
    found = indexed.filter((F.col("rn") - 1) % span == 0).select("rn", *names).collect()  # one a block
    kinds = [keyed.schema[c].dataType for c in names]
    edges = [F.struct(*[F.lit(e[c]).cast(k).alias(c) for c, k in zip(names, kinds)]) for e in sorted(found, key=lambda e: e["rn"])]
    same_type = keyed.select(F.array(key)).schema[0].dataType  # else every comparison would cast the array
    blocked = _in_blocks(keyed, F.array(*edges).cast(same_type), n, key)
    placed = blocked.repartitionById(n, F.col("_block")).sortWithinPartitions(*names)
    pos = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    placed = placed.select("_row", "_block", (F.col("_block").cast("bigint") * span + pos + 1).alias("rn"))
    return _gather(placed, [F.col("_block"), batch_number(F.col("rn"), size, start).alias("batch_num")], "rn", F.col("_row")), total
