"""Streaming inbound runner (X1s).

Landed bodies arriving as parquet files ``(page, body)`` in a folder are read
with ``readStream``; each micro-batch goes through the same typed load as the
batch flow (extract -> infer/merge -> conform -> envelope -> write) under the
load id ``<prefix>-<batch id>``. The stream's checkpoint beside the table
replaces the page-resume logic: a restarted query redoes at
most the unfinished micro-batch, and because that batch rewrites only its own
load partition, the redo does not duplicate rows.

Every body is judged in its micro-batch, as the batch flow does when it lands
pages. One that does not parse, or lacks the record list, goes whole to the
stream's quarantine (``read_stream_quarantine``): with its status, the file and
the row in it that it came from, and the load id. Its partition is rewritten with
its batch, so a restart does not double it. ``on_bad_bodies="fail"`` stops the
stream after the batch's quarantine is written and before its good bodies are
loaded; the checkpoint then stays where it is.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ferry.config import ExchangeConfig
from ferry.functions.extract import OK, body_status, last_key_wins
from ferry.operators.sink import check_partition_value, drop_partition, path_exists
from ferry.sources.pages import BODY_SCHEMA

QUARANTINE = "page bigint, status string, file string, row bigint, body string, load_id string"


class BadBodies(RuntimeError):
    """A micro-batch holds bodies that cannot be read, and the stream is set to stop at them."""


def quarantine_location(table_path: str) -> str:
    return f"{table_path.rstrip('/')}_bad_bodies"


def read_stream_quarantine(spark: SparkSession, table_path: str) -> DataFrame:
    """The bodies that a stream into ``table_path`` could not read: ``page, status, file, row, body, load_id``."""
    path = quarantine_location(table_path)
    if not path_exists(spark, path):
        return spark.createDataFrame([], QUARANTINE)
    return spark.read.schema(QUARANTINE).parquet(path)


def _judged(batch: DataFrame, cfg: ExchangeConfig) -> DataFrame:
    status, _ = body_status(F.col("body"), cfg.data_field, cfg.response_format, cfg.soap, bool(cfg.namespace))
    with last_key_wins(batch.sparkSession):
        return batch.withColumn("status", status)


def quarantine_bad_bodies(batch: DataFrame, cfg: ExchangeConfig, table_path: str, load_id: str) -> int:
    """Write the batch's unreadable bodies to the quarantine partition of ``load_id``; returns how many there are."""
    spark = batch.sparkSession
    path, seen = quarantine_location(table_path), Observation("ferry_bad_bodies")
    bad = _judged(batch, cfg).filter(F.col("status") != OK)
    bad = bad.select("page", "status", "file", "row", "body", F.lit(check_partition_value(load_id)).alias("load_id"))
    bad = bad.observe(seen, F.count(F.lit(1)).alias("n"))
    bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(path)
    n = int(seen.get.get("n", 0) or 0)
    if not n:  # an earlier try of this batch may have read other files
        drop_partition(spark, path, {"load_id": load_id})
    return n


def ingest_landed_stream(
    spark: SparkSession,
    cfg: ExchangeConfig,
    source_dir: str,
    table_path: str,
    *,
    checkpoint_location: str | None = None,
    load_prefix: str = "stream",
    load_ts: str | None = None,
    user: str | None = None,
    ignore: Sequence[str] = (),
    quarantine_path: str | None = None,
    on_type_change: str = "fail",
    max_files_per_trigger: int | None = None,
    batch_partitions: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    on_bad_bodies: str = "quarantine",
):
    """Start the stream; with ``available_now`` it drains what is there and returns.

    Otherwise the running ``StreamingQuery`` is returned (triggered every
    ``processing_time``). ``checkpoint_location`` defaults to a folder beside
    the table, so a restarted stream goes on with the same batch ids. Each
    micro-batch is spread over ``batch_partitions`` tasks (default: one per core)
    before parsing, as a trigger may read one large file, which is one task.
    ``on_bad_bodies``: ``"quarantine"`` goes on without them, ``"fail"`` stops.
    """
    from ferry.flows import load_landed

    if on_bad_bodies not in ("quarantine", "fail"):
        raise ValueError("on_bad_bodies must be 'quarantine' or 'fail'")

    reader = spark.readStream.schema(BODY_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    stream = reader.parquet(source_dir).select(
        "page", "body", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        tasks = int(batch_partitions or batch.sparkSession.sparkContext.defaultParallelism)
        rows = batch.repartition(tasks, "file", "row")  # no two bodies have the same place
        load_id = f"{load_prefix}-{batch_id}"
        bad = quarantine_bad_bodies(rows, cfg, table_path, load_id)
        if bad and on_bad_bodies == "fail":
            raise BadBodies(f"{bad} bodies of {load_id} cannot be read; they are in {quarantine_location(table_path)}")
        # a body that cannot be read has no records to extract
        load_landed(batch.sparkSession, cfg, rows.select("page", "body"), table_path, load_id, load_ts, user, ignore,
                    quarantine_path=quarantine_path, on_type_change=on_type_change)

    ckpt = checkpoint_location or f"{table_path.rstrip('/')}_checkpoint/{load_prefix}"
    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", ckpt)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "1 minute").start()
