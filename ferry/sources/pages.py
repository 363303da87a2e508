"""Paged response source (S3): fetch pages on executors and land the raw bodies.

``fetch(request) -> str`` is the user's transport. ``request`` is a plain
dict: ``{"kind": "page", "page": 3, "offset": 300, "limit": 100}`` for
limit/offset, ``{"kind": "page", "page": 3, "pageIndex": 4, "pageSize": 100}``
for page index, ``{"kind": "page", "page": 0}`` unpaged, and
``{"kind": "count"}`` for the count request. It runs inside
``mapInPandas``, one task per plan partition, so pages are fetched in
parallel; it must be picklable and create its client per call or per worker.

Landing zone: parquet at ``<landing>/source_id=<s>/load_id=<l>/`` with
``(page, body, status, n_records, wave, fetched_at)``. Each wave is one Spark
job and commits as a whole, so a failure costs at most one wave. A body that
does not parse, or lacks the record list, stays there with its status as
quarantine: it is never read as data and its page is not done. A page is done
once a body with all the records asked for has landed; those pages are the
resume point of the next run.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ferry.functions.extract import OK, body_status, last_key_wins
from ferry.operators.sink import check_partition_value, path_exists

BODY_SCHEMA = StructType([StructField("page", LongType()), StructField("body", StringType())])
LANDED_SCHEMA = StructType(
    [
        StructField("page", LongType()),
        StructField("body", StringType()),
        StructField("status", StringType()),
        StructField("n_records", LongType()),
        StructField("wave", LongType()),
        StructField("fetched_at", TimestampType()),
        StructField("source_id", StringType()),
        StructField("load_id", StringType()),
    ]
)


#: Requests whose bodies one task holds before it passes them on.
SLICE = 16


def _plain(v):
    if hasattr(v, "item"):
        return v.item()
    return v


def fetch_pages(
    plan: DataFrame,
    fetch: Callable[[dict], str | None],
    parallelism: int | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """Run ``fetch`` once per plan row on the executors -> ``(page, body)``.

    ``parallelism`` caps the number of tasks (rate limits) by repartitioning the
    plan; by default the plan's own partitioning is kept. ``concurrency`` runs
    that many requests at a time inside each task (requests wait on the
    network, not the CPU); results keep the plan's order.
    """
    cols = [c for c in plan.columns if c != "is_last"]
    src = plan.select(*cols)
    if parallelism:
        src = src.repartition(int(parallelism), "page")
    workers = max(1, int(concurrency))

    def one(rec: dict) -> str | None:
        req = {k: _plain(v) for k, v in rec.items()}
        req["kind"] = "page"
        return fetch(req)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(workers) if workers > 1 else None
        try:
            for whole in frames:
                for lo in range(0, len(whole), max(SLICE, workers)):  # few bodies are held at a time
                    pdf = whole.iloc[lo:lo + max(SLICE, workers)].reset_index(drop=True)
                    recs = pdf.to_dict("records")
                    bodies = list(pool.map(one, recs)) if pool else [one(r) for r in recs]
                    yield pd.DataFrame({"page": pdf["page"].astype("int64"), "body": pd.Series(bodies, dtype=object)})
        finally:
            if pool:
                pool.shutdown()

    return src.mapInPandas(run, BODY_SCHEMA)


def fetch_count(spark: SparkSession, fetch: Callable[[dict], str | None]) -> DataFrame:
    """The count request as a one-task job -> one ``(page = -1, body)`` row."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            yield pd.DataFrame({"page": pdf["id"].astype("int64") - 1, "body": [fetch({"kind": "count"}) for _ in range(len(pdf))]})

    return spark.range(0, 1, 1, 1).mapInPandas(run, BODY_SCHEMA)


def land(
    bodies: DataFrame,
    landing_path: str,
    source_id: str,
    load_id: str,
    wave: int,
    data_field: str | None = None,
    response_format: str = "json",
    soap: bool = False,
    prefixes: bool = False,
) -> None:
    """Append one wave of bodies, each with its parse status and record count, to the landing zone (one Spark job)."""
    status, n_records = body_status(F.col("body"), data_field, response_format, soap, prefixes)
    check_partition_value(source_id)
    check_partition_value(load_id)
    ts = datetime.now(timezone.utc)
    with last_key_wins(bodies.sparkSession):
        rows = bodies.select(
            F.col("page").cast("bigint"),
            F.col("body"),
            status.alias("status"),
            n_records.alias("n_records"),
            F.lit(int(wave)).cast("bigint").alias("wave"),
            F.lit(ts).cast("timestamp").alias("fetched_at"),
            F.lit(source_id).alias("source_id"),
            F.lit(load_id).alias("load_id"),
        )
    rows.write.mode("append").partitionBy("source_id", "load_id").parquet(landing_path)


def landed(spark: SparkSession, landing_path: str, source_id: str | None = None, load_id: str | None = None) -> DataFrame:
    """All landed rows, pruned to one source/load by partition filters."""
    if not path_exists(spark, landing_path):
        return spark.createDataFrame([], LANDED_SCHEMA)
    df = spark.read.schema(LANDED_SCHEMA).parquet(landing_path)
    if source_id is not None:
        df = df.filter(F.col("source_id") == source_id)
    if load_id is not None:
        df = df.filter(F.col("load_id") == load_id)
    return df


def landed_pages(spark: SparkSession, landing_path: str, source_id: str, load_id: str, wave: int | None = None,
                 since: datetime | None = None) -> DataFrame:
    """``page, n_records`` of the pages landed for a load, or in one wave of it, or since a time: their latest good body, the one that ``read_bodies`` reads."""
    good = landed(spark, landing_path, source_id, load_id).filter(F.col("status") == OK)
    if wave is not None:
        good = good.filter(F.col("wave") == wave)
    if since is not None:
        good = good.filter(F.col("fetched_at") >= F.lit(since))
    return good.groupBy("page").agg(F.max_by("n_records", F.struct("fetched_at", "wave")).alias("n_records"))


#: Bits of one page set bitmap, as Spark's bitmap functions make them.
BITMAP_BITS = 32768


def landed_sets(landed: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Landed ``page, n_records`` as ``(full, other)``: bitmaps of the pages of exactly ``size`` records, and the rows of the rest.

    ``full`` (``bucket, bitmap``) has one row of 4 KiB for 32,768 pages. A load has
    few other pages: its last one, and what came short or over-full.
    """
    at = F.col("page") + 1  # the functions count from 1
    is_full = F.col("n_records") == size
    full = landed.filter(is_full).groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap"))
    return full, landed.filter(~is_full)


def with_landed(plan: DataFrame, full: DataFrame, other: DataFrame, size: int) -> DataFrame:
    """``plan`` with ``landed``, the records that each page's landed body holds; null if there is none."""
    at = F.col("page") + 1
    bit = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("bitmap", (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (bit % 8).cast("int")) == 1
    keyed = plan.withColumn("bucket", F.bitmap_bucket_number(at)).join(full, "bucket", "left")
    rest = other.select("page", F.col("n_records").alias("_rest"))
    both = keyed.withColumn("_full", F.when(is_set, F.lit(size).cast("bigint"))).join(rest, "page", "left")
    return both.select(*plan.columns, F.coalesce("_rest", "_full").alias("landed"))


def bad_bodies(spark: SparkSession, landing_path: str, source_id: str, load_id: str) -> DataFrame:
    """The quarantined bodies of one load: ``page, status, wave, fetched_at, body``."""
    rows = landed(spark, landing_path, source_id, load_id).filter(F.col("status") != OK)
    return rows.select("page", "status", "wave", "fetched_at", "body")


def read_bodies(spark: SparkSession, landing_path: str, source_id: str, load_id: str, dedupe: bool = True) -> DataFrame:
    """The good landed bodies of one load, one row per page.

    A page lands twice if it was fetched again (a short page that has grown,
    two overlapping runs). Checking for that reads page ids only; the bodies
    are shuffled for the dedupe only when a duplicate exists (latest
    ``fetched_at``, then latest wave, wins).
    """
    df = landed(spark, landing_path, source_id, load_id).filter(F.col("status") == OK)
    if dedupe:
        stats = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("page").alias("d")).first()
        if stats["n"] != stats["d"]:
            w = Window.partitionBy("page").orderBy(F.col("fetched_at").desc(), F.col("wave").desc())
            df = df.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1).drop("_rk")
    return df.select("page", "body")
