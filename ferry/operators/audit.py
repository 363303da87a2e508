"""Append-only run audit (M1-M4).

Every run appends a ``Started`` row and, at the end, a ``Success`` or
``Failed`` row with its counters. The state of a (source, destination) pair
is its latest row, whatever the status. Nothing is updated in place.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ferry.operators.sink import path_exists

AUDIT_SCHEMA = StructType(
    [
        StructField("audit_id", StringType()),
        StructField("source_id", StringType()),
        StructField("destination_id", StringType()),
        StructField("status", StringType()),
        StructField("event_ts", TimestampType()),
        StructField("last_checkpoint", TimestampType()),
        StructField("source_count", LongType()),
        StructField("total_obj_count", LongType()),
        StructField("loaded_obj_count", LongType()),
        StructField("target_count", LongType()),
    ]
)
KEY = ("source_id", "destination_id")
# Run states.
STARTED, SUCCESS, FAILED = "Started", "Success", "Failed"


def latest_runs(audit: DataFrame, key=KEY, ts_col: str = "event_ts") -> DataFrame:
    """M2: the latest row per key, success or failure alike.

    ``max_by`` over a struct is a partial aggregate: one row per key per task
    before the shuffle, so a key with most of the rows is not a hot spot.
    Ties on the timestamp are broken by audit_id and status; a started run
    ranks below an ended one.
    """
    cols = [c for c in audit.columns if c not in key]
    row = F.struct(*[F.col(c) for c in cols])
    order = F.struct(F.col(ts_col), F.col("audit_id"), F.col("status") != STARTED, F.col("status"))
    return audit.groupBy(*key).agg(F.max_by(row, order).alias("_r")).select(*key, "_r.*")


@dataclass
class RunRecord:
    audit_id: str
    source_id: str
    destination_id: str
    loaded_obj_count: int
    last_checkpoint: datetime | None
    resumed: bool
    started_at: datetime | None = None


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def _append(spark: SparkSession, path: str, row: tuple) -> None:
    # by source, so opening a run does not scan the rows of all others (a destination may be empty, which no folder name can tell)
    spark.createDataFrame([row], AUDIT_SCHEMA).coalesce(1).write.mode("append").partitionBy("source_id").parquet(path)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _aware(t: datetime | None) -> datetime | None:
    """A collected timestamp (naive, in the driver's zone) as a time with a zone."""
    return t.astimezone(timezone.utc) if t is not None else None


class RunInProgress(RuntimeError):
    """Another run of the pair holds its claim."""


def _claim_path(path: str, source_id: str, destination_id: str) -> str:
    name = hashlib.sha256(f"{source_id}\n{destination_id}".encode()).hexdigest()[:32]
    return f"{path.rstrip('/')}/_claims/{name}"  # "_": skipped by Spark's file listing


@contextmanager
def claim(spark: SparkSession, path: str, source_id: str, destination_id: str, seconds: int) -> Iterator[None]:
    """Hold the only claim on a (source, destination) pair.

    A claim is a file that the store creates only if it is not there, so of two
    runs that start at once one gets it. The file's time tells its age: a claim of
    ``seconds`` is over, as its holder must have died. It is then renamed
    away, which also only one run can do, before a new one is made.
    """
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(_claim_path(path, source_id, destination_id))
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    holder = uuid.uuid4().hex

    def take() -> bool:
        try:
            out = fs.create(target, False)
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        try:
            out.write(bytearray(holder.encode()))
        finally:
            out.close()
        return True

    def holder_now() -> str | None:
        try:
            stream = fs.open(target)
        except Py4JJavaError:
            return None
        try:
            return sc._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    if not take():
        age = time.time() - fs.getFileStatus(target).getModificationTime() / 1000 if fs.exists(target) else seconds
        gone = sc._jvm.org.apache.hadoop.fs.Path(f"{target.toString()}.over-{holder}")
        if age < seconds or fs.exists(target) and not fs.rename(target, gone) or not take():
            raise RunInProgress(f"another run of {source_id!r} to {destination_id!r} is in progress")
        fs.delete(gone, False)
    try:
        yield
    finally:
        if holder_now() == holder:  # not a later run's, after this one's time was over
            fs.delete(target, False)


def open_run(spark: SparkSession, path: str, source_id: str, destination_id: str, now: datetime | None = None) -> RunRecord:
    """M1: resume the latest unfinished run of the pair, or start a new one."""
    now = now or _now()
    prev = (
        latest_runs(read_audit(spark, path).filter((F.col("source_id") == source_id) & (F.col("destination_id") == destination_id)))
        .collect()
    )
    if prev and prev[0]["status"] in (STARTED, FAILED):
        p = prev[0]
        rec = RunRecord(p["audit_id"], source_id, destination_id, int(p["loaded_obj_count"] or 0), _aware(p["last_checkpoint"]), True, now)
    else:
        last = _aware(prev[0]["last_checkpoint"]) if prev else None
        rec = RunRecord(uuid.uuid4().hex, source_id, destination_id, 0, last, False, now)
    _append(spark, path, (rec.audit_id, source_id, destination_id, STARTED, now, rec.last_checkpoint, None, None, rec.loaded_obj_count, None))
    return rec


def close_run(
    spark: SparkSession,
    path: str,
    run: RunRecord,
    status: str,
    source_count: int,
    total_obj_count: int,
    loaded_obj_count: int,
    target_count: int,
    checkpoint: datetime | None = None,
    now: datetime | None = None,
) -> None:
    """M3: append the closing row with the run's counters.

    A successful run moves the checkpoint to ``checkpoint`` or, by default, to
    the time the run started, so rows that arrive during a run are read by
    the next one; a failed run keeps the previous checkpoint.
    """
    if status not in (SUCCESS, FAILED):
        raise ValueError(f"status must be {SUCCESS} or {FAILED}")
    ckpt = (checkpoint or run.started_at) if status == SUCCESS else run.last_checkpoint
    _append(
        spark,
        path,
        (run.audit_id, run.source_id, run.destination_id, status, now or _now(), ckpt,
         int(source_count), int(total_obj_count), int(loaded_obj_count), int(target_count)),
    )


def reconcile(planned: DataFrame, landed: DataFrame, keys=("page",)) -> DataFrame:
    """M4: planned vs landed record counts per page (full outer join).

    ``planned`` has ``keys`` + ``planned``; ``landed`` has ``keys`` + ``landed``.
    """
    j = planned.join(landed, list(keys), "full_outer")
    p, l = F.col("planned"), F.col("landed")
    status = (
        F.when(l.isNull(), F.lit("missing"))
        .when(p.isNull(), F.lit("unplanned"))
        .when(p == l, F.lit("ok"))
        .when(l < p, F.lit("short"))
        .otherwise(F.lit("extra"))
    )
    return j.select(*keys, p.alias("planned"), l.alias("landed"), status.alias("status"))
