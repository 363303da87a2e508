"""Plan-shape checks: the properties the design relies on at scale, read from explain()."""

import contextlib
import io

from pyspark.sql import functions as F

from ferry import flows
from ferry.operators import audit, chunking
from ferry.sources import pages
from tests.conftest import SF


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_global_index_never_uses_a_single_partition(spark):
    df = spark.read.parquet(f"{SF}/orders.parquet")
    batches = chunking.collect_batches(chunking.global_index(df, ["o_orderkey"], unique=True), 100)
    text = plan(batches)
    assert "SinglePartition" not in text
    assert "BroadcastHashJoin" in text  # the bounded block-offset table is broadcast


def test_view_filter_is_pushed_to_the_scan(spark):
    text = plan(flows.view_to_table(spark, f"{SF}/events.parquet", "ev_plan", "value < 30"))
    assert "PushedFilters: [IsNotNull(value), LessThan(value,30.0)]" in text


def test_landed_read_prunes_partitions_and_columns(spark, tmp):
    bodies = spark.createDataFrame([(0, '{"a": 1}')], "page long, body string")
    pages.land(bodies, f"{tmp}/landing", "src", "L1", 0)
    pages.land(bodies, f"{tmp}/landing", "src", "L2", 0)
    text = plan(pages.read_bodies(spark, f"{tmp}/landing", "src", "L1", dedupe=False))
    assert "PartitionFilters" in text and "(load_id" in text and "= L1)" in text
    assert "ReadSchema: struct<page:bigint,body:string,status:string>" in text


def test_opening_a_run_reads_its_own_source_only(spark, tmp):
    for source in ("a", "b"):
        audit.close_run(spark, f"{tmp}/audit", audit.open_run(spark, f"{tmp}/audit", source, "d"), audit.SUCCESS, 1, 1, 1, 1)
    rows = audit.read_audit(spark, f"{tmp}/audit").filter((F.col("source_id") == "a") & (F.col("destination_id") == "d"))
    text = plan(audit.latest_runs(rows))
    assert "PartitionFilters" in text and "(source_id" in text and rows.count() == 2


def test_latest_per_key_aggregates_before_the_shuffle(spark):
    runs = spark.read.parquet(f"{SF}/events.parquet").select(
        F.col("event_id").cast("string").alias("audit_id"), F.col("user_id").cast("string").alias("source_id"),
        F.col("event_type").alias("destination_id"), F.lit("Success").alias("status"), F.col("ts").alias("event_ts"),
    )
    text = plan(audit.latest_runs(runs))
    assert "partial_max_by" in text
