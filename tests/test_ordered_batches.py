"""Batches made with one shuffle of the rows: the same ones as by the global index."""

import pathlib
import re

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from ferry import flows
from ferry.config import ExchangeConfig
from ferry.operators import chunking
from tests.conftest import SF
from tests.test_invariants import SLOW
from tests.test_plans import plan


def items(batches):
    return [(b.batch_num, b.n, b.first_rn, b["items"]) for b in batches.orderBy("batch_num").collect()]


def test_same_batches_as_by_the_index(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for order, unique in ((["o_orderkey"], True), (["o_custkey"], False), (["o_orderstatus", "o_orderdate"], False)):
        one, total = chunking.ordered_batches(orders, order, 37, unique, n_blocks=5)
        two = chunking.collect_batches(chunking.global_index(orders, order, unique), 37)
        assert total == orders.count() and items(one) == items(two)


def test_whole_rows_are_shuffled_once(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    batches, _ = chunking.ordered_batches(orders, ["o_orderkey"], 50, unique=True, n_blocks=6)
    main = plan(batches).split("Subqueries")[0]
    assert len(re.findall(r"^\(\d+\) Exchange$", main, re.M)) == 1
    assert "shufflepartitionidpassthrough" in main.lower() and "SinglePartition" not in main


@SLOW
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["a", "b", None])), max_size=80),
       size=st.integers(1, 20), blocks=st.integers(1, 7))
def test_equal_rows_and_nulls(spark, rows, size, blocks):
    df = spark.createDataFrame(rows, "_key int, `_row` string")  # names of its own columns may clash
    batches, total = chunking.ordered_batches(df, ["_key"], size, n_blocks=blocks)
    got = items(batches)
    assert total == len(rows) and [g[0] for g in got] == list(range(1, -(-total // size) + 1))
    assert all(g[1] == size == len(g[3]) for g in got[:-1])
    flat = [(x["_key"], x["_row"]) for g in got for x in g[3]]
    assert sorted(flat, key=repr) == sorted(rows, key=repr)
    keys = [-1 if k is None else k for k, _ in flat]
    assert keys == sorted(keys)


def test_one_key_in_all_rows_is_spread(spark):
    df = spark.range(4000).select(F.lit("x").alias("k"), F.lit(1).alias("v"))
    batches, _ = chunking.ordered_batches(df, ["k"], 10, n_blocks=8)
    assert batches.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] == 500


def test_size_must_be_positive(spark):
    with pytest.raises(ValueError):
        chunking.ordered_batches(spark.range(3).toDF("k"), ["k"], 0)


def test_outbound_flow_in_one_shuffle(spark, tmp):
    cfg = ExchangeConfig(source_id="s", destination_id="d", dataflow="Outbound", api_dataformat="array_dict", api_limit=40,
                         source_query="SELECT * FROM outbound_rows")
    spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_orderdate").createOrReplaceTempView("outbound_rows")
    bodies = []
    for one_shuffle in (True, False):
        root = f"{tmp}/{one_shuffle}"
        res = flows.run_outbound(spark, cfg, lambda n, body: None, audit_path=f"{root}/audit", delivery_path=f"{root}/log",
                                 order_by=["o_orderdate"], one_shuffle=one_shuffle)
        assert res.loaded_obj_count == res.total_obj_count
        log = spark.read.parquet(f"{root}/log").orderBy("batch_num")
        bodies.append([(r.batch_num, r.n, r.body_sha256) for r in log.collect()])
        assert not list(pathlib.Path(root).glob("log_staged/*"))  # removed once the snapshot is written
    assert bodies[0] == bodies[1]
