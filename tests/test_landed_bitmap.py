"""Resume from page bitmaps: the same pages as by a join on page ids, and no earlier wave read again."""

from hypothesis import given, strategies as st
import pytest
from pyspark.sql import functions as F

from ferry import flows
from ferry.config import ExchangeConfig
from ferry.sources import pages
from tests.test_invariants import SLOW

CFG = {"source-id": "s", "destination-id": "d", "dataflow": "Inbound", "pagination-type": "limit-offset", "params": {"limit": 2},
       "response-format": "json", "data-field": "items", "df-limit": 6}


@SLOW
@given(landed=st.dictionaries(st.one_of(st.integers(0, 40), st.integers(32_760, 32_780), st.integers(65_530, 65_540)), st.integers(0, 4), max_size=60))
def test_bits_and_rest_give_back_every_page(spark, landed):
    rows = spark.createDataFrame(list(landed.items()), "page long, n_records long")
    full, other = pages.landed_sets(rows, 3)
    plan = spark.range(66_000).withColumnRenamed("id", "page").filter("page < 60 or page between 32750 and 32790 or page > 65500")
    got = {r.page: r.landed for r in pages.with_landed(plan, full, other, 3).collect()}
    assert len(got) == plan.count() and {p: n for p, n in got.items() if n is not None} == landed
    assert full.count() <= 3 and other.count() == sum(n != 3 for n in landed.values())


def serve(n, log, fail_at=None):
    def fetch(request):
        import json

        if request["kind"] == "count":
            return json.dumps({"total": n})
        with open(log, "a") as f:
            f.write(f"{request['page']}\n")
        if request["page"] == fail_at:
            raise RuntimeError("down")
        lo = request["offset"]
        return json.dumps({"items": [{"id": i} for i in range(lo, max(lo, min(lo + 2, n)))]})

    return fetch


def asked(log):
    with open(log) as f:
        return {int(x) for x in f}


@pytest.mark.parametrize("count", [True, False])
def test_a_resumed_run_asks_for_what_is_missing(spark, tmp, count):
    cfg = ExchangeConfig.from_dict({**CFG, **({"count-field": "total"} if count else {})})
    landing = f"{tmp}/landing"
    with pytest.raises(Exception, match="down"):
        flows.land_all_pages(spark, cfg, serve(29, f"{tmp}/one", fail_at=8), landing, "L1")
    done = {r.page for r in pages.landed_pages(spark, landing, "s", "L1").collect()}
    assert done and 8 not in done
    flows.land_all_pages(spark, cfg, serve(29, f"{tmp}/two"), landing, "L1")
    assert not asked(f"{tmp}/two") & done and {8, 14} <= asked(f"{tmp}/two")
    got = {r.page: r.n_records for r in pages.landed_pages(spark, landing, "s", "L1").filter("n_records > 0").collect()}
    assert got == {**{p: 2 for p in range(14)}, 14: 1}


def test_a_short_page_is_asked_for_again_once_the_source_has_grown(spark, tmp):
    cfg = ExchangeConfig.from_dict({**CFG, "count-field": "total"})
    flows.land_all_pages(spark, cfg, serve(5, f"{tmp}/one"), f"{tmp}/landing", "L1")
    flows.land_all_pages(spark, cfg, serve(8, f"{tmp}/two"), f"{tmp}/landing", "L1")
    assert asked(f"{tmp}/two") == {2, 3}


def test_a_wave_of_a_resumed_run_does_not_read_the_landing_zone(spark, tmp):
    rows = spark.createDataFrame([(p, 2) for p in range(100)], "page long, n_records long")
    rows.write.parquet(f"{tmp}/landed")
    full, other = (df.checkpoint() for df in pages.landed_sets(spark.read.parquet(f"{tmp}/landed"), 2))
    plan = pages.with_landed(spark.range(10).withColumnRenamed("id", "page"), full, other, 2)
    assert "FileScan" not in plan._jdf.queryExecution().executedPlan().toString() and plan.filter(F.col("landed") == 2).count() == 10
