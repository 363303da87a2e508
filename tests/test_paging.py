import pytest
from pyspark.sql import functions as F

from ferry.plans import paging


def _plan(spark, total, size, kind=paging.LIMIT_OFFSET, first=0):
    return [r.asDict() for r in paging.plan_pages(spark, total, size, kind, first_page=first).orderBy("page").collect()]


def _tiles(rows, total):
    covered = []
    for r in rows:
        covered += list(range(r["offset"], r["offset"] + r["limit"]))
    return covered == list(range(total))


@pytest.mark.parametrize("total,size", [(0, 100), (50, 100), (100, 100), (250, 100), (300, 100), (7, 1)])
def test_offset_plan_tiles_total(spark, total, size):
    rows = _plan(spark, total, size)
    assert len(rows) == paging.page_count(total, size)
    assert _tiles(rows, total)
    assert all(0 < r["limit"] <= size for r in rows)
    if rows:
        assert [r["is_last"] for r in rows] == [False] * (len(rows) - 1) + [True]


def test_offset_plan_example(spark):
    rows = _plan(spark, 250, 100)
    assert [(r["offset"], r["limit"]) for r in rows] == [(0, 100), (100, 100), (200, 50)]


def test_exact_multiple_has_no_empty_page(spark):
    rows = _plan(spark, 300, 100)
    assert [r["limit"] for r in rows] == [100, 100, 100]


def test_index_plan_is_one_based(spark):
    rows = _plan(spark, 250, 100, paging.PAGE_INDEX)
    assert [(r["pageIndex"], r["pageSize"]) for r in rows] == [(1, 100), (2, 100), (3, 100)]


@pytest.mark.parametrize("first,expect", [(0, [0, 1, 2]), (1, [1, 2]), (2, [2]), (3, []), (9, [])])
def test_resume_first_middle_last_past_end(spark, first, expect):
    assert [r["page"] for r in _plan(spark, 250, 100, first=first)] == expect


def test_unpaged_is_one_request(spark):
    rows = _plan(spark, 0, None, None)
    assert [r["page"] for r in rows] == [0]


def test_expand_plan_matches_scalar_plan(spark):
    totals = spark.createDataFrame([(1, 0), (2, 5), (3, 8), (4, 9)], "k int, total long")
    got = paging.expand_plan(totals, 4, paging.LIMIT_OFFSET, keys=["k"]).collect()
    by_key = {}
    for r in got:
        by_key.setdefault(r["k"], []).append((r["page"], r["offset"], r["limit"], r["is_last"]))
    assert 1 not in by_key
    assert sorted(by_key[2]) == [(0, 0, 4, False), (1, 4, 1, True)]
    assert sorted(by_key[3]) == [(0, 0, 4, False), (1, 4, 4, True)]
    assert sorted(by_key[4]) == [(0, 0, 4, False), (1, 4, 4, False), (2, 8, 1, True)]


def test_expand_plan_large_source_spans_chunks(spark):
    totals = spark.createDataFrame([(1, 4096 * 3 * 2 + 1)], "k int, total long")
    plan = paging.expand_plan(totals, 2, paging.PAGE_INDEX, keys=["k"])
    agg = plan.agg(F.count("*").alias("n"), F.countDistinct("page").alias("d"), F.max("pageIndex").alias("m")).first()
    assert agg["n"] == agg["d"] == 4096 * 3 + 1 == agg["m"]


def test_remaining_pages_anti_join(spark):
    plan = paging.plan_pages(spark, 500, 100, paging.LIMIT_OFFSET)
    landed = spark.createDataFrame([(0,), (2,), (2,)], "page long")
    assert sorted(r["page"] for r in paging.remaining_pages(plan, landed).collect()) == [1, 3, 4]


def test_wave_plan_is_spread_over_tasks(spark):
    plan = paging.plan_pages(spark, 10_000_000, 100, paging.LIMIT_OFFSET, first_page=5000, end_page=5016)
    assert plan.rdd.getNumPartitions() == min(16, spark.sparkContext.defaultParallelism)
    per_task = plan.rdd.glom().map(len).collect()
    assert sum(per_task) == 16 and max(per_task) - min(per_task) <= 1
