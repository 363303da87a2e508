"""Property tests for the invariants of SURVEY section 5 (plans, batches, keys)."""

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ferry.functions import envelope as env
from ferry.operators import chunking
from ferry.plans import paging

SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@SLOW
@given(total=st.integers(0, 700), size=st.integers(1, 120), first=st.integers(0, 10))
def test_offset_plan_tiles_exactly(spark, total, size, first):
    rows = paging.plan_pages(spark, total, size, paging.LIMIT_OFFSET, first_page=first).orderBy("page").collect()
    n = paging.page_count(total, size)
    assert [r.page for r in rows] == list(range(min(first, n), n))
    covered = [i for r in rows for i in range(r.offset, r.offset + r.limit)]
    assert covered == list(range(min(first, n) * size, total))  # no gap, no overlap
    assert all(1 <= r.limit <= size for r in rows)
    assert all(r.limit == size for r in rows[:-1])


@SLOW
@given(n=st.integers(1, 400), size=st.integers(1, 60), blocks=st.integers(1, 9))
def test_batches_cover_rows_once(spark, n, size, blocks):
    df = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), (F.col("id") % 3).alias("g"))
    batches = chunking.collect_batches(chunking.global_index(df, ["g"], n_blocks=blocks), size).orderBy("batch_num").collect()
    sizes = [b.n for b in batches]
    assert sum(sizes) == n and [b.batch_num for b in batches] == list(range(1, len(batches) + 1))
    assert all(s == size for s in sizes[:-1]) and 1 <= sizes[-1] <= size
    keys = [x.k for b in batches for x in b["items"]]
    assert sorted(keys) == list(range(n))  # every row in exactly one batch
    gs = [x.g for b in batches for x in b["items"]]
    assert gs == sorted(gs)  # batches follow the order key


@SLOW
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", ""])), min_size=1, max_size=60))
def test_surrogate_keys_unique(spark, rows):
    df = spark.createDataFrame([(i // 10, i % 10, v, s) for i, (v, s) in enumerate(rows)], "page long, pos long, v int, s string")
    keys = [r.surrogate_key_id for r in env.envelope(df, "src", "L", "2024-01-01 00:00:00", "u").collect()]
    assert len(set(keys)) == len(rows)
