"""Page plans: which slices of a paged source to read.

A plan is a DataFrame with one row per request. The driver never loops over
pages; the fetch runs as one Spark task per plan partition.

Semantics (0-based ``page``):
  limit-offset    offset = page * size, limit = least(size, total - offset)
  pageindex-size  pageIndex = page + 1 (1-based), pageSize = size
  unpaged         a single request, page 0
The number of pages is ceil(total / size); a total of 0 plans nothing and an
exact multiple of the size plans no trailing empty page.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LIMIT_OFFSET = "limit-offset"
PAGE_INDEX = "pageindex-size"

# pages per chunk when a per-key plan is expanded in two levels
_FANOUT = 4096


def page_count(total: int, size: int) -> int:
    """A2: ceil(total / size), for driver-side scalars."""
    if size < 1:
        raise ValueError("page size must be at least 1")
    return 0 if total <= 0 else -(-int(total) // int(size))


def n_pages_col(total: Column, size: int) -> Column:
    """A2 as a column: ceil(total / size) with integer arithmetic."""
    return F.when(total > 0, F.floor((total + F.lit(size - 1)) / F.lit(size))).otherwise(F.lit(0)).cast("bigint")


def request_columns(page: Column, total: Column, size: int, kind: str | None) -> list[Column]:
    """The request fields of a page: offset/limit, pageIndex/pageSize, or none."""
    if kind == LIMIT_OFFSET:
        offset = page * F.lit(size)
        return [offset.alias("offset"), F.least(F.lit(size).cast("bigint"), total - offset).alias("limit")]
    if kind == PAGE_INDEX:
        return [(page + 1).alias("pageIndex"), F.lit(size).cast("bigint").alias("pageSize")]
    if kind is None:
        return []
    raise ValueError(f"unknown pagination type {kind!r}")


def plan_pages(
    spark: SparkSession,
    total: int,
    size: int | None,
    kind: str | None,
    first_page: int = 0,
    num_partitions: int | None = None,
    end_page: int | None = None,
) -> DataFrame:
    """P1/P2/P5 for one source whose total is known on the driver (a scalar).

    Pages ``[first_page, end_page)`` (default: to the last page). ``spark.range``
    spreads exactly those pages over ``num_partitions`` tasks (default: the
    cluster's cores) without a shuffle, so the fetch that follows is parallel
    from the first stage.
    """
    if kind is None:
        return spark.range(0, 1, 1, 1).select(F.col("id").alias("page"), F.lit(True).alias("is_last"))
    n = page_count(total, size)
    lo = max(first_page, 0)
    hi = n if end_page is None else min(end_page, n)
    parts = num_partitions or max(1, min(hi - lo, spark.sparkContext.defaultParallelism))
    page = F.col("id")
    return spark.range(lo, max(hi, lo), 1, max(parts, 1)).select(
        page.alias("page"),
        *request_columns(page, F.lit(int(total)).cast("bigint"), size, kind),
        (page == F.lit(n - 1)).alias("is_last"),
    )


def expand_plan(
    totals: DataFrame,
    size: int,
    kind: str | None,
    keys: Sequence[str] = (),
    total_col: str = "total",
    first_page: Column | int = 0,
) -> DataFrame:
    """P1/P2/P5 for many sources at once: one input row per source with its total.

    Pages are generated in two levels (chunks of pages, then pages) with a
    shuffle of the small chunk rows in between, so a source with a huge page
    count is not expanded by a single task.
    """
    total = F.col(total_col).cast("bigint")
    first = first_page if isinstance(first_page, Column) else F.lit(int(first_page))
    if kind is None:
        return totals.select(*keys, F.lit(0).cast("bigint").alias("page"), F.lit(True).alias("is_last"))
    n = n_pages_col(total, size)
    base = totals.select(*keys, total.alias("_total"), n.alias("_n"), F.greatest(first.cast("bigint"), F.lit(0)).alias("_first"))
    n_chunks = F.floor((F.col("_n") + F.lit(_FANOUT - 1)) / F.lit(_FANOUT))
    chunks = base.select(
        "*",
        F.explode(F.when(F.col("_n") > F.col("_first"), F.sequence(F.floor(F.col("_first") / _FANOUT), n_chunks - 1))).alias("_chunk"),
    ).repartition(*[F.col(k) for k in keys], F.col("_chunk"))
    lo = F.greatest(F.col("_chunk") * _FANOUT, F.col("_first"))
    hi = F.least((F.col("_chunk") + 1) * _FANOUT, F.col("_n")) - 1
    pages = chunks.select("*", F.explode(F.sequence(lo, hi)).alias("page"))
    page = F.col("page")
    return pages.select(
        *keys,
        page.cast("bigint").alias("page"),
        *request_columns(page, F.col("_total"), size, kind),
        (page == F.col("_n") - 1).alias("is_last"),
    )


def remaining_pages(plan: DataFrame, landed: DataFrame, keys: Sequence[str] = ("page",)) -> DataFrame:
    """The plan minus pages already landed (an anti join on the page key)."""
    return plan.join(landed.select(*keys).distinct(), list(keys), "left_anti")
