"""Outbound delivery (K11) and resume.

``send(batch_num, body)`` is the user's transport; it runs on the executors,
one Arrow batch of request bodies at a time. A failure of one request is
recorded (``ok = False`` with the error text) instead of failing the task, so
the delivery log says exactly which batches went out; a rerun sends only the
batches not yet delivered. Task retries after a lost executor can repeat a
``send``: delivery is at-least-once and ``batch_num`` is the idempotency key
to pass to the receiving API.
"""

from __future__ import annotations

import hashlib
from concurrent.futures import ThreadPoolExecutor
from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELIVERY_SCHEMA = "batch_num bigint, n bigint, ok boolean, error string, body_sha256 string"
#: Requests that one task sends before it passes their results on.
SLICE = 16


def deliver(
    batches: DataFrame,
    send: Callable[[int, str], object],
    body_col: str = "body",
    parallelism: int | None = None,
    concurrency: int = 1,
) -> DataFrame:
    """Run ``send`` for every batch; returns ``(batch_num, n, ok, error, body_sha256)`` lazily.

    ``parallelism`` caps the number of tasks (rate limits) by repartitioning;
    ``concurrency`` sends that many requests at a time inside each task.
    """
    src = batches.select("batch_num", "n", F.col(body_col).alias("body"))
    if parallelism:
        src = src.repartition(int(parallelism), "batch_num")
    workers = max(1, int(concurrency))

    def one(item: tuple) -> tuple[bool, str | None]:
        b, body = item
        try:
            send(int(b), body)
            return True, None
        except Exception as e:  # recorded per batch, see module doc
            return False, f"{type(e).__name__}: {e}"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = ThreadPoolExecutor(workers) if workers > 1 else None
        try:
            for whole in frames:
                for lo in range(0, len(whole), max(SLICE, workers)):
                    pdf = whole.iloc[lo:lo + max(SLICE, workers)].reset_index(drop=True)
                    items = list(zip(pdf["batch_num"], pdf["body"]))
                    res = list(pool.map(one, items)) if pool else [one(i) for i in items]
                    yield pd.DataFrame({
                        "batch_num": pdf["batch_num"], "n": pdf["n"],
                        "ok": [r[0] for r in res], "error": pd.Series([r[1] for r in res], dtype=object),
                        "body_sha256": [hashlib.sha256(b.encode()).hexdigest() for _, b in items],
                    })
        finally:
            if pool:
                pool.shutdown()

    return src.mapInPandas(run, DELIVERY_SCHEMA)


def pending_batches(batches: DataFrame, delivered: DataFrame | None) -> DataFrame:
    """Batches without a successful delivery in the log."""
    if delivered is None:
        return batches
    done = delivered.filter(F.col("ok")).select("batch_num").distinct()
    return batches.join(done, "batch_num", "left_anti")
