"""Inbound (X1) throughput: the parallel flow against a serial page loop.

    python bench_inbound.py        (BENCH_SF_DIR, BENCH_CPUS, LATENCY_MS, SERIAL_PAGES)

A small load runs first to warm the JVM and Python workers. A page server stands in for the API: the ``orders`` table is paged into
100-record JSON bodies once (landed as parquet), and each request returns
one body after ``LATENCY_MS`` of simulated network time.

* parallel: ``run_inbound`` (count request, waves of parallel fetches with
  in-task concurrency, landing, inference, typed append), over every page;
* serial: one page at a time on the driver, each page turned into a
  DataFrame and appended, the way a driver-side loop would do it; run over
  the first ``SERIAL_PAGES`` pages only, since it is slow, and reported as a rate.

Prints one JSON line with rows/second for both.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ferry.config import ExchangeConfig  # noqa: E402
from ferry.flows import run_inbound  # noqa: E402
from ferry.session import local_session, scratch_path  # noqa: E402
from ferry.suite import orders_pages  # noqa: E402

_PAGES: dict = {}


class PageServer:
    """Serves the landed bodies by page; the table is read once per worker."""

    def __init__(self, path: str, total: int, latency: float):
        self.path, self.total, self.latency = path, total, latency

    def _bodies(self) -> dict:
        if self.path not in _PAGES:
            import pyarrow.parquet as pq

            t = pq.read_table(self.path, columns=["page", "body"]).to_pydict()
            _PAGES[self.path] = dict(zip(t["page"], t["body"]))
        return _PAGES[self.path]

    def __call__(self, req: dict) -> str:
        time.sleep(self.latency)
        if req.get("kind") == "count":
            return json.dumps({"total": self.total, "data": {"items": []}})
        return self._bodies()[int(req["offset"]) // 100]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    latency = float(os.environ.get("LATENCY_MS", "50")) / 1000
    serial_pages = int(os.environ.get("SERIAL_PAGES", "40"))
    spark = local_session(cpus, shuffle_partitions=int(cpus), app="ferry-bench-inbound")
    spark.sparkContext.setLogLevel("ERROR")
    server_path = os.path.join(tempfile.mkdtemp(prefix="ferry-pages-"), "pages.parquet")
    orders_pages(spark, sf_dir).coalesce(1).write.parquet(server_path)
    total = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    api = PageServer(server_path, total, latency)
    cfg = ExchangeConfig(source_id="orders", destination_id="lake", pagination_type="limit-offset", page_size=100,
                         data_field="data.items", count_field="total", df_limit=100_000)

    warm = scratch_path(spark, "bench-inbound-warm")  # JVM and Python workers start cold
    run_inbound(spark, cfg, PageServer(server_path, 30_000, latency), landing_path=f"{warm}/landing",
                table_path=f"{warm}/table", audit_path=f"{warm}/audit", load_ts="2024-01-01 00:00:00", user="bench",
                concurrency=4)
    root = scratch_path(spark, "bench-inbound")
    t0 = time.perf_counter()
    res = run_inbound(spark, cfg, api, landing_path=f"{root}/landing", table_path=f"{root}/table",
                      audit_path=f"{root}/audit", load_ts="2024-01-01 00:00:00", user="bench", concurrency=4)
    par = time.perf_counter() - t0

    out = f"{root}/serial"
    t0 = time.perf_counter()
    rows = 0
    for page in range(serial_pages):
        body = api({"kind": "page", "page": page, "offset": page * 100, "limit": 100})
        records = json.loads(body)["data"]["items"]
        spark.createDataFrame(records).write.mode("append").parquet(out)
        rows += len(records)
    ser = time.perf_counter() - t0

    print(json.dumps({
        "metric": "inbound_rows_per_sec", "unit": "rows/s", "sf": sf_dir.rsplit("sf", 1)[-1], "latency_ms": latency * 1000,
        "parallel": {"rows": res.target_count, "pages": res.total_obj_count, "sec": round(par, 2),
                     "rows_per_sec": round(res.target_count / par)},
        "serial": {"rows": rows, "pages": serial_pages, "sec": round(ser, 2), "rows_per_sec": round(rows / ser)},
        "speedup": round((res.target_count / par) / (rows / ser), 1),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
