"""Python Data Source connectors for the user's transport (S3 / K11, optional).

The same work as ``fetch_pages`` and ``deliver``, exposed through Spark's
reader and writer API:

    register_page_source(spark, fetch)             # once per session
    bodies = (spark.read.format("ferry_pages")
              .option("total", 25_000).option("page_size", 100)
              .option("pagination", "limit-offset").load())   # (page, body)

    register_batch_sink(spark, send)
    batches.write.format("ferry_send").mode("append").save()  # (batch_num, body)

The reader plans one input partition per contiguous range of pages; at most
``max_partitions`` ranges are planned, so the driver holds a bounded list
whatever the page count. The writer calls ``send`` per row inside the write
task; a failed ``send`` fails the task (Spark retries it, then aborts the
job), so delivery is at-least-once. ``fetch`` and ``send`` travel with the
registered class to the executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ferry.plans.paging import LIMIT_OFFSET, PAGE_INDEX, page_count


@dataclass
class PageRange(InputPartition):
    first: int
    end: int  # exclusive


@dataclass
class SendReport(WriterCommitMessage):
    batches: int
    rows: int


def _request(kind: str | None, page: int, total: int, size: int) -> dict:
    if kind == LIMIT_OFFSET:
        return {"kind": "page", "page": page, "offset": page * size, "limit": min(size, total - page * size)}
    if kind == PAGE_INDEX:
        return {"kind": "page", "page": page, "pageIndex": page + 1, "pageSize": size}
    return {"kind": "page", "page": page}


def register_page_source(spark: SparkSession, fetch: Callable[[dict], str | None], name: str = "ferry_pages") -> str:
    """Register a reader that fetches pages with ``fetch``; returns the format name.

    Options: ``total`` (records), ``page_size``, ``pagination`` (``limit-offset``,
    ``pageindex-size`` or ``none``), ``first_page`` (resume point, default 0),
    ``max_partitions`` (default 4096).
    """

    class PageReader(DataSourceReader):
        def __init__(self, options: dict):
            self.kind = options.get("pagination", LIMIT_OFFSET)
            self.kind = None if self.kind == "none" else self.kind
            self.total = int(options.get("total", 0))
            self.size = int(options.get("page_size", 1))
            self.first = int(options.get("first_page", 0))
            self.max_parts = int(options.get("max_partitions", 4096))

        def partitions(self):
            n = 1 if self.kind is None else page_count(self.total, self.size)
            todo = max(n - self.first, 0)
            if todo == 0:
                return []
            per = -(-todo // min(todo, self.max_parts))
            return [PageRange(p, min(p + per, n)) for p in range(self.first, n, per)]

        def read(self, partition: PageRange) -> Iterator[tuple]:
            for page in range(partition.first, partition.end):
                yield page, fetch(_request(self.kind, page, self.total, self.size))

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return "page bigint, body string"

        def reader(self, schema):
            return PageReader(self.options)

    spark.dataSource.register(PageSource)
    return name


def register_batch_sink(spark: SparkSession, send: Callable[[int, str], object], name: str = "ferry_send") -> str:
    """Register a writer that hands every ``(batch_num, body)`` row to ``send``."""

    class SendWriter(DataSourceWriter):
        def write(self, iterator) -> SendReport:
            batches = rows = 0
            for row in iterator:
                send(int(row["batch_num"]), row["body"])
                batches += 1
                rows += int(row["n"]) if "n" in row else 1
            return SendReport(batches, rows)

        def commit(self, messages) -> None:  # nothing to publish: each send is final
            pass

        def abort(self, messages) -> None:
            pass

    class SendSink(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite: bool):
            return SendWriter()

    spark.dataSource.register(SendSink)
    return name
