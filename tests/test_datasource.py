import glob
import json
import os

from ferry.sources.datasource import register_batch_sink, register_page_source
from tests.fakeapi import FakeApi, Recorder


def test_page_source_reads_every_page(spark):
    recs = [{"id": i} for i in range(250)]
    register_page_source(spark, FakeApi(recs), "test_pages")
    df = spark.read.format("test_pages").option("total", 250).option("page_size", 100).option("max_partitions", 2).load()
    rows = sorted(df.collect())
    assert [r.page for r in rows] == [0, 1, 2]
    ids = [x["id"] for r in rows for x in json.loads(r.body)["data"]["items"]]
    assert ids == list(range(250))
    assert df.rdd.getNumPartitions() == 2
    resumed = spark.read.format("test_pages").option("total", 250).option("page_size", 100).option("first_page", 2).load()
    assert [r.page for r in resumed.collect()] == [2]


def test_batch_sink_sends_every_row(spark, tmp):
    register_batch_sink(spark, Recorder(tmp), "test_send")
    df = spark.createDataFrame([(i, 1, f'[{{"k": {i}}}]') for i in range(1, 8)], "batch_num long, n long, body string")
    df.write.format("test_send").mode("append").save()
    sent = sorted(int(os.path.basename(p).split("-")[1]) for p in glob.glob(f"{tmp}/batch-*"))
    assert sent == list(range(1, 8))
