"""A body is parsed once for each time its records are read."""

from pyspark.sql import functions as F

from ferry import flows
from ferry.config import ExchangeConfig
from ferry.functions import extract
from ferry.operators import sink
from ferry.streaming.ingest import ingest_landed_stream


def analyzed(df) -> str:
    return df._jdf.queryExecution().analyzed().toString()


def test_xml_body_is_parsed_once(spark):
    body = '<r xmlns:a="urn:a"><b><item id="07"><a:x>1</a:x></item><item/></b></r>'
    bodies = spark.createDataFrame([(1, body), (2, "<r/>"), (None, None)], "page long, body string")
    for prefixes in (False, True):
        for soap in (False, True):
            assert analyzed(extract.extract_records(bodies, "b.item", "xml", soap, prefixes=prefixes)).count("from_xml(") == 1
        assert analyzed(bodies.select(extract.body_status(F.col("body"), "b.item", "xml", prefixes=prefixes)[0].alias("s"))).count("from_xml(") == 1
        direct = extract.extract_records(bodies, "b.item", "xml", prefixes=prefixes)
        stored = extract.parsed_records(extract.parsed_bodies(bodies, "xml", prefixes=prefixes), "b.item", prefixes=prefixes)
        rows = [sorted((r[0], r[1], r[2]) for r in x.select("page", "pos", F.to_json("record")).collect()) for x in (direct, stored)]
        assert rows[0] == rows[1] and [r[:2] for r in rows[0]] == [(1, 0)] + [(1, 1)] * (len(rows[0]) - 1)


def test_reconciliation_reads_the_records_once(spark, tmp):
    cfg = ExchangeConfig("api", data_field="items")
    rows = [(1, '{"items": [{"a": 1}, {"a": 2}]}'), (2, '{"items": [{"a": 3}, 7]}'), (None, '{"items": [{"a": 4}, 8, 9]}'), (3, '{"items": [5]}')]
    bodies = spark.createDataFrame(rows, "page long, body string")
    flows.load_landed(spark, cfg, bodies, f"{tmp}/t", "l1", "2024-01-01 00:00:00", "u")
    found = flows.content_reconciliation(spark, cfg, bodies, f"{tmp}/t", "l1")
    assert analyzed(found).count("Generate posexplode") == 1
    got = sorted((tuple(r) for r in found.collect()), key=str)
    # rows without a page match nothing
    assert got == sorted([(1, 2, 0, 2, "ok"), (2, 1, 1, 1, "ok"), (3, 0, 1, 0, "ok"), (None, 1, 0, 0, "missing"), (None, 0, 2, 0, "ok"),
                          (None, 0, 0, 1, "unplanned")], key=str)


def test_a_trigger_of_one_file_is_spread(spark, tmp):
    cfg = ExchangeConfig("api", data_field="items")
    bodies = spark.range(200).select(F.col("id").alias("page"), F.format_string('{"items": [{"a": %d}]}', "id").alias("body"))
    bodies.coalesce(1).write.parquet(f"{tmp}/src")
    ingest_landed_stream(spark, cfg, f"{tmp}/src", f"{tmp}/t", load_prefix="s", load_ts="2024-01-01 00:00:00", user="u", max_files_per_trigger=1)
    rows = sink.read_table(spark, f"{tmp}/t")
    assert len(rows.inputFiles()) > 1  # one of each task
    assert sorted(r[0] for r in rows.select("data_payload.a").collect()) == list(range(200))
