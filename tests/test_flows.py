import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from ferry import flows
from ferry.config import ExchangeConfig
from ferry.operators import audit, sink
from ferry.sources import pages
from tests.conftest import SF
from tests.fakeapi import FakeApi, Recorder

TS = "2024-01-01 00:00:00"


def _orders(spark):
    rows = spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").cast("string").alias("o_orderdate")
    ).orderBy("o_orderkey").collect()
    return [r.asDict() for r in rows]


def _paths(tmp):
    return dict(landing_path=f"{tmp}/landing", table_path=f"{tmp}/table", audit_path=f"{tmp}/audit")


def _cfg(**kw):
    base = dict(source_id="orders", destination_id="lake", pagination_type="limit-offset", page_size=100,
                data_field="data.items", count_field="total", df_limit=300)
    base.update(kw)
    return ExchangeConfig(**base)


def _table(spark, tmp):
    return sink.read_table(spark, f"{tmp}/table")


def test_inbound_loads_every_row_once(spark, tmp):
    recs = _orders(spark)
    res = flows.run_inbound(spark, _cfg(), FakeApi(recs, 100), load_ts=TS, user="u", **_paths(tmp))
    t = _table(spark, tmp)
    assert res.target_count == len(recs) == t.count()
    assert res.total_obj_count == 15 and res.loaded_obj_count == 15 and res.source_count == len(recs)
    got = sorted(r.o_orderkey for r in t.select("data_payload.o_orderkey").collect())
    assert got == [r["o_orderkey"] for r in recs]
    assert t.select("surrogate_key_id").distinct().count() == len(recs)
    latest = audit.latest_runs(audit.read_audit(spark, f"{tmp}/audit")).first()
    assert latest.status == "Success" and latest.target_count == len(recs)


def test_inbound_concurrent_fetch_and_reconcile(spark, tmp):
    recs = _orders(spark)
    cfg = _cfg()
    res = flows.run_inbound(spark, cfg, FakeApi(recs, 100), load_ts=TS, user="u", parallelism=3, concurrency=4, **_paths(tmp))
    assert res.target_count == len(recs)
    from ferry.plans import paging
    plan = paging.plan_pages(spark, len(recs), 100, "limit-offset")
    rec = flows.landed_reconciliation(spark, cfg, plan, f"{tmp}/table", res.load_id).collect()
    assert len(rec) == 15 and {r.status for r in rec} == {"ok"}


def test_inbound_page_index_and_unpaged(spark, tmp):
    recs = _orders(spark)[:250]
    flows.run_inbound(spark, _cfg(pagination_type="pageindex-size"), FakeApi(recs, 100), load_ts=TS, user="u", **_paths(tmp))
    assert _table(spark, tmp).count() == 250
    t2 = f"{tmp}/u"
    flows.run_inbound(spark, _cfg(pagination_type=None, page_size=None), FakeApi(recs[:7]), load_ts=TS, user="u",
                      landing_path=f"{t2}/landing", table_path=f"{t2}/table", audit_path=f"{t2}/audit")
    assert sink.read_table(spark, f"{t2}/table").count() == 7


def test_inbound_without_count_field_stops_on_short_page(spark, tmp):
    recs = _orders(spark)[:530]
    res = flows.run_inbound(spark, _cfg(count_field=None, df_limit=200), FakeApi(recs, 100, count_field=None),
                            load_ts=TS, user="u", **_paths(tmp))
    assert _table(spark, tmp).count() == 530
    # df-limit 200 is two pages a wave: the third wave ends in the short page
    assert res.loaded_obj_count == 6


def test_inbound_paged_xml_without_count_field(spark, tmp):
    recs = [{k: v for k, v in r.items() if k != "o_orderdate"} for r in _orders(spark)[:250]]
    cfg = _cfg(response_format="xml", data_field="item", count_field=None)
    res = flows.run_inbound(spark, cfg, FakeApi(recs, 100, fmt="xml"), load_ts=TS, user="u", **_paths(tmp))
    t = _table(spark, tmp)
    assert res.target_count == 250 == t.count()
    assert sorted(r.o_orderkey for r in t.select("data_payload.o_orderkey").collect()) == [r["o_orderkey"] for r in recs]


def test_failed_page_then_rerun_is_exactly_once(spark, tmp):
    recs = _orders(spark)
    marker = f"{tmp}/healed"
    api = FakeApi(recs, 50, fail_pages={20}, fail_marker=marker)
    cfg = _cfg(page_size=50, min_pages_per_task=4)
    assert cfg.wave_size(spark.sparkContext.defaultParallelism) == 6  # df-limit 300: waves 0-5, ..., 18-23, 24-29
    with pytest.raises(Exception):
        flows.run_inbound(spark, cfg, api, load_ts=TS, user="u", **_paths(tmp))
    first = audit.latest_runs(audit.read_audit(spark, f"{tmp}/audit")).first()
    assert first.status == "Failed" and first.loaded_obj_count == 18  # the first three waves stay landed
    open(marker, "w").close()
    res = flows.run_inbound(spark, cfg, api, load_ts=TS, user="u", **_paths(tmp))
    assert res.audit_id == first.audit_id  # the failed run is resumed, not restarted
    t = _table(spark, tmp)
    assert t.count() == len(recs) and t.select("data_payload.o_orderkey").distinct().count() == len(recs)
    # a page landed twice (overlapping runs) is read once
    pages.land(pages.fetch_pages(spark.range(0, 1).withColumnRenamed("id", "page").select(
        "page", F.lit(0).cast("bigint").alias("offset"), F.lit(100).cast("bigint").alias("limit")), api),
        f"{tmp}/landing", "orders", first.audit_id, 99)
    assert pages.landed(spark, f"{tmp}/landing", "orders", first.audit_id).count() == 31
    assert pages.read_bodies(spark, f"{tmp}/landing", "orders", first.audit_id).count() == 30


def test_rerun_of_a_load_replaces_it(spark, tmp):
    recs = _orders(spark)[:300]
    cfg = _cfg()
    bodies = spark.createDataFrame([(0, json.dumps({"data": {"items": recs}}))], "page long, body string")
    for _ in range(2):
        flows.load_landed(spark, cfg, bodies, f"{tmp}/table", "L1", TS, "u")
    flows.load_landed(spark, cfg, bodies, f"{tmp}/table", "L2", TS, "u")
    t = _table(spark, tmp)
    assert t.filter("load_id = 'L1'").count() == 300 and t.count() == 600
    empty = spark.createDataFrame([(0, json.dumps({"data": {"items": []}}))], "page long, body string")
    flows.load_landed(spark, cfg, empty, f"{tmp}/table", "L1", TS, "u")
    assert _table(spark, tmp).filter("load_id = 'L1'").count() == 0


def test_schema_evolution_and_audit(spark, tmp):
    cfg = _cfg()
    b1 = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": 1, "x": "a"}]}}))], "page long, body string")
    b2 = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": 2, "x": "b", "extra": {"y": 1}}]}}))], "page long, body string")
    flows.load_landed(spark, cfg, b1, f"{tmp}/table", "L1", TS, "u", schema_audit_path=f"{tmp}/sa")
    r2 = flows.load_landed(spark, cfg, b2, f"{tmp}/table", "L2", TS, "u", schema_audit_path=f"{tmp}/sa")
    assert ("extra", "struct<y:bigint>") in r2.diff["only_in_current"]
    assert sink.load_schema(spark, f"{tmp}/table") == r2.schema  # stored beside the table, read next time
    rows = {r.id: r.y for r in _table(spark, tmp).select("data_payload.id", "data_payload.extra.y").collect()}
    assert rows == {1: None, 2: 1}
    changes = spark.read.parquet(f"{tmp}/sa").filter("change = 'added'").select("field_path").collect()
    assert {r.field_path for r in changes} >= {"extra", "extra.y"}
    b3 = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": 2.5}]}}))], "page long, body string")
    with pytest.raises(flows.SchemaConflict):
        flows.load_landed(spark, cfg, b3, f"{tmp}/table", "L3", TS, "u")


def test_type_widening_rewrites_stored_rows(spark, tmp):
    cfg = _cfg()
    b1 = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": 1, "o": {"v": 1}, "tag": 5}]}}))], "page long, body string")
    b2 = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": 2.5, "o": {"v": 2, "w": "x"}, "tag": "t"}]}}))], "page long, body string")
    flows.load_landed(spark, cfg, b1, f"{tmp}/table", "L1", TS, "u")
    before = _table(spark, tmp).select("surrogate_key_id").first()[0]
    r = flows.load_landed(spark, cfg, b2, f"{tmp}/table", "L2", TS, "u", on_type_change="widen")
    assert ("id", "bigint", "double") in r.diff["type_changed"]
    t = _table(spark, tmp)
    assert t.schema["data_payload"].dataType.simpleString() == "struct<id:double,o:struct<v:bigint,w:string>,tag:string>"
    rows = {r.load_id: (r.id, r.v, r.w, r.tag) for r in t.select("load_id", "data_payload.id", "data_payload.o.v", "data_payload.o.w", "data_payload.tag").collect()}
    assert rows == {"L1": (1.0, 1, None, "5"), "L2": (2.5, 2, "x", "t")}
    assert t.filter("load_id = 'L1'").select("surrogate_key_id").first()[0] == before
    assert not [p for p in os.listdir(tmp) if ".widen-" in p or ".old-" in p]


def test_object_for_scalar_field_widens_to_string_not_quarantine(spark, tmp):
    cfg = _cfg()
    b1 = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": 1}]}}))], "page long, body string")
    flows.load_landed(spark, cfg, b1, f"{tmp}/table", "L1", TS, "u")
    b2 = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": {"z": 1}}, {"id": 3}]}}))], "page long, body string")
    with pytest.raises(flows.SchemaConflict):
        flows.load_landed(spark, cfg, b2, f"{tmp}/table", "L2", TS, "u")
    r = flows.load_landed(spark, cfg, b2, f"{tmp}/table", "L2", TS, "u", quarantine_path=f"{tmp}/q", on_type_change="widen")
    assert r.quarantined == 0 and r.target_count == 2
    assert sorted(x.id for x in _table(spark, tmp).select("data_payload.id").collect()) == ["1", "3", '{"z":1}']


def test_clean_rerun_clears_quarantine(spark, tmp):
    from ferry.operators import schema as sch

    cfg = _cfg()
    bad = spark.createDataFrame([(0, json.dumps({"data": {"items": [{"id": 1}]}}))], "page long, body string")
    # a quarantined row from an earlier attempt of load L1
    spark.createDataFrame([(0, 0, '{"id":"x"}', "L1")], "page long, pos long, record string, load_id string") \
        .write.partitionBy("load_id").parquet(f"{tmp}/q")
    r = flows.load_landed(spark, cfg, bad, f"{tmp}/table", "L1", TS, "u", quarantine_path=f"{tmp}/q")
    assert r.quarantined == 0
    assert not os.path.exists(f"{tmp}/q/load_id=L1")
    assert sch.CORRUPT == "_corrupt_record"


def _decoded(folder):
    out = []
    for p in sorted(glob.glob(f"{folder}/batch-*")):
        out.append((int(os.path.basename(p).split("-")[1]), open(p).read()))
    return out


@pytest.mark.parametrize("fmt", ["array_dict", "nested_json", "xml", "dict"])
def test_outbound_formats(spark, tmp, fmt):
    sent = f"{tmp}/sent"
    os.makedirs(sent)
    spark.read.parquet(f"{SF}/supplier.parquet").createOrReplaceTempView("supplier")
    cfg = ExchangeConfig(source_id="lake", destination_id="api", dataflow="Outbound", api_dataformat=fmt,
                         api_limit=3, source_query="SELECT s_suppkey, s_name FROM supplier")
    res = flows.run_outbound(spark, cfg, Recorder(sent), audit_path=f"{tmp}/audit", delivery_path=f"{tmp}/log",
                             order_by=["s_suppkey"], unique=True, concurrency=3)
    got = _decoded(sent)
    n = 10
    assert res.source_count == n and res.target_count == n
    if fmt == "dict":
        assert [b for b, _ in got] == list(range(1, n + 1))
        assert [json.loads(x)["s_suppkey"] for _, x in got] == list(range(n))
    elif fmt == "xml":
        assert [b for b, _ in got] == [1, 2, 3, 4] and got[0][1].count("<item>") == 3
    else:
        key = (lambda x: x) if fmt == "array_dict" else (lambda x: x["results"])
        keys = [r["s_suppkey"] for _, x in got for r in key(json.loads(x))]
        assert keys == list(range(n)) and [b for b, _ in got] == [1, 2, 3, 4]


def test_outbound_resume_skips_delivered(spark, tmp):
    sent = f"{tmp}/sent"
    os.makedirs(sent)
    spark.read.parquet(f"{SF}/supplier.parquet").createOrReplaceTempView("supplier")
    cfg = ExchangeConfig(source_id="lake", destination_id="api", dataflow="Outbound", api_dataformat="array_dict",
                         api_limit=2, source_query="SELECT s_suppkey FROM supplier")
    kw = dict(audit_path=f"{tmp}/audit", delivery_path=f"{tmp}/log", order_by=["s_suppkey"], unique=True)
    with pytest.raises(RuntimeError):
        flows.run_outbound(spark, cfg, Recorder(sent, fail_batches={3}), **kw)
    assert sorted(b for b, _ in _decoded(sent)) == [1, 2, 4, 5]
    open(f"{sent}/heal", "w").close()
    flows.run_outbound(spark, cfg, Recorder(sent, fail_batches={3}), **kw)
    assert sorted(b for b, _ in _decoded(sent)) == [1, 2, 3, 4, 5]  # only batch 3 was sent again
    assert audit.latest_runs(audit.read_audit(spark, f"{tmp}/audit")).first().status == "Success"


def test_outbound_incremental_start_date(spark, tmp):
    sent = f"{tmp}/sent"
    os.makedirs(sent)
    spark.read.parquet(f"{SF}/events.parquet").createOrReplaceTempView("events")
    q = "SELECT event_id FROM events WHERE ts >= CAST(:start_date AS TIMESTAMP_NTZ)"
    cfg = ExchangeConfig(source_id="ev", destination_id="api", dataflow="Outbound", api_dataformat="array_dict",
                         api_limit=1000, source_query=q, adhoc_start_date="2024-01-15 00:00:00")
    res = flows.run_outbound(spark, cfg, Recorder(sent), audit_path=f"{tmp}/audit", delivery_path=f"{tmp}/log",
                             order_by=["event_id"], unique=True)
    expect = spark.read.parquet(f"{SF}/events.parquet").filter("ts >= timestamp_ntz'2024-01-15 00:00:00'").count()
    assert res.source_count == expect


def test_outbound_zero_rows_is_success(spark, tmp):
    spark.read.parquet(f"{SF}/supplier.parquet").createOrReplaceTempView("supplier")
    cfg = ExchangeConfig(source_id="lake", destination_id="api0", dataflow="Outbound", api_dataformat="array_dict",
                         api_limit=2, source_query="SELECT s_suppkey FROM supplier WHERE s_suppkey < 0")
    res = flows.run_outbound(spark, cfg, Recorder(tmp), audit_path=f"{tmp}/audit", delivery_path=f"{tmp}/log",
                             order_by=["s_suppkey"], unique=True)
    assert res.source_count == 0
    assert audit.latest_runs(audit.read_audit(spark, f"{tmp}/audit")).first().status == "Success"


def test_audit_open_close_resume(spark, tmp):
    p = f"{tmp}/audit"
    r1 = audit.open_run(spark, p, "s", "d")
    audit.close_run(spark, p, r1, audit.FAILED, 10, 3, 1, 100)
    r2 = audit.open_run(spark, p, "s", "d")
    assert r2.audit_id == r1.audit_id and r2.resumed and r2.loaded_obj_count == 1
    audit.close_run(spark, p, r2, audit.SUCCESS, 10, 3, 3, 300)
    r3 = audit.open_run(spark, p, "s", "d")
    assert r3.audit_id != r1.audit_id and not r3.resumed and r3.last_checkpoint is not None
    assert audit.read_audit(spark, p).count() == 5  # append-only


def test_execute_dispatch(spark, tmp):
    with pytest.raises(ValueError):
        flows.execute(spark, _cfg(), send=print)
    out = ExchangeConfig(source_id="a", dataflow="Outbound", api_dataformat="dict", source_query="SELECT 1 AS x")
    with pytest.raises(ValueError):
        flows.execute(spark, out, fetch=print)


def test_execute_with_dictionary_config(spark, tmp):
    recs = _orders(spark)[:330]
    conf = {
        "source-id": "orders", "destination-id": "lake", "dataflow": "Inbound",
        "pagination-type": "pageindex-size", "body": {"pageIndex": 1, "pageSize": 50},
        "response-format": "json", "data-field": "data.items", "count-field": "total",
        "catalog-name": "main", "schema-name": "raw", "table-name": "orders", "df-limit": 500,
    }
    cfg = ExchangeConfig.from_dict(conf)
    assert cfg.table_name == "main.raw.orders" and cfg.page_size == 50
    res = flows.execute(spark, cfg, fetch=FakeApi(recs), load_ts=TS, user="u", **_paths(tmp))
    assert res.target_count == 330 and res.total_obj_count == 7
    latest = audit.latest_runs(audit.read_audit(spark, f"{tmp}/audit")).first()
    assert (latest.status, latest.source_count, latest.total_obj_count, latest.target_count) == ("Success", 330, 7, 330)


def test_config_validation():
    with pytest.raises(ValueError):
        ExchangeConfig(source_id="s", dataflow="Sideways")
    with pytest.raises(ValueError):
        ExchangeConfig(source_id="s", pagination_type="cursor", page_size=1)
    with pytest.raises(ValueError):
        ExchangeConfig(source_id="s", dataflow="Outbound", api_dataformat="csv")
    c = ExchangeConfig.from_dict({"source-id": "a", "pagination-type": "limit-offset", "params": {"limit": 50},
                                  "url": "http://x/service?wsdl", "response-format": "xml", "df-limit": 120})
    assert c.page_size == 50 and c.soap and c.wave_pages == 3
    assert c.wave_size(8) == 3 and c.with_(df_limit=100_000).wave_size(8) == 2000 and c.with_(df_limit=None).wave_size(8) == 256


def test_stream_ingest_matches_batch(spark, tmp):
    from ferry.streaming.ingest import ingest_landed_stream
    from ferry.suite import orders_pages

    orders_pages(spark, SF).repartition(3, "page").write.parquet(f"{tmp}/src")
    ingest_landed_stream(spark, _cfg(), f"{tmp}/src", f"{tmp}/table", checkpoint_location=f"{tmp}/ck",
                         load_ts=TS, user="u", max_files_per_trigger=1)
    t = _table(spark, tmp)
    assert t.count() == 1500 and t.select("load_id").distinct().count() == 3
    # restarting the same stream finds nothing new and changes nothing
    ingest_landed_stream(spark, _cfg(), f"{tmp}/src", f"{tmp}/table", checkpoint_location=f"{tmp}/ck", load_ts=TS, user="u")
    assert _table(spark, tmp).count() == 1500
