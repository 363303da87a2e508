"""Runs that must not lose, alter or strand data: bad pages, grown sources, resumes, odd records."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from ferry import flows
from ferry.config import ExchangeConfig
from ferry.operators import audit, sink
from ferry.sources import pages
from tests.fakeapi import FakeApi, Recorder
from tests.test_flows import TS, _cfg, _paths, _table


class Broken(FakeApi):
    """Serves an HTML error page for one page until ``heal`` exists."""

    def __init__(self, records, size, bad, heal, **kw):
        super().__init__(records, size, **kw)
        self.bad, self.heal = bad, heal

    def __call__(self, req):
        if req.get("page") == self.bad and not os.path.exists(self.heal):
            return "<html><body>502 Bad Gateway</body></html>"
        return super().__call__(req)


def _status(spark, tmp):
    return audit.latest_runs(audit.read_audit(spark, f"{tmp}/audit")).first().status


@pytest.mark.parametrize("n,size,bad,count", [(50, 10, 2, "total"), (300, 10, 3, None), (47, 10, 4, "total")])
def test_a_bad_page_fails_the_run_and_is_fetched_again(spark, tmp, n, size, bad, count):
    recs = [{"id": i} for i in range(n)]
    api = Broken(recs, size, bad, f"{tmp}/heal", count_field=count)
    cfg = _cfg(page_size=size, count_field=count, df_limit=None)
    with pytest.raises(flows.IncompleteLoad, match=f"page {bad}"):
        flows.run_inbound(spark, cfg, api, load_ts=TS, user="u", **_paths(tmp))
    first = audit.latest_runs(audit.read_audit(spark, f"{tmp}/audit")).first()
    assert first.status == "Failed" and not os.path.exists(f"{tmp}/table")
    kept = pages.bad_bodies(spark, f"{tmp}/landing", "orders", first.audit_id).collect()
    assert [(r.page, r.status) for r in kept] == [(bad, "unparseable")] and "502" in kept[0].body
    open(f"{tmp}/heal", "w").close()
    res = flows.run_inbound(spark, cfg, api, load_ts=TS, user="u", **_paths(tmp))
    assert res.audit_id == first.audit_id and res.target_count == n and _status(spark, tmp) == "Success"
    assert sorted(r.id for r in _table(spark, tmp).select("data_payload.id").collect()) == list(range(n))


def test_resume_after_the_source_has_grown(spark, tmp):
    recs = [{"id": i} for i in range(25)]
    with pytest.raises(flows.IncompleteLoad):  # lands pages 0 and 2 of a total of 25
        flows.run_inbound(spark, _cfg(page_size=10), Broken(recs, 10, 1, f"{tmp}/heal"), load_ts=TS, user="u", **_paths(tmp))
    grown = [{"id": i} for i in range(38)]
    res = flows.run_inbound(spark, _cfg(page_size=10), FakeApi(grown, 10), load_ts=TS, user="u", **_paths(tmp))
    assert res.source_count == 38 == res.target_count
    assert sorted(r.id for r in _table(spark, tmp).select("data_payload.id").collect()) == list(range(38))


class Short(FakeApi):
    def _slice(self, req):
        return super()._slice(req)[:-1] if req.get("page") == 1 else super()._slice(req)


def test_a_page_short_of_the_plan_fails_the_run(spark, tmp):
    recs = [{"id": i} for i in range(30)]
    with pytest.raises(flows.IncompleteLoad, match="fewer records"):
        flows.run_inbound(spark, _cfg(page_size=10), Short(recs, 10), load_ts=TS, user="u", **_paths(tmp))
    assert _status(spark, tmp) == "Failed"


def _out(query, **kw):
    return ExchangeConfig(source_id="lake", destination_id="api", dataflow="Outbound", api_dataformat="array_dict", api_limit=2, source_query=query, **kw)


def _sent(folder):
    out = {}
    for name in os.listdir(folder):
        if name.startswith("batch-"):
            out.setdefault(int(name.split("-")[1]), []).append(open(f"{folder}/{name}").read())
    return out


def test_outbound_resume_sends_the_first_numbering(spark, tmp):
    os.makedirs(f"{tmp}/sent")
    spark.createDataFrame([(i,) for i in range(2, 12)], "k long").createOrReplaceTempView("grows")
    kw = dict(audit_path=f"{tmp}/audit", delivery_path=f"{tmp}/log", order_by=["k"], unique=True)
    with pytest.raises(RuntimeError):
        flows.run_outbound(spark, _out("SELECT k FROM grows"), Recorder(f"{tmp}/sent", fail_batches={3}), **kw)
    spark.createDataFrame([(i,) for i in range(1, 12)], "k long").createOrReplaceTempView("grows")  # a row in front
    open(f"{tmp}/sent/heal", "w").close()
    res = flows.run_outbound(spark, _out("SELECT k FROM grows"), Recorder(f"{tmp}/sent", fail_batches={3}), **kw)
    sent = _sent(f"{tmp}/sent")
    assert all(len(v) == 1 for v in sent.values())
    assert [r["k"] for b in sorted(sent) for r in json.loads(sent[b][0])] == list(range(2, 12)) and res.target_count == 10
    log = spark.read.parquet(f"{tmp}/log").filter("ok").collect()
    assert {r.batch_num: r.body_sha256 for r in log} == {b: hashlib.sha256(v[0].encode()).hexdigest() for b, v in sent.items()}
    assert not os.path.exists(f"{tmp}/log_snapshot/{res.audit_id}")


def test_outbound_in_waves_logs_what_was_sent(spark, tmp, monkeypatch):
    os.makedirs(f"{tmp}/sent")
    monkeypatch.setattr(flows, "BATCHES_PER_CORE", 1)
    spark.range(20).createOrReplaceTempView("twenty")
    res = flows.run_outbound(spark, _out("SELECT id FROM twenty"), Recorder(f"{tmp}/sent"), audit_path=f"{tmp}/audit",
                             delivery_path=f"{tmp}/log", order_by=["id"], unique=True)
    assert res.target_count == 20 and sorted(_sent(f"{tmp}/sent")) == list(range(1, 11))


def test_first_incremental_run_needs_a_date(spark, tmp):
    spark.createDataFrame([(1, "2024-01-01 00:00:00")], "k long, ts string").createOrReplaceTempView("dated")
    query = "SELECT k FROM dated WHERE CAST(ts AS TIMESTAMP) >= CAST(:start_date AS TIMESTAMP)"
    kw = dict(audit_path=f"{tmp}/audit", delivery_path=f"{tmp}/log", order_by=["k"], unique=True)
    with pytest.raises(ValueError, match="start_date"):
        flows.run_outbound(spark, _out(query), Recorder(tmp), **kw)
    assert flows.run_outbound(spark, _out(query, adhoc_start_date="2000-01-01"), Recorder(tmp), **kw).target_count == 1
    assert flows.run_outbound(spark, _out(query), Recorder(tmp), **kw).target_count == 0  # from the checkpoint on


class Dated(FakeApi):
    def __call__(self, req):
        with open(f"{self.folder}/dates", "a") as f:
            f.write(f"{req.get('start_date')}\n")
        return super().__call__(req)


def test_inbound_requests_carry_the_start_date(spark, tmp):
    api = Dated([{"id": 1}], 10)
    api.folder = tmp
    flows.run_inbound(spark, _cfg(page_size=10), api, load_ts=TS, user="u", **_paths(tmp))
    flows.run_inbound(spark, _cfg(page_size=10), api, load_ts=TS, user="u", **_paths(tmp))
    dates = open(f"{tmp}/dates").read().split()
    assert dates[:2] == ["None", "None"] and all(d.startswith("20") for d in dates[2:]) and len(dates) == 4


def _load(spark, tmp, load_id, items, **kw):
    body = spark.createDataFrame([(0, json.dumps({"data": {"items": items}}))], "page long, body string")
    return flows.load_landed(spark, _cfg(), body, f"{tmp}/table", load_id, TS, "u", **kw)


def test_whole_fractions_stay_fractions(spark, tmp):
    _load(spark, tmp, "L1", [{"x": 1.0}, {"x": 20.0}])
    _load(spark, tmp, "L2", [{"x": 2.5}])
    assert sorted(r.x for r in _table(spark, tmp).select("data_payload.x").collect()) == [1.0, 2.5, 20.0]


def test_record_fields_named_like_metadata(spark, tmp):
    _load(spark, tmp, "L1", [{"page": "p", "pos": 9, "record": "r", "load_id": "x", "_r": 1}])
    r = _table(spark, tmp).select("page", "pos", "load_id", F.col("data_payload").alias("d")).first()
    assert (r.page, r.pos, r.load_id) == (0, 0, "L1") and (r.d.page, r.d.pos, r.d.load_id, r.d["_r"]) == ("p", 9, "x", 1)


def test_empty_first_load_is_no_failure(spark, tmp):
    assert _load(spark, tmp, "L1", []).target_count == 0
    assert _load(spark, tmp, "L2", [{"a": 1}]).target_count == 1 and _table(spark, tmp).count() == 1
    api = FakeApi([], 10)
    res = flows.run_inbound(spark, _cfg(source_id="none"), api, load_ts=TS, user="u", landing_path=f"{tmp}/l2", table_path=f"{tmp}/t2", audit_path=f"{tmp}/a2")
    assert (res.source_count, res.target_count) == (0, 0)


def test_ignored_field_keeps_its_stored_type(spark, tmp):
    _load(spark, tmp, "L1", [{"id": 1, "x": 1}])
    _load(spark, tmp, "L2", [{"id": 2, "x": 2}], ignore=["x"])
    with pytest.raises(flows.SchemaConflict):
        _load(spark, tmp, "L3", [{"id": 3, "x": 0.5}])
    rows = {r.id: r.x for r in _table(spark, tmp).select("data_payload.id", "data_payload.x").collect()}
    assert rows[1] == 1 and set(rows) == {1, 2}


def test_records_that_are_no_objects_are_kept_in_quarantine(spark, tmp):
    res = _load(spark, tmp, "L1", [{"id": 1}, 5, "z"])
    assert (res.target_count, res.quarantined) == (1, 2)
    assert sorted(r.record for r in spark.read.parquet(f"{tmp}/table_quarantine").collect()) == ['"z"', "5"]
    assert _load(spark, tmp, "L2", [5]).quarantined == 1


def test_settings_table_names_the_ignored_fields(spark, tmp):
    settings = spark.createDataFrame([("raw.orders", "secret")], "table_name string, field_name string")
    cfg = _cfg(page_size=10, table_name="raw.orders")
    flows.run_inbound(spark, cfg, FakeApi([{"id": 1, "secret": "s"}], 10), load_ts=TS, user="u", settings=settings, **_paths(tmp))
    assert _table(spark, tmp).schema["data_payload"].dataType.fieldNames() == ["id"]


def test_stream_restart_without_a_checkpoint_argument_keeps_its_batches(spark, tmp):
    from ferry.streaming.ingest import ingest_landed_stream

    def put(k, items):
        spark.createDataFrame([(k, json.dumps({"data": {"items": items}}))], "page long, body string").coalesce(1).write.mode("append").parquet(f"{tmp}/src")

    put(0, [{"id": 1}, 7])
    ingest_landed_stream(spark, _cfg(), f"{tmp}/src", f"{tmp}/table", load_ts=TS, user="u", max_files_per_trigger=1)
    put(1, [{"id": 2}])
    ingest_landed_stream(spark, _cfg(), f"{tmp}/src", f"{tmp}/table", load_ts=TS, user="u", max_files_per_trigger=1)
    assert sorted(r.id for r in _table(spark, tmp).select("data_payload.id").collect()) == [1, 2]
    assert [r.record for r in spark.read.parquet(f"{tmp}/table_quarantine").collect()] == ["7"]


def test_stored_schema_survives_being_replaced(spark, tmp):
    from pyspark.sql.types import LongType, StructType

    for name in ("a", "b"):
        sink.save_schema(spark, f"{tmp}/t", StructType().add(name, LongType()))
    assert sink.load_schema(spark, f"{tmp}/t").fieldNames() == ["b"]
    assert os.listdir(f"{tmp}/t/{sink.SCHEMA_DIR}") == ["schema.json"] or all("schema.json" in n for n in os.listdir(f"{tmp}/t/{sink.SCHEMA_DIR}"))
