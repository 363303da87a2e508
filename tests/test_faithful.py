"""Values come back as they were sent; bad bodies, over-full pages and second runs are found out."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StringType

from ferry import ExchangeConfig, flows
from ferry.flows import IncompleteLoad, content_reconciliation, load_landed, read_rejects, run_inbound
from ferry.functions import extract
from ferry.operators import audit, delivery, schema as sch, sink
from ferry.streaming.ingest import BadBodies, ingest_landed_stream, read_stream_quarantine


def _bodies(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page long, body string")


def _records(spark, body, **kw):
    rows = extract.extract_records(_bodies(spark, [body]), "item", "xml", **kw).orderBy("pos")
    return [json.loads(r[0]) for r in rows.select(F.to_json("record")).collect()]


@pytest.mark.parametrize("text", ["0012", "1e3", " 5 ", "+5", "-0", "1.50", "007.5", "0.0001", "12345678901234567890", "1234567.123456789", "x > 5",
                                  "2024-01-01", "TRUE", "NaN", "1_000", "é"])
def test_xml_text_stays_text(spark, text):
    body = f'<r><item id="{text}"><a>{text}</a><b><![CDATA[{text}]]></b></item><item id=\'{text}\'/></r>'
    first, second = _records(spark, body)
    assert first == {"_id": text, "a": text, "b": text} and second["_id"] == text


@pytest.mark.parametrize("text, value", [("0", 0), ("-17", -17), ("123456789012345678", 123456789012345678), ("711.56", 711.56), ("-0.001", -0.001),
                                         ("7.0", 7.0), ("true", True)])
def test_xml_values_that_read_back_as_they_were_are_typed(spark, text, value):
    (rec,) = _records(spark, f"<r><item><a>{text}</a></item></r>")
    assert rec == {"a": value} and type(rec["a"]) is type(value)


def test_mixed_xml_column_keeps_every_text(spark):
    body = "<r>" + "".join(f"<item><a>{t}</a></item>" for t in ("12", "0012", "7.0", "711.56", "-0.001", "true", "x")) + "</r>"
    recs = extract.extract_records(_bodies(spark, [body]), "item", "xml")
    rows = sch.conform(recs, sch.infer_schema(recs)).orderBy("pos").select("data_payload.a").collect()
    assert [r[0] for r in rows] == ["12", "0012", "7.0", "711.56", "-0.001", "true", "x"]


def test_xml_namespaces(spark):
    body = '<r xmlns:a="u:a" xmlns:b="u:b"><m:item xmlns:m="u:m"><a:x>1</a:x><b:x>02</b:x></m:item></r>'
    assert _records(spark, body, prefixes=True) == [{"a:x": 1, "b:x": "02"}]
    assert _records(spark, body) == [{"x": [1, "02"]}]
    soap = ('<s:Envelope xmlns:s="http://schemas.xmlsoap.org/soap/envelope/"><s:Body><m:R xmlns:m="u"><m:item><m:id>01</m:id></m:item></m:R>'
            '</s:Body></s:Envelope>')
    assert _records(spark, soap, soap=True, prefixes=True) == [{"m:id": "01"}]
    assert _records(spark, soap, soap=True) == [{"id": "01"}]


def test_repeated_json_key_takes_the_last(spark):
    b = _bodies(spark, ['{"total": 9, "total": 1, "items": [{"a": 1, "a": 2}]}'])
    assert [r[0] for r in extract.extract_records(b, "items").select(F.to_json("record")).collect()] == ['{"a":2}']
    assert tuple(extract.body_summary(b, "items", "total").select("status", "total").first()) == ("ok", 1)
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


def _infer(spark, records):
    b = _bodies(spark, [json.dumps({"items": records})])
    recs = extract.extract_records(b, "items")
    return sch.infer_schema(recs), recs


def test_wide_integers_keep_their_digits(spark):
    a, b = 12345678901234567890, 12345678901234567891
    schema, recs = _infer(spark, [{"id": a, "n": 1}, {"id": b, "n": 2}, {"id": 7, "n": 3}])
    assert schema["id"].dataType == DecimalType(20, 0) and schema["n"].dataType == LongType()
    assert [int(r[0]) for r in sch.conform(recs, schema).orderBy("pos").select("data_payload.id").collect()] == [a, b, 7]
    schema, _ = _infer(spark, [{"x": 1}, {"x": 2.0}, {"x": 0.5}])
    assert schema["x"].dataType == DoubleType()
    schema, _ = _infer(spark, [{"x": 1}, {"x": 2.0}])
    assert schema["x"].dataType == DoubleType()


def test_numeric_chain():
    d20, d25 = DecimalType(20, 0), DecimalType(25, 0)
    merge = sch.merge_types
    assert merge(LongType(), d20) == merge(d20, LongType()) == d20 and merge(d20, d25) == d25
    assert merge(LongType(), DecimalType(19, 0)) == DecimalType(19, 0)
    assert merge(d20, DoubleType()) == StringType() and merge(d20, StringType()) == StringType()
    assert merge(LongType(), DoubleType()) == DoubleType()


def test_widening_keeps_digits(spark, tmp):
    cfg, path = ExchangeConfig("s", data_field="items"), f"{tmp}/t"
    wide = 12345678901234567890123
    for load, value in (("l1", 2**63 - 1), ("l2", wide), ("l3", "x")):
        load_landed(spark, cfg, _bodies(spark, [json.dumps({"items": [{"id": value}]})]), path, load, on_type_change="widen")
    got = {r["load_id"]: r["id"] for r in sink.read_table(spark, path).select("load_id", "data_payload.id").collect()}
    assert got == {"l1": str(2**63 - 1), "l2": str(wide), "l3": "x"}


def test_stream_keeps_bad_bodies(spark, tmp):
    good = '{"items": [{"a": 1}]}'
    bodies = [good, "<html>error</html>", '{"items": [{"a": 3, "a": 4}]}', '{"other": 1}', None, '{"items": []}']
    _bodies(spark, bodies).coalesce(1).write.parquet(f"{tmp}/src")
    cfg = ExchangeConfig("s", data_field="items")
    ingest_landed_stream(spark, cfg, f"{tmp}/src", f"{tmp}/t")
    assert sorted(r[0] for r in sink.read_table(spark, f"{tmp}/t").select("data_payload.a").collect()) == [1, 4]
    bad = {r["page"]: r for r in read_stream_quarantine(spark, f"{tmp}/t").collect()}
    assert {p: (r["status"], r["body"], r["row"], r["load_id"]) for p, r in bad.items()} == {
        1: ("unparseable", bodies[1], 1, "stream-0"), 3: ("no_records", bodies[3], 3, "stream-0"), 4: ("unparseable", None, 4, "stream-0")}
    assert all(r["file"].endswith(".parquet") and "/src/" in r["file"] for r in bad.values())
    ingest_landed_stream(spark, cfg, f"{tmp}/src", f"{tmp}/t")  # nothing new
    _bodies(spark, [good]).write.mode("append").parquet(f"{tmp}/src")
    ingest_landed_stream(spark, cfg, f"{tmp}/src", f"{tmp}/t")
    assert sink.read_table(spark, f"{tmp}/t").count() == 3 and read_stream_quarantine(spark, f"{tmp}/t").count() == 3


def test_stream_stops_at_bad_bodies_if_told_to(spark, tmp):
    _bodies(spark, ['{"items": [{"a": 1}]}', "bad{"]).coalesce(1).write.parquet(f"{tmp}/src")
    cfg = ExchangeConfig("s", data_field="items")
    for _ in range(2):  # the restart finds the same batch and does not double the quarantine
        with pytest.raises(Exception, match=BadBodies.__name__):
            ingest_landed_stream(spark, cfg, f"{tmp}/src", f"{tmp}/t", on_bad_bodies="fail")
        assert read_stream_quarantine(spark, f"{tmp}/t").count() == 1 and not os.path.exists(f"{tmp}/t")
    with pytest.raises(ValueError):
        ingest_landed_stream(spark, cfg, f"{tmp}/src", f"{tmp}/t", on_bad_bodies="drop")


def _paths(tmp):
    return dict(landing_path=f"{tmp}/landing", table_path=f"{tmp}/t", audit_path=f"{tmp}/audit")


@pytest.mark.parametrize("kind, key", [("limit-offset", "params"), ("pageindex-size", "body")])
def test_over_full_pages_fail_until_they_are_right(spark, tmp, kind, key):
    cfg = ExchangeConfig.from_dict({"source-id": "s", "destination-id": "d", "pagination-type": kind, key: {"limit": 1, "pageSize": 1},
                                    "data-field": "items", "count-field": "total"})
    flag = f"{tmp}/mended"

    def fetch(request):
        n = 1 if os.path.exists(flag) else 3
        return json.dumps({"total": 2, "items": [{"a": i} for i in range(n)]})

    with pytest.raises(IncompleteLoad):
        run_inbound(spark, cfg, fetch, **_paths(tmp))
    open(flag, "w").close()
    res = run_inbound(spark, cfg, fetch, check_content=True, **_paths(tmp))
    assert res.target_count == 2 and sink.read_table(spark, f"{tmp}/t").count() == 2


def test_lost_rows_fail_the_run(spark, tmp, monkeypatch):
    cfg = ExchangeConfig("s", destination_id="d", pagination_type="limit-offset", page_size=2, data_field="items", count_field="total")
    fetch = lambda r: json.dumps({"total": 4, "items": [{"a": i} for i in range(2)]})
    write = sink.write_partitions
    with monkeypatch.context() as m:
        m.setattr(sink, "write_partitions", lambda df, *a, **k: write(df.filter("not (page = 1 and pos = 0)"), *a, **k))
        with pytest.raises(IncompleteLoad, match="page 1"):
            run_inbound(spark, cfg, fetch, **_paths(tmp))
    with monkeypatch.context() as m:
        other = F.when(F.col("page") == 0, F.col("data_payload").withField("a", F.lit(5).cast("bigint"))).otherwise(F.col("data_payload"))
        m.setattr(sink, "write_partitions", lambda df, *a, **k: write(df.withColumn("data_payload", other), *a, **k))
        with pytest.raises(IncompleteLoad, match="altered"):
            run_inbound(spark, cfg, fetch, check_content=True, **_paths(tmp))
    assert run_inbound(spark, cfg, fetch, check_content=True, **_paths(tmp)).target_count == 4


def test_reconciliation_counts_rejects(spark, tmp):
    cfg = ExchangeConfig("s", data_field="items")
    bodies = _bodies(spark, ['{"items": [{"a": 1}, 5]}', '{"items": [{"a": 2}]}'])
    load_landed(spark, cfg, bodies, f"{tmp}/t", "l1")
    got = sorted(map(tuple, content_reconciliation(spark, cfg, bodies, f"{tmp}/t", "l1").collect()))
    assert got == [(0, 1, 1, 1, "ok"), (1, 1, 0, 1, "ok")]


def test_one_claim_at_a_time(spark, tmp):
    path = f"{tmp}/audit"
    with audit.claim(spark, path, "s", "d", 100):
        with pytest.raises(audit.RunInProgress):
            with audit.claim(spark, path, "s", "d", 100):
                pass
        with audit.claim(spark, path, "s", "other", 100):
            pass
        with audit.claim(spark, path, "s", "d", 0):  # its time is over
            with pytest.raises(audit.RunInProgress):
                with audit.claim(spark, path, "s", "d", 100):
                    pass
    with audit.claim(spark, path, "s", "d", 100):
        pass


def test_fields_that_do_not_fit_are_rejected_alone(spark, tmp):
    cfg, path = ExchangeConfig("s", data_field="items"), f"{tmp}/t"
    load = lambda name, items: load_landed(spark, cfg, _bodies(spark, [json.dumps({"items": items})]), path, name, on_type_change="reject")
    assert load("l1", [{"a": 1, "o": {"b": True, "c": [1]}, "s": "x"}]).rejected == 0
    second = [{"a": 2.5, "o": {"b": "no", "c": [2]}, "s": 7}, {"a": None, "o": 3, "s": "y", "new": 1}, {"a": 2**70, "o": {"b": False, "c": "z"}}, 5]
    res = load("l2", second)
    assert (res.target_count, res.quarantined, res.rejected) == (3, 1, 5)
    rows = sink.read_table(spark, path).filter("load_id = 'l2'").orderBy("pos").select("data_payload.*").collect()
    assert [(r["a"], r["o"] and (r["o"]["b"], r["o"]["c"]), r["s"], r["new"]) for r in rows] == [
        (None, (None, [2]), "7", None), (None, None, "y", 1), (None, (False, None), None, None)]
    got = {(r["pos"], r["path"]): r["text"] for r in read_rejects(spark, path).collect()}
    assert got == {(0, "a"): "2.5", (0, "o.b"): "no", (1, "o"): "3", (2, "a"): str(2**70), (2, "o.c"): "z"}
    bodies = _bodies(spark, [json.dumps({"items": second})])
    assert [tuple(r) for r in content_reconciliation(spark, cfg, bodies, path, "l2", by_field=True).collect()] == [(0, 3, 1, 3, "ok")]
    assert load("l2", [{"a": 4}]).rejected == 0 and read_rejects(spark, path).count() == 0


def test_a_wave_opens_its_own_files_only(spark, tmp, monkeypatch):
    monkeypatch.setattr(flows, "BATCHES_PER_CORE", 2)
    spark.range(100).createOrReplaceTempView("numbers")
    cfg = ExchangeConfig("lake", destination_id="api", dataflow="Outbound", api_dataformat="array_dict", api_limit=5, source_query="SELECT id FROM numbers")
    opened = []
    deliver = delivery.deliver

    def watched(batches, *a, **k):
        files = [r[0] for r in batches.select(F.input_file_name()).distinct().collect()]
        opened.append({f.split("/wave=")[1].split("/")[0] for f in files})
        return deliver(batches, *a, **k)

    monkeypatch.setattr(delivery, "deliver", watched)
    res = flows.run_outbound(spark, cfg, print, audit_path=f"{tmp}/audit", delivery_path=f"{tmp}/log", order_by=["id"], unique=True)
    assert res.target_count == 100 and res.loaded_obj_count == 20
    assert opened == [{str(w)} for w in range(len(opened))] and len(opened) == 3
    assert spark.read.parquet(f"{tmp}/log").groupBy("wave").count().count() == 3
