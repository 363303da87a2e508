import json

from pyspark.sql import functions as F

from ferry.functions import extract


def _bodies(spark, bodies):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "page long, body string")


def test_variant_path():
    assert extract.variant_path(None) == "$"
    assert extract.variant_path("data.items") == "$.data.items"
    assert extract.variant_path("a.b-c") == "$.a['b-c']"


def test_json_records_and_positions(spark):
    b = _bodies(spark, [json.dumps({"total": 3, "data": {"items": [{"id": 1}, {"id": 2}]}}),
                        json.dumps({"total": 3, "data": {"items": [{"id": 3}]}})])
    rows = extract.extract_records(b, "data.items").select("page", "pos", F.variant_get("record", "$.id", "int").alias("id")).collect()
    assert sorted((r.page, r.pos, r.id) for r in rows) == [(0, 0, 1), (0, 1, 2), (1, 0, 3)]


def test_single_object_is_one_record(spark):
    b = _bodies(spark, [json.dumps({"data": {"items": {"id": 7}}})])
    assert extract.extract_records(b, "data.items").count() == 1


def test_bad_bodies_do_not_fail(spark):
    b = _bodies(spark, ["bad{", "", json.dumps({"total": 0, "data": {"items": []}}), json.dumps({"other": 1})])
    assert extract.extract_records(b, "data.items").count() == 0
    s = {r.page: (r.status, r.total, r.n_records) for r in extract.body_summary(b, "data.items", "total").collect()}
    assert s[0][0] == "unparseable" and s[1][0] == "unparseable"
    assert s[2] == ("ok", 0, 0)
    assert s[3] == ("no_records", None, 0)


def test_count_field(spark):
    b = _bodies(spark, [json.dumps({"meta": {"count": 42}, "rows": []})])
    assert extract.body_summary(b, "rows", "meta.count").first().total == 42


def test_xml_records(spark):
    b = _bodies(spark, ["<root><item><a>1</a><b>x &amp; y</b></item><item><a>2</a></item></root>", "<root><item><a>3</a></item></root>"])
    rows = extract.extract_records(b, "item", "xml").select(
        "page", "pos", F.variant_get("record", "$.a", "int").alias("a"), F.variant_get("record", "$.b", "string").alias("b")
    ).collect()
    assert sorted((r.page, r.pos, r.a, r.b) for r in rows) == [(0, 0, 1, "x & y"), (0, 1, 2, None), (1, 0, 3, None)]


def test_soap_records_with_prefixes(spark):
    body = ('<s:Envelope xmlns:s="http://schemas.xmlsoap.org/soap/envelope/"><s:Body>'
            '<m:GetResponse xmlns:m="urn:x"><m:item><m:id>1</m:id></m:item><m:item><m:id>2</m:id></m:item>'
            '</m:GetResponse></s:Body></s:Envelope>')
    rows = extract.extract_records(_bodies(spark, [body]), "item", "xml", soap=True).select(
        F.variant_get("record", "$.id", "int").alias("id")).collect()
    assert sorted(r.id for r in rows) == [1, 2]
