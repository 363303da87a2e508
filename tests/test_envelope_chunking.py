import json

from pyspark.sql import functions as F

from ferry.functions import encode, envelope as env
from ferry.operators import chunking, delivery


def test_blank_to_null_top_level_only(spark):
    df = spark.createDataFrame([("", ("",), 1)], "a string, s struct<x:string>, n int")
    r = env.blank_to_null(df).first()
    assert r.a is None and r.s.x == "" and r.n == 1


def test_keys_unique_and_repeatable(spark):
    df = spark.createDataFrame([(0, 0, "x"), (0, 1, "x"), (1, 0, "x")], "page long, pos long, v string")
    a = env.envelope(df, "src", "L1", "2024-01-01 00:00:00", "u").collect()
    b = env.envelope(df, "src", "L1", "2024-01-01 00:00:00", "u").collect()
    assert len({r.surrogate_key_id for r in a}) == 3
    assert [r.surrogate_key_id for r in a] == [r.surrogate_key_id for r in b]
    assert a[0].data_payload.v == "x" and a[0].load_id == "L1"
    assert tuple(env.envelope(df, "s", "L", None, "u").columns[:7]) == env.ENVELOPE_COLUMNS


def test_global_index_exact_and_balanced(spark):
    df = spark.range(0, 10007).select((F.col("id") * 7919 % 10007).alias("k"))
    idx, n = chunking.global_index_with_count(df, ["k"], unique=True, n_blocks=5)
    assert n == 10007
    rows = idx.select("k", "rn").collect()
    assert all(r.rn == r.k + 1 for r in rows)


def test_global_index_with_ties_is_stable(spark):
    df = spark.createDataFrame([(i % 3, f"v{i}") for i in range(200)], "k int, v string")
    a = {(r.k, r.v): r.rn for r in chunking.global_index(df, ["k"], n_blocks=4).collect()}
    b = {(r.k, r.v): r.rn for r in chunking.global_index(df.repartition(7), ["k"], n_blocks=3).collect()}
    assert a == b and sorted(a.values()) == list(range(1, 201))


def test_batches_partition_rows(spark):
    df = spark.range(0, 23).withColumnRenamed("id", "k")
    b = chunking.collect_batches(chunking.global_index(df, ["k"], unique=True), 5).orderBy("batch_num").collect()
    assert [r.n for r in b] == [5, 5, 5, 5, 3]
    assert [x.k for r in b for x in r["items"]] == list(range(23))


def test_encoders(spark):
    items = F.array(F.struct(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b")))
    r = spark.range(1).select(
        encode.array_dict_body(items).alias("arr"), encode.nested_json_body(items).alias("nest"),
        encode.xml_body(items).alias("xml"), encode.dict_body(items[0]).alias("one"),
    ).first()
    assert json.loads(r.arr) == [{"a": 1, "b": None}]
    assert json.loads(r.nest) == {"results": [{"a": 1, "b": None}]}
    assert json.loads(r.one) == {"a": 1, "b": None}
    assert "<item>" in r.xml and "<a>1</a>" in r.xml and "<b>" not in r.xml


def test_pending_batches(spark):
    b = spark.createDataFrame([(1, 2, "x"), (2, 2, "y"), (3, 1, "z")], "batch_num long, n long, body string")
    log = spark.createDataFrame([(1, 2, True, None, "d1"), (2, 2, False, "err", "d2")], delivery.DELIVERY_SCHEMA)
    assert sorted(r.batch_num for r in delivery.pending_batches(b, log).collect()) == [2, 3]
