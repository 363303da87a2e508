"""Quality ledger, mixing, URL verdicts and shards: DuckDB or brute force on whole tables, edge rows, native plans."""

import contextlib
import io
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from ferry.llm import mixing, quality, queries, sharding, url_filter
from tests.conftest import SF

TABLES = ("documents", "pages", "embeddings", "benchmark")
NATIVE = ("op4_quality_ledger", "op6_mix_sources", "op7_url_verdicts", "op9_byte_shards")


def duck(sql, **frames):
    con = duckdb.connect()
    for t in TABLES:
        if t in frames:
            con.register(t, frames[t])
        else:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return Counter(tuple(sorted(zip(names, r), key=lambda x: x[0])) for r in cur.fetchall())


def spark_rows(df):
    return Counter(tuple(sorted(zip(df.columns, r), key=lambda x: x[0])) for r in df.collect())


@pytest.mark.parametrize("name", [n for n in queries.ORACLE_SQL])
def test_query_equals_duckdb(spark, name):
    assert spark_rows(queries.QUERIES[name](spark, SF)) == duck(queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name", NATIVE)
def test_plans_have_no_python(spark, name):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        queries.QUERIES[name](spark, SF).explain("formatted")
    assert not any(x in out.getvalue() for x in ("Python", "Pandas", "ArrowEval", "MapIn"))


# ------------------------------------------------------------------ edge rows shared by the document operators

LONG = "lorem ipsum dolor sit " * 40_000
EDGE = [
    (1, None, "a"), (2, "", "a"), (3, " \n\t\x0b ", None), (None, "x " * 25, None), (4, LONG, "b"), (4, LONG, "b"),
    (5, "one two three four five six seven eight nine\n" * 3 + "tail", "b"), (6, "é\u2028ß\xa0word " * 30, "É"), (7, "#### $$ | <a> & %" * 9, "a"),
    (8, "\r\nA line\r\nA line\nB\n\nB\n" + "w " * 30, ""), (9, "SHOUT LOUD " * 15, "b"), (9, "other text", "c"),
]


def edge_docs(spark, rows=EDGE):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return docs.withColumn("size", F.lit("x")).withColumn("fail_bits", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("shard", F.lit("s"))


def as_pandas(docs):
    return docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"})


def test_ledger_edges(spark, tmp):
    docs = edge_docs(spark)
    docs.write.parquet(f"{tmp}/documents.parquet")
    assert spark_rows(queries.op4_quality_ledger(spark, tmp)) == duck(queries.ORACLE_SQL["op4_quality_ledger"], documents=as_pandas(docs))
    kept = quality.apply_policy(docs)
    assert kept.columns == docs.columns
    failed = quality.ledger(docs).filter(quality.fails(quality.CURRENT_POLICY, F.col("fail_bits"))).count()
    assert kept.count() == len(EDGE) - failed
    assert quality.ledger(docs.limit(0)).count() == 0


def test_ablation_counts_what_each_rule_does(spark):
    rows = quality.ledger(spark.read.parquet(f"{SF}/documents.parquet")).cache()
    bits = [r["fail_bits"] for r in rows.collect()]
    mask = quality.policy_mask("v2")
    for r in quality.ablation(rows, "v2").collect():
        bit = quality.rule_bit(r["rule"])
        assert r["n_failed"] == sum(b & bit != 0 for b in bits)
        assert r["n_alone"] == sum(b & mask == bit for b in bits)
        assert r["n_kept_without"] == sum(b & mask & ~bit == 0 for b in bits)
    assert quality.policy_mask("v1") & mask == quality.policy_mask("v1")


def test_mix_edges_and_totals(spark, tmp):
    docs = edge_docs(spark)
    docs.write.parquet(f"{tmp}/documents.parquet")
    got = spark_rows(queries.op6_mix_sources(spark, tmp))
    assert got == duck(queries.ORACLE_SQL["op6_mix_sources"], documents=as_pandas(docs))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = Counter()
    for r in mixing.plan_mix(docs).collect():
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in mixed.collect()) == +want
    empty = docs.limit(0)
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix(empty).count() == 0


def fill(sizes, limit=3):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while free:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if share * weight[s] > limit * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in free}
        for s in over:
            target[s] = float(limit * sizes[s])
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 3, None: 500, "Z": 40}, {"a": 0, "b": 7}, {"a": 0}, {None: 9}, {"a": 1, "b": 1, "c": 1, "d": 10**9},
    {chr(97 + i): (i * 37) % 11 * 100 for i in range(20)},
])
def test_targets_by_repeated_sharing(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(fill(sizes) if sum(sizes.values()) else {s: 0.0 for s in sizes})


def test_many_sources_use_the_salted_join(spark, monkeypatch):
    docs = edge_docs(spark)
    want = spark_rows(mixing.plan_mix(docs))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 1)
    assert spark_rows(mixing.plan_mix(docs)) == want


PAGES = [
    (1, None), (2, ""), (3, "no scheme/en/"), (4, "https://EXAMPLE.com"), (5, "https://example.com/en/x?y#z"), (6, "http://www.example.com/en/"),
    (7, "http://a.www.Example.COM/en/x"), (8, "http://notexample.com/en/"), (9, "https://x.net/es/1"), (10, "https://net/fr/"), (11, "https://net?/es/"),
    (12, "https://x.org/a//"), (12, "http://www.x.org/a#top"), (None, "ftp://x.org/a?q"), (13, "://h.org/p"), (14, "http://a://b.com/c"),
    (15, "http://casino-win.org/" + "p" * 50_000), (16, "https://www.casino-win.org/" + "p" * 50_000 + "/"), (17, "http://mycasino.org/"),
]


def test_url_edges(spark, tmp):
    pages = spark.createDataFrame(PAGES, "page_id long, url string").withColumn("host", F.lit(1)).withColumn("listed", F.lit("x"))
    pages = pages.withColumn("html", F.when(F.col("page_id") == 4, "<p>no link").when(F.col("page_id") % 2 == 0, F.lit("long " * 50)))
    pages.write.parquet(f"{tmp}/pages.parquet")
    got = queries.op7_url_verdicts(spark, tmp)
    frame = pages.select("page_id", "url", "html").toPandas().astype({"page_id": "Int64"})
    assert spark_rows(got) == duck(queries.ORACLE_SQL["op7_url_verdicts"], pages=frame)
    verdict = {r["page_id"]: (r["rule"], r["verdict"]) for r in got.collect()}
    assert verdict[5] == ("example.com/en/", "block") and verdict[7] == ("www.example.com/en/", "allow") and verdict[4] == (None, "allow")
    assert verdict[15] == verdict[16] == (None, "block") and verdict[17] == (None, "allow")
    assert url_filter.url_verdicts(pages.limit(0), pages.limit(0)).count() == 0
    thin = pages.withColumn("html", F.when(F.col("page_id") == 4, "<a href=x>y</a>"))
    assert [r["page_id"] for r in url_filter.url_verdicts(thin, url_filter.spam_listed(thin)).filter("page_id = 4 and verdict = 'block'").collect()] == [4]
    assert url_filter.url_verdicts(pages, pages.select("url").limit(0)).filter("listed").count() == 0


def test_bloom_filter_loses_nothing_and_stops_most(spark):
    listed = spark.range(20_000).select(F.concat(F.lit("in"), "id").alias("canonical"))
    other = spark.range(20_000).select(F.concat(F.lit("out"), "id").alias("canonical"))
    n = 20_000 * url_filter.BITS_PER_URL // 256
    blocks = url_filter.bloom_blocks(listed, "canonical", n)
    assert url_filter.bloom_hits(listed, "canonical", blocks, n).count() == 20_000
    assert url_filter.bloom_hits(other, "canonical", blocks, n).count() < 400
    urls = listed.unionByName(other)
    assert url_filter.listed_matches(urls.unionByName(urls), listed).count() == 20_000


def check_shards(rows, source, n=8):
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in source)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    shards = defaultdict(list)
    for r in rows:
        shards[r["shard"]].append(r)
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    assert set(shards) <= set(range(n))
    for s in range(n):
        assert sorted(r["slot"] for r in shards[s]) == list(range(len(shards[s])))
        assert abs(sum(r["size"] for r in shards[s]) - total / n) <= 2 * largest
    inside = [r["doc_id"] for s in sorted(shards) for r in sorted(shards[s], key=lambda r: r["slot"])]
    assert inside == sorted(inside, key=lambda d: (d is not None, d or 0))


def test_shards_of_the_query(spark):
    source = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op9_byte_shards(spark, SF).collect()
    check_shards(rows, source)
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("bytes", None)}


def test_shard_edges(spark):
    docs = edge_docs(spark)
    check_shards(sharding.byte_shards(docs).collect(), [(d, t) for d, t, _ in EDGE])
    same = spark.createDataFrame([(1, "x" * 99)] * 1000 + [(None, None)] * 500, "doc_id long, text string")
    check_shards(sharding.byte_shards(same).collect(), [(1, "x" * 99)] * 1000 + [(None, None)] * 500)
    assert sharding.byte_shards(docs.limit(0)).count() == 0
