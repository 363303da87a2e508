"""The registered queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm import (
    byte_bpe, hnsw, lexical_search, minhash_forest, mixing, packing, periodic_runs, quality, sharding, substring_dedup, toxicity, url_filter, warc,
)
from ferry.llm.common import WORD, written
from ferry.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as a segmented archive and read back."""
    path = scratch_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    back = warc.read_warc(spark, path)
    payload = F.col("payload")
    return back.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.coalesce(F.octet_length(payload), F.col("payload_bytes")).cast("bigint").alias("payload_bytes"),
        F.coalesce(warc.base32_sha1(payload), F.col("header_digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("bigint").alias("refers_to"),
        "status",
    )


def op2_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage that is removed because an earlier document, or the same one before, holds it."""
    spans = substring_dedup.find_repeats(_table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start", "length", "n_units", "n_words", F.col("kept_in").alias("kept_in_doc_id"))


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates: three words a shingle, similarity 0.85 or more."""
    found = minhash_forest.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the verdict of the current policy for every document."""
    rows = quality.ledger(_table(spark, sf_dir, "documents"))
    bits = F.col("fail_bits")
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality.fails("v1", bits).alias("base_failed"), (~quality.fails(quality.CURRENT_POLICY, bits)).alias("kept"),
        "fail_bits",
    )


def op4_quality_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of the current policy does over all documents: failed, failed alone, kept without it."""
    return quality.ablation(quality.ledger(_table(spark, sf_dir, "documents")))


def op5_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest found for every vector whose id is divisible by 50, among all others."""
    rows = written(hnsw.clean(_table(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "ann-rows")
    queries = rows.filter(F.col("vec_id") % 50 == 0).withColumnRenamed("vec_id", "query_id")
    return hnsw.search(hnsw.build_index(rows, k=5), queries, k=5)


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document, with its source's size and target."""
    plan = mixing.plan_mix(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict: by rule, else blocked if its canonical URL is on the list of spam hosts' and thin pages' URLs."""
    pages = _table(spark, sf_dir, "pages")
    return url_filter.url_verdicts(pages, url_filter.spam_listed(pages)).select("page_id", "host", "path", "rule", "verdict")


def op8_minimum_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a packed sequence."""
    pieces = packing.tokenise(_table(spark, sf_dir, "documents"))
    placed = packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of near-equal bytes."""
    placed = sharding.byte_shards(_table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probabilities of low quality and, seeing that, of toxicity; and the verdict."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    scored = toxicity.classify(_table(spark, sf_dir, "documents"), labels, ["low_quality", "toxic"])
    return scored.withColumn("toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level ids and the bytes they decode to, as digests."""
    vocab = byte_bpe.vocabulary()
    rows = byte_bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text"), vocab)
    return rows.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decode(F.col("ids"), vocab), 256).alias("decoded_sha256"),
    )


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, with a period of words planted in every tenth document by the CRC-32 of its id."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), 0))
    rows = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    rows = rows.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    rows = rows.withColumn("p", F.when(n > 0, 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)).cast("int")))
    a, p = F.col("a"), F.col("p")
    changed = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", a + (i - a) % p)))
    return rows.select("doc_id", F.when(p.isNotNull(), F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's runs of repeated words, the most repeated one, and digests of the runs and of the text without them."""
    found = periodic_runs.find_runs(planted(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    every = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    found = found.withColumn("best", periodic_runs.longest())
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"),
        best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"), "collapsed_sha256", "n_words",
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    index = lexical_search.build_index(_table(spark, sf_dir, "documents"))
    return lexical_search.search(index, _table(spark, sf_dir, "benchmark"), k=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_round_trip": op1_warc_round_trip,
    "op2_repeated_passages": op2_repeated_passages,
    "op3_minhash_forest": op3_minhash_forest,
    "op4_quality_ledger": op4_quality_ledger,
    "op4_quality_ablation": op4_quality_ablation,
    "op5_hnsw_neighbours": op5_hnsw_neighbours,
    "op6_mix_sources": op6_mix_sources,
    "op7_url_verdicts": op7_url_verdicts,
    "op8_minimum_slack_packing": op8_minimum_slack_packing,
    "op9_byte_shards": op9_byte_shards,
    "op10_toxicity_chain": op10_toxicity_chain,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_lexical_search": op13_lexical_search,
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE_SQL: dict[str, str] = {
    "op1_warc_round_trip": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '') AS digest,
        min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, 'ok' AS status FROM d""",
    "op4_quality_ledger": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: length(translate(l, {_BLANKS}, '')) > 0) AS ls
           FROM documents),
tok AS (SELECT rid, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (SELECT rid, i, t || ' ' || lead(t, 1) OVER o || ' ' || lead(t, 2) OVER o || ' ' || lead(t, 3) OVER o || ' ' || lead(t, 4) OVER o
          || ' ' || lead(t, 5) OVER o || ' ' || lead(t, 6) OVER o || ' ' || lead(t, 7) OVER o AS x
        FROM tok WINDOW o AS (PARTITION BY rid ORDER BY i)),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM win WHERE x IS NOT NULL) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(0, 8) r(k) GROUP BY rid),
m AS (SELECT d.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(text, {_BLANKS}, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, len(ls) AS n_lines,
        CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
        len(list_filter(list_zip(w[:-2], w[2:]), lambda p: p[1] = p[2])) AS n_same_words,
        len(regexp_extract_all(text, '\p{{Lu}}')) AS n_upper
      FROM d LEFT JOIN cov ON d.rid = cov.rid),
b AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (100 * n_symbols > 10 * n_words)::INT
        + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (word_chars > 15 * n_words OR word_chars < 2 * n_words)::INT
        + 32 * (100 * n_same_words > 30 * n_words)::INT + 64 * (100 * n_upper > 50 * word_chars)::INT AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       (fail_bits & 127) = 0 AS kept, fail_bits FROM b""",
    "op6_mix_sources": rf"""
WITH d AS (SELECT doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size,
    CAST(('0x' || substr(md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, ''))), 1, 13)) AS BIGINT)
      / 4503599627370496.0 AS u FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
sh AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
       FROM w WINDOW o AS (ORDER BY 3 * source_size / w, source NULLS LAST)),
t AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), max(share) OVER () * w) AS target FROM sh),
r AS (SELECT doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CAST(u < rate - floor(rate) AS INT)) AS BIGINT) AS taken FROM r""",
    "op7_url_verdicts": rf"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r,
  coalesce((length(html) - length(replace(html, '<a ', ''))) // 3 * 200 > length(html), false) AS thin FROM pages),
h AS (SELECT page_id, thin, coalesce(translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '') AS host,
             coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM p),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') END AS canonical,
  '.' || host AS dh FROM h),
v AS (SELECT *, CASE
    WHEN dh LIKE '%.www.example.com' AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN dh LIKE '%.example.com' AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN dh LIKE '%.net' AND path LIKE '/es/%' THEN 'net/es/'
    WHEN dh LIKE '%.net' AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN dh LIKE '%.com' AND path LIKE '/%' THEN 'com/' END AS rule FROM c),
l AS (SELECT DISTINCT canonical FROM c WHERE (thin OR regexp_matches(host, '(^|\.)(casino|pills|xxx|warez)')) AND canonical IS NOT NULL)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN canonical IN (SELECT canonical FROM l) THEN 'block' ELSE 'allow' END AS verdict
FROM v""",
}
_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE_SQL["op13_lexical_search"] = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS t FROM documents),
f AS (SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(sum(len(t)) AS BIGINT) AS l_all FROM d WHERE len(t) > 0),
tf AS (SELECT rid, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT rid, unnest(t) AS term FROM d) GROUP BY rid, term),
q AS (SELECT iid, item_id, term, CAST(count(*) AS BIGINT) AS times
      FROM (SELECT item_id, iid, unnest({_TERMS}) AS term FROM (SELECT *, row_number() OVER () AS iid FROM (SELECT DISTINCT item_id, text FROM benchmark)))
      GROUP BY iid, item_id, term),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_all + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM q) GROUP BY term), f),
m AS (SELECT rid, doc_id, 75 + (25 * CAST(len(t) AS BIGINT) * n_all) // l_all AS m FROM d, f WHERE len(t) > 0),
s AS (SELECT iid, item_id, rid, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (rid) GROUP BY iid, item_id, rid, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 20"""
ORACLE_SQL["op4_quality_ablation"] = f"""
WITH l AS ({ORACLE_SQL["op4_quality_ledger"]}),
r(rule, bit) AS (VALUES ('few_words', 1), ('repeated_windows', 2), ('symbols', 4), ('duplicate_lines', 8), ('word_length', 16),
  ('same_words', 32), ('upper_case', 64))
SELECT rule, count(*) FILTER ((fail_bits & bit) <> 0) AS n_failed, count(*) FILTER ((fail_bits & 127) = bit) AS n_alone,
       count(*) FILTER ((fail_bits & (127 - bit)) = 0) AS n_kept_without
FROM r LEFT JOIN l ON true GROUP BY rule"""
