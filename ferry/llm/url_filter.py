"""URL verdicts from rules and a list of URLs (operator 7, native).

Rules name a host and a path prefix; a rule fits its host and all subdomains,
and the longest fitting rule wins. A URL without a fitting rule is looked up
in a list of canonical URLs:

  1. the list is hashed into a blocked Bloom filter: one row per 256-bit
     block, eight 32-bit words, one bit per word and URL, built by bitwise
     aggregation;
  2. every page looks up the one block its canonical URL hashes to, at the scan: the
     blocks are broadcast up to ``BROADCAST_BLOCKS``, beyond that joined by a
     salted shuffle. Pages that no rule fits and that may be listed are possible
     hits; all others are done and move nowhere;
  3. the distinct URLs of possible hits are joined with the list itself, which
     removes the false positives, so the verdict is exact.

Defined cases: a null URL, or one without ``://``, has empty host and path,
fits no rule, is not listed and is allowed; repeated URLs share a verdict; an
empty list allows what no rule blocks; an empty table gives no rows. Columns
other than id and URL are not read, but for the page's body by ``spam_listed``, where a null
body is not thin.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import LOWER, UPPER, salted_join, written

#: (verdict, host, path prefix); a longer host and path together win.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Host labels that put a page's URL on the spam list of the registered query.
SPAM_TERMS = ("casino", "pills", "xxx", "warez")
#: A page with a link for fewer than this many characters is put on the list as well.
CHARS_PER_LINK = 200
#: Blocks (40 bytes each) that are broadcast; more are joined by a shuffle.
BROADCAST_BLOCKS = 500_000
BITS_PER_URL = 16
_WORDS = 8
_BLOCK_BITS = 32 * _WORDS


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_of(url: Column) -> Column:
    """Host without ``www.``, path without trailing slashes; scheme, query and fragment dropped. Null without a host."""
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), r"/+$", "")))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``rule, verdict`` of the longest fitting rule; null if none fits."""
    best = None
    for verdict, rule_host, prefix in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), len(r[1]))):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(prefix)
        hit = F.struct(F.lit(f"{rule_host}{prefix}").alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, hit) if best is None else F.when(fits, hit).otherwise(best)
    return best if best is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks).cast("bigint"))


def _masks(key: Column) -> list[Column]:
    """One bit in each of the block's words, from eight 5-bit fields of a second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    fields = [F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(_WORDS)]
    return [F.call_function("shiftleft", F.lit(1), f) for f in fields]


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """``block, w0 .. w7``: the filter of the values of ``key``, one row per block in use."""
    words = [F.bit_or(m).alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))]
    return listed.groupBy(_block(F.col(key), n_blocks).alias("block")).agg(*words)


def bloom_hits(urls: DataFrame, key: str, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """The rows of ``urls`` whose ``key`` may be listed."""
    found = [F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))]
    return (
        urls.join(blocks, _block(F.col(key), n_blocks) == F.col("block"))
        .filter(reduce(lambda a, b: a & b, found)).select(*urls.columns)
    )


def possible_hits(pages: DataFrame, key: str, blocks: DataFrame, n_blocks: int, salt: Column) -> DataFrame:
    """The rows of ``pages`` with ``_maybe``: whether ``key`` may be listed; a null one is not."""
    words = [F.col(f"_w{i}") for i in range(_WORDS)]
    named = blocks.select(F.col("block").alias("_at"), *[F.col(f"w{i}").alias(f"_w{i}") for i in range(_WORDS)])
    rows = pages.withColumn("_block", _block(F.col(key), n_blocks))
    if n_blocks <= BROADCAST_BLOCKS:
        found = rows.join(F.broadcast(named), F.col("_block") == F.col("_at"), "left")
    else:
        found = salted_join(rows, named, {"_block": "_at"}, salt)
    set_bits = reduce(lambda a, b: a & b, [w.bitwiseAND(m) == m for w, m in zip(words, _masks(F.col(key)))])
    maybe = F.col(key).isNotNull() & F.coalesce(set_bits, F.lit(False))
    return found.select(*pages.columns, maybe.alias("_maybe"))


def listed_matches(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """``canonical`` of distinct ``urls.canonical`` that stand in ``listed.canonical``: the exact hash join."""
    distinct = urls.select("canonical").filter(F.col("canonical").isNotNull()).distinct()
    return distinct.join(listed.select("canonical").hint("shuffle_hash"), "canonical", "left_semi")


def url_verdicts(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                 id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, listed``: ``listed.url`` holds the URLs to block."""
    url = F.col(f"`{url_col}`")
    parts = pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"),
                         canonical_of(url).alias("canonical"))
    judged = parts.withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    exact = written(listed.select(canonical_of(F.col("url")).alias("canonical")).filter(F.col("canonical").isNotNull()).distinct(), "url-list")
    n_blocks = max(1, -(-exact.count() * BITS_PER_URL // _BLOCK_BITS))
    spread = F.xxhash64("page_id")
    seen = possible_hits(judged, "canonical", bloom_blocks(exact, "canonical", n_blocks), n_blocks, spread)
    maybe = F.col("_rule").isNull() & F.col("_maybe")
    hits = seen.filter(maybe).drop("_maybe")
    checked = salted_join(hits, listed_matches(hits, exact).withColumn("_listed", F.lit(True)), {"canonical": "canonical"}, spread)
    done = seen.filter(~maybe).drop("_maybe").withColumn("_listed", F.lit(None).cast("boolean"))
    by_list = F.coalesce(F.col("_listed"), F.lit(False))
    return done.unionByName(checked).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(by_list, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        by_list.alias("listed"),
    )


def spam_listed(pages: DataFrame, terms: Sequence[str] = SPAM_TERMS, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``url`` of pages whose host has a label that starts with a spam term, or whose body is thin: a link for fewer than ``CHARS_PER_LINK`` characters."""
    url, html = F.col(f"`{url_col}`"), F.col(f"`{html_col}`").cast("string")
    links = F.regexp_count(html, F.lit("<a "))
    thin = F.coalesce(links * CHARS_PER_LINK > F.length(html), F.lit(False))
    return pages.filter(host_of(url).rlike(rf"(^|\.)({'|'.join(terms)})") | thin).select(url.alias("url"))
