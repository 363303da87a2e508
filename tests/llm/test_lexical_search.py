"""Ranked lexical search against scores of all documents."""

import math
import random
import re
from collections import Counter

import pytest

from ferry.llm import lexical_search as search
from ferry.llm import queries
from tests.conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=20):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_all, l_all = len(bags), sum(n for *_, n in bags)
    df = Counter(x for _, b, _ in bags for x in b)
    out = []
    for item, text in set(items):
        asked = {x: (c, math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[x] + 1)))) for x, c in Counter(terms(text)).items() if df[x]}
        scores = []
        for d, b, n in bags:
            m = 100 - 25 + 25 * n * n_all // l_all
            score = sum(c * w * (10**9 * b[x] // (1000 * b[x] + 12 * m)) for x, (c, w) in asked.items() if x in b)
            if score > 0:
                scores.append((-score, d is None, d))
        out += [(item, i + 1, d, -s) for i, (s, _, d) in enumerate(sorted(scores, key=lambda x: (*x[:2], x[2] or 0))[:k])]
    return Counter(out)


def test_query_against_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert Counter(map(tuple, queries.op13_lexical_search(spark, SF).collect())) == brute(docs, items)


@pytest.mark.parametrize("shard_terms, window, short", [(40, 1, 4), (300, 3, 1), (2000, 8, 1000), (10**6, 1024, 4)])
def test_shards_and_windows_of_any_size(spark, monkeypatch, shard_terms, window, short):
    monkeypatch.setattr(search, "WINDOW", window)
    monkeypatch.setattr(search, "SHORT", short)
    rng = random.Random(shard_terms)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    docs = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 5, 30])))) for i in range(700)]
    docs += [(3, docs[3][1]), (None, docs[5][1]), (None, None), (900, " -- "), (901, "w1 " * 5000), (902, "É É w1")]
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 12])))) for i in range(25)] + [(25, None), (26, "nowhere"), (1, "É w1"), (2, "w1 w1 W1")]
    items += items[:2]
    table = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, score int").repartition(3)
    monkeypatch.setattr(search, "SHARD_TERMS", shard_terms)
    index = search.build_index(table)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert Counter(map(tuple, search.search(index, asked, k=7).collect())) == brute(docs, items, 7)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "BLOCK_TERMS", 5)
    docs = [(i, f"a{i % 7} b{i % 3} c") for i in range(60)]
    items = [(i, f"a{i} b1") for i in range(9)]
    index = search.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    got = search.search(index, spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute(docs, items)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(search.build_index(docs.limit(0)), items).count() == 0
    assert search.search(search.build_index(docs), items.limit(0)).count() == 0
    assert [tuple(r) for r in search.search(search.build_index(docs), items).collect()] == list(brute([(1, "a b")], [(1, "a")]))
