"""Near duplicates: components against brute force over all pairs, large groups, edge rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ferry.llm import minhash_forest as forest
from ferry.llm import queries
from ferry.llm.components import components
from tests.conftest import SF, SF01

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    n = min(n, len(words))
    return frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1))


def brute(rows, n, percent):
    """doc_id -> (set size, smallest id reachable), by counting common shingles of all pairs."""
    sets = [(d, shingles(t, n)) for d, t in rows]
    where, common = defaultdict(list), Counter()
    for i, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(i)
    for at in where.values():
        for k, i in enumerate(at):
            for j in at[k + 1:]:
                common[i, j] += 1
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (i, j), c in common.items():
        if 100 * c >= percent * (len(sets[i][1]) + len(sets[j][1]) - c):
            a, b = sorted((find(i), find(j)))
            root[b] = a
    low = {}
    for i, (d, _) in enumerate(sets):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: (len(s), low[find(i)]) for i, (d, s) in enumerate(sets)}


@pytest.mark.parametrize("sf", [SF, SF01])
def test_query_against_brute_force(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op3_minhash_forest(spark, sf).collect()}
    assert got == brute(rows, 3, 85)


def test_large_group_of_edited_copies(spark, monkeypatch):
    """A group beyond every limit of a task: regions are taken apart, clusters cut into blocks."""
    monkeypatch.setattr(forest, "CLUSTER", 100)
    rng = random.Random(3)
    vocabulary = ["w%d" % i for i in range(5000)]
    base = rng.choices(vocabulary, k=150)
    rows = [(0, " ".join(base))]
    for i in range(1, 900):
        text = list(base)
        for at in rng.sample(range(150), rng.randint(1, 9)):
            text[at] = rng.choice(vocabulary)
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(rng.choices(vocabulary, k=150))) for i in range(900, 1000)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == brute(rows, 3, 85)


def test_region_connects_what_its_signatures_allow():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, forest.SIZE, dtype=np.uint8)
    sig = np.repeat(base[None], 1500, axis=0)
    sig[:, forest.DEPTH:][rng.random((1500, forest.SIZE - forest.DEPTH)) < 0.1] = 7
    sig = sig[np.lexsort(sig.T[::-1])]
    assert len(set(forest.link_region(sig, forest.least_matches(85)).labels().tolist())) == 1


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, i) for i in range(1001, 1100)]
    links = spark.createDataFrame(path + star + [(5, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1100)}}
    assert components(links.limit(0)).count() == 0


def test_edge_rows_ties_and_clashing_columns(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    long_text = " ".join(f"l{i}" for i in range(60_000))
    rows = [(3, a), (3, a), (1, a.upper()), (None, a), (None, b), (None, b), (4, None), (5, ""), (6, " \n "), (7, "one"), (8, "ONE"),
            (9, long_text), (10, long_text + " end"), (11, b + " x"), (11, "quite another text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x")).withColumn("kept", F.lit(1))
    found = forest.near_duplicates(docs, 3, 85).collect()
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in found)
    assert got == Counter({
        (3, 58, 1, False): 2, (1, 58, 1, True): 1, (None, 58, 1, False): 1, (None, 58, 11, False): 2, (4, 0, 4, True): 1, (5, 0, 5, True): 1,
        (6, 0, 6, True): 1, (7, 1, 7, True): 1, (8, 1, 7, False): 1, (9, 59_998, 9, True): 1, (10, 59_999, 9, False): 1,
        (11, 59, 11, True): 1, (11, 1, 11, True): 1,
    })
    out = forest.remove_near_duplicates(docs, 3, 85)
    assert out.columns == docs.columns
    left = Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert left == Counter([(1, a.upper()), (4, None), (5, ""), (6, " \n "), (7, "one"), (9, long_text), (11, b + " x"), (11, "quite another text")])
    assert forest.near_duplicates(docs.limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, a), (None, a)], "doc_id long, text string")
    assert [r["component_id"] for r in forest.near_duplicates(nulls).collect()] == [None, None]
    assert forest.remove_near_duplicates(nulls).count() == 1
