"""Runs of words against a search over all periods."""

import hashlib
import random
import zlib

import pytest

from ferry.llm import periodic_runs, queries
from ferry.llm.common import WORD
from tests.conftest import SF

import re


def brute(w):
    """(start, period, length) of all runs: every period, smaller ones first."""
    n, found = len(w), {}
    for p in range(1, n // 3 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(24, 3 * p):
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, p, length) for (s, length), p in found.items())


def collapsed(w, runs):
    gone = {i for s, p, length in runs for i in range(s + p, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeating(rng):
    n, letters = rng.choice([0, 5, 23, 24, 25, 48, 80, 200, 500]), rng.choice([1, 2, 3, 50])
    w = [str(rng.randrange(letters)) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        if n:
            s, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
            for i in range(s + p, min(n, s + rng.randint(1, n))):
                w[i] = w[i - p]
    return " ".join(w)


def test_against_brute_force(spark):
    rng = random.Random(1)
    texts = [repeating(rng) for _ in range(400)] + [None, " \n", "a " * 24, "a " * 23, "İ i " * 12]
    got = {r["doc_id"]: r for r in periodic_runs.find_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    n = 0
    for i, t in enumerate(texts):
        w = re.findall(WORD, t or "")
        want = brute(w)
        n += len(want)
        assert [tuple(r) for r in got[i]["runs"]] == want and got[i]["n_words"] == len(w)
        assert got[i]["collapsed_sha256"] == sha(collapsed(w, want))
        assert got[i]["collapsed"] is None and not want or got[i]["collapsed"] == collapsed(w, want)
    assert n > 100


def test_long_texts_cross_many_tiles(spark):
    rng = random.Random(4)
    period = [str(rng.random()) for _ in range(1500)]
    noise = [str(rng.random()) for _ in range(700)]
    texts = [" ".join(["a"] * 30_000), " ".join(noise + period * 6 + period[:77] + noise), " ".join("ab"[i % 7 == 3] for i in range(9000))]
    got = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in
           periodic_runs.find_runs(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == {0: [(0, 1, 30_000)], 1: [(700, 1500, 9077)], 2: [(0, 7, 9000)]}


@pytest.mark.parametrize("words", [["a"] * 40, list("abcabcabdabcabcabd") * 4, list("abaababaabaab") * 6])
def test_z_function(words):
    want = [0] * len(words)
    for i in range(len(words)):
        while i + want[i] < len(words) and words[want[i]] == words[i + want[i]]:
            want[i] += 1
    assert periodic_runs.z_function(words) == want


def test_query_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        w = re.findall(WORD, r["text"] or "")
        h = zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = brute(w)
        best = min(runs, key=lambda x: (-x[2] / x[1], x[0], x[1]), default=(None,) * 3)
        x = got[r["doc_id"]]
        assert (x["n_runs"], x["start"], x["period"], x["length"]) == (len(runs), *best)
        assert x["exponent_milli"] == (1000 * best[2] // best[1] if runs else None)
        assert x["runs_sha256"] == sha("".join(f"{s},{n},{p}\n" for s, p, n in runs))
        assert x["collapsed_sha256"] == sha(collapsed(w, runs))


def test_ids_that_repeat_or_miss_and_clashing_columns(spark):
    rows = [(1, "a b " * 20), (1, "a b " * 20), (1, "c d e " * 20), (None, "f " * 30), (None, "plain words")]
    docs = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, period int, runs string")
    got = sorted((r["doc_id"] or 0, [tuple(x) for x in r["runs"]]) for r in periodic_runs.find_runs(docs).collect())
    assert got == [(0, []), (0, [(0, 1, 30)]), (1, [(0, 2, 40)]), (1, [(0, 2, 40)]), (1, [(0, 3, 60)])]
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0
