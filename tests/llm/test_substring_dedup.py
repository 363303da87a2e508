"""Repeated passages: spans against a brute-force reading of the rule, planted passages, edge rows."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ferry.llm import queries
from ferry.llm import substring_dedup as sub
from tests.conftest import SF
from tests.llm.test_repeat_windows import faults


def test_query_against_windows_of_words(spark):
    rows = sorted((r[0], r[1]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    spans = [(r["doc_id"], r["start"], r["length"]) for r in queries.op2_repeated_passages(spark, SF).collect()]
    cut_wrongly, kept_wrongly, cut = faults(rows, spans)
    assert (cut_wrongly, kept_wrongly) == (0, 0) and cut > 1000


@pytest.mark.parametrize("min_words, cut_wrongly", [(20, True), (45, False)])
def test_another_rule_is_found_out(spark, min_words, cut_wrongly):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r[0], r[1]) for r in docs.select("doc_id", "text").collect())
    found = faults(rows, [(r["doc_id"], r["start"], r["length"]) for r in sub.find_repeats(docs, min_words=min_words).collect()])
    assert found[0 if cut_wrongly else 1] > 0


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9))) for _ in range(n))


def test_planted_passages_inside_lines(spark):
    rng = random.Random(5)
    sentence = lambda n: words(rng, n).capitalize() + "."
    passage = " ".join(sentence(9) for _ in range(7))  # 63 words
    unbroken = words(rng, 90)
    rows = []
    for i in range(40):
        body = [sentence(rng.randint(4, 20)) for _ in range(8)]
        if i % 5 == 1:
            body.insert(4, passage)
        if i % 5 == 2:
            body.insert(3, "And " + unbroken + ".")
        rows.append((i, " ".join(body[:5]) + "\n" + "\n".join(body[5:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = defaultdict(list)
    for r in sub.find_repeats(docs).collect():
        spans[r["doc_id"]].append(r)
    assert set(spans) == {i for i in range(40) if i % 5 in (1, 2)} - {1, 2}
    text = dict(rows)
    for i, found in spans.items():
        (span,) = found
        removed = text[i][span["start"]:span["start"] + span["length"]]
        assert removed in (passage if i % 5 == 1 else text[i])
        assert span["kept_in"] == i % 5 and span["n_words"] >= 50
        if i % 5 == 1:
            assert removed == passage


def test_edge_rows_ties_and_clashing_columns(spark):
    rng = random.Random(7)
    body = " ".join(words(rng, 10) + "." for _ in range(6))
    other = words(rng, 15) + "."
    rows = [(1, body), (1, body), (2, f"{other} {body}"), (None, body), (3, None), (4, ""), (5, " \n\t "), (6, body), (6, f"{body}\n{body}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("unit", F.lit("x")).withColumn("start", F.lit(1)).withColumn("n", F.length("text"))
    got = {(r["doc_id"], r["start"], r["length"], r["n_words"]) for r in sub.find_repeats(docs).collect()}
    n = len(body)
    assert got == {(2, len(other) + 1, n, 60), (None, 0, n, 60), (6, 0, n, 60), (6, 0, 2 * n + 1, 120)}
    out = sub.remove_repeats(docs, chars_col="n")
    assert out.columns == docs.columns
    kept = Counter((r["doc_id"], r["text"], r["n"]) for r in out.collect())
    assert kept == Counter({(1, body, len(body)): 2, (2, f"{other} ", len(other) + 1): 1, (3, None, None): 1, (4, "", 0): 1, (5, " \n\t ", 4): 1})
    assert sub.remove_repeats(docs.limit(0)).count() == 0


def test_very_long_text(spark):
    rng = random.Random(9)
    text = words(rng, 60_000)
    docs = spark.createDataFrame([(1, text), (2, "Start. " + text)], "doc_id long, text string")
    (span,) = sub.find_repeats(docs).collect()
    assert span["doc_id"] == 2 and span["n_words"] > 59_900
