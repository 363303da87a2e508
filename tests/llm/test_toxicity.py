"""Classifier chain: held-out accuracy, out-of-fold features, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from ferry.llm import queries, toxicity
from ferry.llm.wordhash import NO_LETTER, WordHasher
from tests.conftest import SF

SF1 = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF1}/documents.parquet")
    labels = spark.read.parquet(f"{SF1}/labels.parquet").select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
    chain = ["low_quality", "toxic"]
    rows = toxicity.training_rows(docs, labels, chain, limit=3000)
    assert rows.count() == 3000
    found = toxicity.score(docs, toxicity.fit_chain(rows, chain), chain).join(labels, "doc_id").join(rows, "doc_id", "left_anti")
    p = [(r["toxic"], r["p_toxic"] >= toxicity.THRESHOLD) for r in found.collect()]
    caught = sum(hit for toxic, hit in p if toxic) / sum(toxic for toxic, _ in p)
    wrong = sum(hit for toxic, hit in p if not toxic) / sum(1 - toxic for toxic, _ in p)
    assert len(p) > 900 and caught >= 0.85 and wrong <= 0.01


def test_query_scores_every_document(spark):
    out = queries.op10_toxicity_chain(spark, SF)
    rows = out.collect()
    ids = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(ids)
    assert all(0 <= r["p_low_quality"] <= 1 and 0 <= r["p_toxic"] <= 1 and r["toxic"] == (r["p_toxic"] >= toxicity.THRESHOLD) for r in rows)
    assert sorted(map(tuple, queries.op10_toxicity_chain(spark, SF).collect())) == sorted(map(tuple, rows))


def test_features_are_the_distinct_words():
    import re

    texts = ["Good, good DAY 2you", None, "", "über-cool\tüber", "a" * 5_000_000 + " b", "x"]
    hasher = WordHasher(separator=NO_LETTER)
    flat, bounds = toxicity.features(texts, hasher)
    single = {w: int(toxicity.features([w], hasher)[0][0]) for t in texts if t for w in re.findall(r"[^\W\d_]+", t.lower())}
    for i, t in enumerate(texts):
        assert set(flat[bounds[i]:bounds[i + 1]].tolist()) == {single[w] for w in re.findall(r"[^\W\d_]+", (t or "").lower())}


def test_earlier_probabilities_are_out_of_fold_and_used():
    rng = np.random.default_rng(1)
    n = 400
    y = (np.arange(n) % 2).astype(float)
    flat, bounds = rng.integers(0, 50, 4 * n), np.arange(0, 4 * n + 1, 4)
    model = toxicity.fit(flat, bounds, np.column_stack([y * 0.9 + 0.05]), y)
    assert model.earlier[0] > 1
    p = model.logits(flat, bounds, np.column_stack([y * 0.9 + 0.05])) > 0
    assert (p == y).mean() > 0.95


def test_edge_rows_and_clashing_columns(spark):
    rows = [(i, f"common words here and there bad{'' if i % 2 else ' nasty'} n{i}") for i in range(60)] + [(100, None), (101, ""), (None, "nasty"), (5, "again common words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fold", F.lit("x")).withColumn("toxic", F.lit(3))
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(60)] + [(0, 1, 0), (7, None, 0), (999, 1, 0), (None, 1, 0)], "doc_id long, toxic int, other int")
    out = {(r["doc_id"], r["p_other"] > 0.5, r["p_toxic"] > 0.5) for r in toxicity.classify(docs, labels, ["other", "toxic"]).collect()}
    assert out >= {(i, False, i % 2 == 0) for i in range(60) if i != 5} and (None, False, True) in out
    assert toxicity.classify(docs, labels, ["other", "toxic"]).count() == len(rows)
    assert {r["p_toxic"] for r in toxicity.classify(docs, labels.limit(0), ["toxic"]).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), labels, ["toxic"]).count() == 0
