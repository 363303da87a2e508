"""The whole chain against a plain dense one: words as strings, a column for each, loops over documents."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from ferry.llm import toxicity

CHAIN = ["rude", "threat"]


def dense_fit(words, earlier, y):
    """Logistic regression on dense columns, one a word, valued by the word's log ratio; Adam on all rows."""
    n = len(y)
    if n == 0 or len(set(y)) == 1:
        bias = 1e9 if n and y[0] else -1e9
        return lambda found, before: 1.0 if bias > 0 else 0.0
    ratio = {}
    for w in set().union(*words):
        having = [t for doc, t in zip(words, y) if w in doc]
        if len(having) >= toxicity.MIN_DOCUMENTS:
            inside = math.log((sum(having) + 1) / (sum(y) + 2))
            ratio[w] = inside - math.log((len(having) - sum(having) + 1) / (n - sum(y) + 2))
    names = sorted(w for w, r in ratio.items() if r != 0)

    def row(found, before):
        return [ratio[w] if w in found else 0.0 for w in names] + list(before) + [1.0]

    x, target = np.array([row(d, e) for d, e in zip(words, earlier)]), np.array(y, float)
    decay = np.array([toxicity.REGULARISATION] * (x.shape[1] - 1) + [0.0])  # the bias is not held back
    beta, first, second = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for step in range(1, toxicity.STEPS + 1):
        p = 1 / (1 + np.exp(-(x @ beta)))
        slope = x.T @ (p - target) / n + decay * beta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        beta = beta - toxicity.RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return lambda found, before: 1 / (1 + math.exp(-float(np.dot(row(found, before), beta))))


def dense_chain(texts, labels, folds):
    """Probabilities for every document: later models see out-of-fold ones in training, the final ones when scoring."""
    words = {i: set(re.findall(r"[a-z]+", (t or "").lower())) for i, t in texts.items()}
    held, scored = {i: [] for i in labels}, {i: [] for i in texts}
    for k, name in enumerate(CHAIN):
        def model(ids):
            ids = [i for i in ids if labels[i][k] is not None]
            return dense_fit([words[i] for i in ids], [held[i][:k] for i in ids], [labels[i][k] for i in ids])

        final = model(list(labels))
        parts = {f: model([i for i in labels if folds[i] != f]) for f in range(toxicity.FOLDS)}
        held = {i: held[i] + [parts[folds[i]](words[i], held[i])] for i in labels}
        scored = {i: p + [final(words[i], p)] for i, p in scored.items()}
    return scored


def test_chain_equals_a_dense_one(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te") for b in "bdfgk"]
    texts, labels = {}, {}
    for i in range(240):
        rude, threat = int(rng.random() < 0.4), 0
        found = list(rng.choice(vocabulary, rng.integers(3, 15)))
        if rude:
            found += list(rng.choice(["idiot", "fool"], 1))
            threat = int(rng.random() < 0.5)
            found += ["beware"] if threat and rng.random() < 0.7 else []
        texts[i] = " ".join(found)
        if i < 200:
            labels[i] = (rude if i % 11 else None, threat if i % 13 else None)
    texts |= {240: None, 241: "", 242: "beware " * 300_000 + "idiot", 243: "IDIOT, Fool!"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    told = spark.createDataFrame([(i, *y) for i, y in labels.items()], "doc_id long, rude int, threat int")
    fold = F.pmod(F.xxhash64("doc_id"), F.lit(toxicity.FOLDS))
    folds = {r[0]: r[1] for r in told.select("doc_id", fold).collect()}
    labels = {i: y for i, y in labels.items() if y != (None, None)}
    expected = dense_chain(texts, labels, folds)
    got = {r["doc_id"]: (r["p_rude"], r["p_threat"]) for r in toxicity.classify(docs, told, CHAIN).collect()}
    assert got.keys() == expected.keys()
    for i, p in expected.items():
        assert np.allclose(got[i], p, atol=2e-4), (i, got[i], p)
    assert max(abs(a - b) for a, b in expected.values()) > 0.2  # the links differ
