"""Nearest neighbours: recall against brute force, exact scores, ties between equal vectors, edge rows."""

import numpy as np
from pyspark.sql import functions as F

from ferry.llm import hnsw, queries
from tests.conftest import SF


def brute(rows, query_ids, k=5):
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], dtype=np.float64)
    v = v / np.linalg.norm(v, axis=1, keepdims=True)
    out = {}
    for q in query_ids:
        s = v @ v[np.flatnonzero(ids == q)[0]]
        order = sorted((-round(s[j], 12), int(ids[j])) for j in range(len(ids)) if ids[j] != q)
        out[q] = [(i, -d) for d, i in order[:k]]
    return out


def as_lists(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found = out.setdefault(r["query_id"], [])
        assert r["rank"] == len(found) + 1
        found.append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want])


def test_query_recall_and_scores(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0])
    got = as_lists(queries.op5_hnsw_neighbours(spark, SF).collect())
    assert set(got) == set(want) and recall(got, want) >= 0.97
    vec = {i: np.array(x, dtype=np.float64) for i, x in rows}
    for q, found in got.items():
        assert [s for _, s in found] == sorted((s for _, s in found), reverse=True)
        for i, s in found:
            assert abs(s - vec[q] @ vec[i] / np.linalg.norm(vec[q]) / np.linalg.norm(vec[i])) < 1e-12


def test_recall_over_many_shards_and_blocks(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 24))
    rows = [(i, (centres[i % 12] + 0.4 * rng.normal(size=24)).tolist()) for i in range(1500)]
    df = hnsw.clean(spark.createDataFrame(rows, "id long, v array<double>"), "id", "v")
    index = hnsw.build_index(df, 5, shard_rows=300)
    assert index.count() == 5
    ask = df.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    got = as_lists(hnsw.search(index, ask, 5, block_rows=8).collect())
    assert recall(got, brute(rows, list(range(0, 1500, 50)))) >= 0.95


def test_stored_graph_equals_the_built_one():
    v = hnsw.unit(np.random.default_rng(2).normal(size=(400, 8)))
    g = hnsw.Graph(v).build()
    back = hnsw.Graph.of(v, **g.flat())
    assert all(g.nearest(q, 20) == back.nearest(q, 20) for q in v[:20])


def test_equal_vectors_tie_to_smaller_ids(spark):
    rng = np.random.default_rng(8)
    same = [0.5, -1.0, 2.0]
    rows = [(i, same if i % 3 else rng.normal(size=3).tolist()) for i in range(300)]
    df = hnsw.clean(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    ask = df.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    got = as_lists(hnsw.search(hnsw.build_index(df, 5), ask, 5).collect())
    assert [i for i, _ in got[50]] == [1, 2, 4, 5, 7] and [i for i, _ in got[100]] == [1, 2, 4, 5, 7]
    assert all(abs(s - 1) < 1e-12 for _, s in got[50])


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 1.0]), (100, None), (150, [0.0, 0.0]), (200, [1.0, None]), (250, [nan, 1.0]), (300, [inf, 1.0]),
            (None, [1.0, 0.0]), (350, []), (400, [1.0, 2.0, 3.0]), (1, [0.0, 2.0]), (1, [0.0, 2.0]), (2, [1e200, 1e200])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("vec", F.lit(1)).withColumn("dim", F.lit("x"))
    clean = hnsw.clean(df, "vec_id", "embedding")
    ask = clean.filter("vec_id % 50 = 0").withColumnRenamed("vec_id", "query_id")
    got = as_lists(hnsw.search(hnsw.build_index(clean, 5), ask, 5).collect())
    assert {q: [i for i, _ in f] for q, f in got.items()} == {0: [2, 50, 1], 50: [2, 0, 1]}
    none = clean.limit(0)
    assert hnsw.search(hnsw.build_index(none, 5), none.withColumnRenamed("vec_id", "query_id"), 5).count() == 0
