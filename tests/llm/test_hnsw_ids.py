"""Rows that repeat an id with different vectors; the stored k."""

import pytest

from ferry.llm import hnsw


def test_repeated_ids_with_different_vectors_are_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [1.0, 0.1]), (2, [1.0, 1.0]), (2, [1.0, 0.9]), (3, [-1.0, 0.0]), (4, [0.0, 1.0]), (4, [0.0, -1.0])]
    clean = hnsw.clean(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert clean.count() == len(rows)
    ask = clean.filter("vec_id in (0, 4)").withColumnRenamed("vec_id", "query_id")
    index = hnsw.build_index(clean, 3)
    got = {}
    for r in hnsw.search(index, ask, 3).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 3)))
    assert got == {0: [(1, 0.995), (2, 0.743), (4, 0.0)], 4: [(1, 1.0), (2, 0.707), (0, 0.0)]}
    with pytest.raises(ValueError):
        hnsw.search(index, ask, 4)
