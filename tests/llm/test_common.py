"""Scratch tables live as long as their scope; the salted join equals a plain one."""

import os

from pyspark.sql import functions as F

from ferry.llm.common import remove, salted_join, temporary_tables, written


def test_tables_go_with_their_scope_unless_kept(spark):
    with temporary_tables(spark):
        with temporary_tables(spark):
            gone, kept = written(spark.range(3), "a"), written(spark.range(4), "b", keep=True)
        assert not os.path.exists(gone._written_to) and kept.count() == 4
        early = written(spark.range(2), "c")
        remove(early)
    assert not os.path.exists(kept._written_to)
    left = written(spark.range(0), "d")
    assert left.count() == 0 and left.columns == ["id"]
    remove(left)


def test_salted_join_matches_nulls_and_keeps_every_row(spark):
    left = spark.createDataFrame([(i, "hot" if i % 3 else None, "x") for i in range(300)] + [(300, "alone", "x")], "id long, k string, v string")
    right = spark.createDataFrame([("hot", 1), (None, 2), ("unused", 3)], "k string, n int")
    got = salted_join(left, right, {"k": "k"}, F.xxhash64("id"), salts=7).collect()
    assert sorted((r["id"], r["n"]) for r in got) == [(i, 1 if i % 3 else 2) for i in range(300)] + [(300, None)]
