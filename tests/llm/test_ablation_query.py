"""The ablation query against its SQL."""

import duckdb

import __spark_entry__
from ferry.llm import quality
from tests.conftest import SF


def test_ablation_query_matches_its_sql(spark):
    got = __spark_entry__.queries()["op4_quality_ablation"](spark, SF)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(__spark_entry__.oracle_sql()["op4_quality_ablation"])
    assert got.columns == want.columns
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(want.fetchall()) and len(rows) == 7 and any(r[1] for r in rows)


def test_an_empty_table_gives_zeros_for_every_rule(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    rows = quality.ablation(quality.ledger(docs)).collect()
    assert {r["rule"] for r in rows} == set(quality.POLICIES[quality.CURRENT_POLICY])
    assert all((r["n_failed"], r["n_alone"], r["n_kept_without"]) == (0, 0, 0) for r in rows)
