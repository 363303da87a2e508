"""Partly labelled documents in the classifier chain."""

from pyspark.sql import functions as F

from ferry.llm import toxicity


def test_partly_labelled_documents_train_the_categories_they_have(spark):
    docs = spark.createDataFrame([(i, f"common words here{' nasty' if i % 2 else ''} n{i}") for i in range(60)], "doc_id long, text string")
    # no document has both labels
    labels = spark.createDataFrame([(i, 0 if i < 30 else None, i % 2 if i >= 30 else None) for i in range(60)], "doc_id long, other int, toxic int")
    rows = toxicity.training_rows(docs, labels, ["other", "toxic"])
    assert rows.count() == 60 and rows.filter(F.col("toxic").isNull()).count() == 30
    assert toxicity.training_rows(docs, labels, ["other", "toxic"], limit=10).filter("toxic is not null").count() == 10
    out = toxicity.classify(docs, labels, ["other", "toxic"]).collect()
    assert {(r["doc_id"], r["p_other"] > 0.5, r["p_toxic"] > 0.5) for r in out} == {(i, False, i % 2 == 1) for i in range(60)}
    none = toxicity.classify(docs, labels.withColumn("other", F.lit(None).cast("int")), ["other", "toxic"]).collect()
    assert {r["p_other"] for r in none} == {0.0} and all((r["p_toxic"] > 0.5) == (r["doc_id"] % 2 == 1) for r in none)
