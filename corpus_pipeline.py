"""The corpus pipeline: five stages over ``documents``, each written and read again as the next one's input.

  1. quality      documents that the current rule policy rejects go
  2. near_dedup   one document of each group of near duplicates stays
                  (five-word shingles, similarity 0.8 or more)
  3. substrings   passages that an earlier document holds are cut out; n_chars
                  is set to the new length, and a text left without a word goes
  4. mix          each document is taken as often as its source's target asks
  5. pack         token sequences of at most 2048 ids

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ferry.llm import minhash_forest, mixing, packing, quality, substring_dedup
from ferry.llm.common import remove, temporary_tables, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.apply_policy(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_forest.remove_near_duplicates(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(docs, chars_col="n_chars" if "n_chars" in docs.columns else None)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.sequences(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("near_dedup", drop_near_duplicates),
    ("substrings", cut_repeated_passages),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: Near-duplicate search and tokenisation cannot be expressed in SQL; the tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES[:-1]):
        with temporary_tables(spark):
            last, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        if k:
            remove(last)
    return STAGES[-1][1](spark, docs, sf_dir)
