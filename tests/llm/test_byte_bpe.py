"""Byte-level BPE against the tiktoken library."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from ferry.llm import byte_bpe, queries
from tests.conftest import SF


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(), special_tokens={})


def test_query_against_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for r in rows:
        ids = library.encode_ordinary(r["text"] or "")
        want.add((r["doc_id"], len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    got = queries.op11_byte_bpe(spark, SF).collect()
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_texts_of_all_kinds(spark, library):
    rng = random.Random(2)
    some = ["", " ", None, "a", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaab", "don't we'll I'M", "x y　 z\t\t\n\n  end  ", "日本語 ñandú Éç 🤖🤖🇪🇺 ١٢٣",
            "<|endoftext|>", " " * 500 + "x", "-" * 300, "".join(rng.choice("abcdefgh") for _ in range(2000)), "\x00\x01\x7f\u0085  "]
    some += ["".join(rng.choice("ab c'sé1\n!ß中") for _ in range(rng.randrange(60))) for _ in range(150)]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in enumerate(some)], "doc_id long, text string, ids int, word string")
    for hot in (0, 20):
        out = byte_bpe.encode(docs, hot=hot)
        assert out.columns == ["doc_id", "text", "word", "ids"]
        for r in out.withColumn("back", byte_bpe.decode(F.col("ids"))).collect():
            text = some[r["doc_id"]] or ""
            assert r["ids"] == library.encode_ordinary(text) and bytes(r["back"]) == text.encode()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode(docs).count() == 0


def test_words_are_merged_where_they_stand(spark, library):
    docs = spark.createDataFrame([(i, f"qxzv{i % 7} zzqj{i} " * 3) for i in range(300)], "doc_id long, text string")
    out = byte_bpe.encode(docs, hot=5)  # fewer than a worker meets
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "from_json" not in plan
    for r in out.collect():
        assert r["ids"] == library.encode_ordinary(r["text"])
