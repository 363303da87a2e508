"""Packing: exact ids against the tokenizer, a valid tiling, few sequences, edge rows."""

import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ferry.llm import packing, queries
from tests.conftest import SF

PATH = public_tokenizers.path(packing.TOKENIZER)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@lru_cache
def both_encoders():
    return Tokenizer.from_file(PATH), packing.WordEncoder(PATH, cache_words=8)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\x0b\x1c  ́̈'seEÉßΣς.1|"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_ids_by_word_equal_ids_of_the_whole_text(text):
    whole, encoder = both_encoders()
    assert np.frombuffer(encoder.encode(text), dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("'<|>strvemdlSTRVEMDL \n"), st.characters(min_codepoint=0x20, max_codepoint=0x17F)), max_size=40))
def test_plain_parts_equal_the_whole_tokenizer(text):
    test_ids_by_word_equal_ids_of_the_whole_text.hypothesis.inner_test(text)


def test_special_tokens_and_awkward_parts():
    for text in ("<|endoftext|>", "a<|startoftext|>b c", "it's 12\u00b2 don'T \u00df\u00dc\u00fc\u00d0\u00de", "\u0130\u0131", "<|", "'S's"):
        test_ids_by_word_equal_ids_of_the_whole_text.hypothesis.inner_test(text)


def brute_fullest(counts, room):
    best = {0}
    for length, n in counts.items():
        for _ in range(n):
            best |= {s + length for s in best if s + length <= room}
    return max(best)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 4), max_size=8), st.integers(0, 60))
def test_fullest_matches_brute_force(counts, room):
    chosen = packing.fullest(counts, room)
    assert sum(chosen) == brute_fullest(counts, room)
    assert all(n <= counts[k] for k, n in Counter(chosen).items())


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=20))
def test_plan_uses_every_piece_once_and_never_overfills(counts):
    used = Counter()
    for lengths, times in packing.plan_bins(counts, 64):
        assert times >= 1 and sum(lengths) <= 64
        for k in lengths:
            used[k] += times
    assert used == Counter(counts)


def check_tiling(rows, capacity):
    bins, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
        docs[r["doc_id"]].append((r["piece"], r["start"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return bins, docs


def test_query_against_the_tokenizer(spark, tokenizer):
    rows = queries.op8_minimum_slack_packing(spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    bins, docs = check_tiling(rows, packing.CAPACITY)
    crc = {(r["doc_id"], r["piece"]): r["ids_crc32"] for r in rows}
    total = 0
    for doc_id, text in texts.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        total += len(ids)
        cuts = [ids[i:i + packing.CAPACITY] for i in range(0, len(ids), packing.CAPACITY)]
        assert sorted(docs[doc_id]) == [(k, k * packing.CAPACITY, len(c)) for k, c in enumerate(cuts)]
        for k, c in enumerate(cuts):
            assert crc[doc_id, k] == zlib.crc32(np.asarray(c, dtype="<u4").tobytes())
    assert len(bins) <= -(-total // packing.CAPACITY) + 2


def test_edge_rows_and_clashing_columns(spark, tokenizer):
    long_text = "word " * 9000
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (None, "a b", "x"), (3, long_text, "x"), (3, long_text, "x")],
        "doc_id long, text string, length string",
    ).withColumn("part", packing.F.lit(9)).withColumn("ids", packing.F.lit("z"))
    rows = packing.place(packing.tokenise(docs)).collect()
    check_tiling(rows, packing.CAPACITY)
    n = len(tokenizer.encode(long_text, add_special_tokens=False).ids) + 1
    assert sum(r["length"] for r in rows) == 1 + 1 + 3 + 2 * n
    packed = packing.sequences(docs, capacity=100).collect()
    assert sum(r["n_tokens"] for r in packed) == 1 + 1 + 3 + 2 * n
    assert all(len(r["ids"]) == 4 * r["n_tokens"] == 4 * sum(p["length"] for p in r["pieces"]) for r in packed)
    empty = packing.place(packing.tokenise(docs.limit(0)))
    assert empty.count() == 0
