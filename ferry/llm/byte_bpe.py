"""Byte-level BPE encoding and decoding (operator 11).

A text is cut into words by the vocabulary's pattern, in the JVM. The words go
to an Arrow function: those of a batch are numbered, each distinct one is merged
once, and the rows' ids are taken from there. A word that is a token is its own
id; else the leftmost pair of neighbouring pieces of the smallest rank is joined
until no pair is a token. The first ``HOT_WORDS`` words that a Python worker
meets it remembers, mostly frequent ones; this bounds its memory only, every
other word is merged anew in each batch, with the same result. Nothing is shuffled.

Decoding looks every id up in a literal array of pieces, joins the pieces and
turns the characters back into bytes.

The pattern runs in the JVM's regular expressions with Unicode classes on. They
know the letters and digits of the JVM's Unicode version (13 in Java 17); later
ones count as symbols.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows are
encoded one by one, so ties and repeated rows do not matter; a very long word
costs the square of its length; an empty table gives no rows. All input columns
are kept, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
from typing import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import rows_as_struct

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Words that a Python worker remembers with their ids, of at most ``HOT_BYTES`` bytes.
HOT_WORDS = 200_000
HOT_BYTES = 64
NO_RANK = 2**31 - 1
_LATIN = "ISO-8859-1"


def read_ranks(path: str | None = None) -> dict[bytes, int]:
    """The tokens and ranks of a vocabulary file; by default the public one named by ``VOCABULARY``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def merge(word: bytes, ranks: Mapping[bytes, int]) -> list[int | None]:
    """The ids of one word."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    cuts = list(range(len(word) + 1))
    pairs = [ranks.get(word[i:i + 2], NO_RANK) for i in range(len(word) - 1)]  # ranks of pieces i and i + 1 joined
    while pairs and (least := min(pairs)) < NO_RANK:
        i = pairs.index(least)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(word[cuts[i]:cuts[i + 2]], NO_RANK)
        if i:
            pairs[i - 1] = ranks.get(word[cuts[i - 1]:cuts[i + 1]], NO_RANK)
    return [ranks.get(word[start:end]) for start, end in zip(cuts, cuts[1:])]


#: Remembered words of this worker, by vocabulary.
_known: dict[str, dict[str, list]] = {}


def _batch_ids(lists: pa.Array, ranks: Mapping[bytes, int], known: dict[str, list], hot: int) -> pa.Array:
    """The ids of each row's words, for an array of lists of words."""
    words = lists.flatten().dictionary_encode()
    ids = []
    for word in words.dictionary.to_pylist():
        found = known.get(word)
        if found is None:
            piece = word.encode()
            found = merge(piece, ranks)
            if len(known) < hot and len(piece) <= HOT_BYTES:
                known[word] = found
        ids.append(found)
    each = pa.array(ids, pa.list_(pa.int32())).take(words.indices)
    word_ends = np.concatenate([[0], np.cumsum(each.value_lengths().to_numpy(zero_copy_only=False))])
    row_ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    return pa.ListArray.from_arrays(pa.array(word_ends[row_ends.astype("int64")], pa.int32()), each.flatten())


class Vocabulary:
    """Ranks of byte strings as Spark expressions."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str):
        self.pattern = f"(?U){pattern}"
        self._pieces = {piece.decode("latin-1"): rank for piece, rank in ranks.items()}
        self._ranks = dict(ranks)
        self._name = hashlib.sha256(repr(sorted(self._ranks.items())).encode()).hexdigest()

    def words(self, text: Column) -> Column:
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), 0)

    def merge_all(self, words: Column, hot: int = HOT_WORDS) -> Column:
        """The ids (array of int) of a list of words; a worker remembers up to ``hot`` words."""
        ranks, name = self._ranks, self._name

        def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = _known.setdefault(name, {})
            for lists in batches:
                yield _batch_ids(lists, ranks, known, hot)

        return F.arrow_udf(run, "array<int>")(words)

    def pieces(self) -> Column:
        """Literal array of every id's bytes, as Latin-1 characters."""
        out = [""] * (max(self._pieces.values()) + 1)
        for piece, rank in self._pieces.items():
            out[rank] = piece
        return F.from_json(F.lit(json.dumps(out, ensure_ascii=False)), "array<string>")


def vocabulary(path: str | None = None, pattern: str | None = None) -> Vocabulary:
    return Vocabulary(read_ranks(path), pattern or default_pattern())


def encode(docs: DataFrame, vocab: Vocabulary | None = None, hot: int = HOT_WORDS, text_col: str = "text") -> DataFrame:
    """The input rows with ``ids`` (array of int) as a last column; an input column of that name is replaced."""
    vocab = vocab or vocabulary()
    rows = rows_as_struct(docs, [text_col]).select("_row", F.col(f"`_{text_col}`").cast("string").alias("_text"))
    keep = [F.col("_row")[c].alias(c) for c in docs.columns if c != "ids"]
    return rows.select("_row", vocab.merge_all(vocab.words(F.col("_text")), hot).alias("_ids")).select(*keep, F.col("_ids").alias("ids"))


def decode(ids: Column, vocab: Vocabulary | None = None) -> Column:
    """The bytes (binary) that the ids stand for."""
    table = (vocab or vocabulary()).pieces()
    return F.encode(F.array_join(_let(table, lambda pieces: F.transform(ids, lambda i: F.get(pieces, i))), ""), _LATIN)
