"""Packing token sequences by minimum bin slack (operator 8).

Documents are tokenised, each followed by the end id; only documents longer
than a sequence are cut. The pieces are then packed bin by bin: a bin starts
with a longest piece left, and a bitset subset-sum over the lengths that are
still available finds the combination that fills the rest of the bin most.
That combination is taken out and the next bin begins.

Only lengths matter for this, and there are at most ``capacity`` of them, so
the plan is made from the histogram of lengths. A combination stays the
fullest one for its first piece as long as its lengths last, so it is taken
out as many times at once as the histogram allows. The plan has a bounded
number of rows whatever the input's size.

Spark then hands the places out: a piece's number among all pieces of its
length (its number inside its task plus those of earlier tasks) picks one
plan row, which gives the sequence and the offset. No length gathers in one
task, and token ids are not shuffled for the placement.

Defined cases: a null or empty text is one piece holding only the end id;
repeated rows are packed each; an empty table gives no rows. Columns other
than id and text are not read.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections import Counter
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import tidy, written

CAPACITY = 2048
END_ID = 0
TOKENIZER = "word_bpe_49k.json"
#: Encoded words a task remembers; the memory is emptied when full.
CACHE_WORDS = 150_000
_ROWS = 512


#: Printable ASCII and the letters of Latin-1, none of which the tokenizer's normal form changes, between blanks.
_PLAIN = re.compile(r"[ \n!-~À-ÖØ-öø-ÿ]*")
_PLAIN_CHARACTERS = [chr(c) for c in range(0x21, 0x100) if _PLAIN.fullmatch(chr(c))]
# Fixed values of the tokenizer file: its pattern, and the same for lower-case texts of those characters.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \n]+")
#: What every special token of the file begins with.
_SPECIAL = "<|"


class _Encoded(dict):
    """Ids of strings, encoded on first use."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, part: str) -> bytes:
        data = self[part] = array("I", self._encode(part)).tobytes()
        return data


class WordEncoder:
    """Token ids as little-endian 32-bit integers, remembering each word's ids.

    The tokenizer joins nothing across the words of its own pattern, so a
    text's ids are those of its words in turn. A text of plain characters is
    lower-cased and split here, and its words go straight to the tokenizer's
    model. Any other text, or any of a tokenizer with another pattern, is cut at spaces and line feeds, which the tokenizer
    drops, and the parts go through the whole tokenizer.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self._known = _PATTERN in str(json.load(f)["pre_tokenizer"]).replace("\\\\", "\\")
        model = tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        level = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in _PLAIN_CHARACTERS}
        self._words = _Encoded(lambda word: [t.id for t in model.tokenize(word.translate(level))])
        self._parts = _Encoded(lambda part: tokenizer.encode(part, add_special_tokens=False).ids)
        self._limit = cache_words

    def _plain(self, text: str) -> bytes | None:
        if self._known and _PLAIN.fullmatch(text) and _SPECIAL not in text:
            return b"".join(map(self._words.__getitem__, _PLAIN_SPLIT.findall(text.lower())))
        return None

    def encode(self, text: str) -> bytes:
        out = self._plain(text)
        if out is None:
            parts = text.replace("\n", " ").split(" ")
            out = b"".join(self._parts[p] if (ids := self._plain(p)) is None else ids for p in parts)
        for cache in (self._words, self._parts):
            if len(cache) > self._limit:
                cache.clear()
        return out


def _tokenizer_path(path: str | None) -> str:
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def tokenise(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids, part, nth``: the pieces, written to shared scratch storage.

    ``tokenizer`` is the path of a tokenizer file on the executors (default:
    the public one named by ``TOKENIZER``). ``ids`` holds unsigned 32-bit
    little-endian integers. ``nth`` numbers the pieces of one length inside
    the task ``part`` from 0.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    end = np.asarray([end_id], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(_tokenizer_path(tokenizer))
        part = TaskContext.get().partitionId()
        numbers: Counter[int] = Counter()
        for whole in batches:
            for lo in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(lo, _ROWS)
                row, piece, start, length, nth, ids = [], [], [], [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    data = (encoder.encode(text) if text else b"") + end
                    for k, at in enumerate(range(0, len(data), step)):
                        cut = data[at:at + step]
                        n = len(cut) // 4
                        row.append(i)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(n)
                        nth.append(numbers[n])
                        ids.append(cut)
                        numbers[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array([part] * len(row), pa.int32()), pa.array(nth, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "nth"],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids binary, part int, nth bigint"
    return written(rows.mapInArrow(tidy(run), schema), "pack-pieces")


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """Lengths from ``counts`` (length to how many) with the largest sum of at most ``room``.

    Bit s of ``reach`` tells that sum s can be made; one shift per piece. The
    search ends early once the room can be filled exactly.
    """
    mask, target = (1 << (room + 1)) - 1, 1 << room
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            grown = (reach | (reach << length)) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
        if reach & target:
            break
    left, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> left & 1:
            chosen.append(length)
            left -= length
    return chosen


def plan_bins(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """``(lengths in one bin, how many such bins)`` by minimum bin slack, until all pieces are used."""
    left = Counter({int(k): int(v) for k, v in counts.items() if v})
    plan = []
    while left:
        seed = max(left)
        left[seed] -= 1
        rest = fullest({k: v for k, v in left.items() if v}, capacity - seed)
        left[seed] += 1
        need = Counter([seed, *rest])
        times = min(left[k] // n for k, n in need.items())
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        plan.append(([seed, *sorted(rest, reverse=True)], times))
    return plan


def _plan_rows(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first number, end number, copies per bin, first bin, offset)``: places for numbered pieces."""
    used: Counter[int] = Counter()
    rows, first_bin = [], 0
    for lengths, times in plan_bins(counts, capacity):
        offset = 0
        for length, copies in sorted(Counter(lengths).items(), reverse=True):
            rows.append((length, used[length], used[length] + copies * times, copies, first_bin, offset))
            used[length] += copies * times
            offset += copies * length
        first_bin += times
    return rows


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with ``length``, ``part``, ``nth`` and any others) with ``sequence_id`` and ``offset``."""
    spark = pieces.sparkSession
    per_task = written(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("_n")), "pack-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # capacity rows at most
    rows = [(*r[:2], r[2], r[3], r[4], r[5]) for r in _plan_rows(counts, capacity)]
    plan = spark.createDataFrame(rows, "_length bigint, _from bigint, _to bigint, _copies bigint, _bin bigint, _at bigint")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = pieces.join(before, ["length", "part"]).withColumn("_number", F.col("_before") + F.col("nth"))
    cond = (F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("_from")) & (F.col("_number") < F.col("_to"))
    at = F.col("_number") - F.col("_from")
    return numbered.join(F.broadcast(plan), cond).select(  # the plan's size is bounded by the capacity
        *pieces.columns,
        (F.col("_bin") + F.expr("(_number - _from) div _copies")).alias("sequence_id"),
        (F.col("_at") + F.pmod(at, F.col("_copies")) * F.col("length")).alias("offset"),
    )


def sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``sequence_id, n_tokens, ids, pieces``: the packed training sequences, ids in order of offset."""
    placed = place(tokenise(docs, tokenizer, capacity, end_id, id_col, text_col), capacity)
    piece = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    grouped = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("_p"), F.sum("length").alias("n_tokens"))
    return grouped.select(
        "sequence_id", "n_tokens",
        F.unhex(F.array_join(F.transform("_p", lambda p: F.hex(p["ids"])), "")).alias("ids"),
        F.transform("_p", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["start"].alias("start"),
                                             p["length"].alias("length"), p["offset"].alias("offset"))).alias("pieces"),
    )
