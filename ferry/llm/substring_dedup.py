"""Removal of repeated passages by hashing windows of content-chosen units (operator 2).

A text is cut into units: at its line ends and sentence ends, and in a sentence
before the word with the smallest hash (the first of equals) of any
``UNIT_WORDS`` words that follow each other, so that equal passages are cut
alike wherever they stand, but for their first and last words. What is looked up are windows: from
each unit on, and back from each unit, the fewest whole units that hold
``min_words`` words. Their words (lower case, single spaces) are hashed to 64
and 32 bits. Digests are grouped over the corpus; the occurrence with the
smallest document id, and in it the first, is kept. The union of all other
occurrences is removed. So whatever goes stands in a stretch of at least
``min_words`` words that an earlier document, or the same one before, holds
word for word, whichever document holds its parts; stock phrases that happen
to follow each other are left. Spans carry offsets (in code points) into the
original text.

A passage that starts and ends anywhere keeps at most ``UNIT_WORDS - 1`` words
before its first cut and ``UNIT_WORDS`` after its last, so from
``min_words + 2 * UNIT_WORDS - 1`` words on (51) it is always found.

The global step moves one digest and id per window (about 1.2 a unit),
combined inside each task first; a line found in a third of all documents is
one row per task. Only windows that repeat go further. Texts are cut twice
instead of writing a table of all windows.

Defined cases: a null, empty or blank text has no units; null ids rank last;
rows that share an id, or have none, rank by ``xxhash64`` of their texts, and
rows equal in id and text share their spans; an empty table gives no rows; a text
removed whole is dropped by ``remove_repeats``. The letter U+0130, whose lower
case is two characters, stays as it is. Columns other than id and text are only
carried by ``remove_repeats``.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm import wordhash
from ferry.llm.common import BLANKS, rows_as_struct, temporary_tables, tidy, written
from ferry.llm.wordhash import blocks, mix64

MIN_WORDS = 30
#: No unit has more words; must stay below the smallest useful ``min_words``. With 11, whole units hold at
#: least 30 words of any passage of 51, wherever it starts and ends.
UNIT_WORDS = 11
#: Rows taken from a batch at a time, and the longest power tables kept between blocks.
_ROWS, _KEPT_POWERS = 512, 2 * wordhash.BLOCK_BYTES
_LAST_ID = 2**63 - 1
#: Blanks of Unicode by code point; the last entry stands for all greater ones.
_SPACE = np.array([chr(c).isspace() for c in range(0x3002)])
_SALT = np.uint64(0xD6E8FEB86659FD93)
_HIGH = np.uint64(0xFFFFFFFF00000000)

WINDOWS = ("doc_id bigint, text_key bigint, unit int, n_units int, word int, n_words int, start bigint, length bigint, "
           "digest bigint, check int, first boolean")


class Cuts(NamedTuple):
    """Words and units of some texts, numbered through; offsets are into the lowered texts, joined by line ends."""

    joined: str
    text_at: np.ndarray  # first character of each text
    starts: np.ndarray  # first character of each word
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # text i has the words from bounds[i] to bounds[i + 1]
    units: np.ndarray  # first word of each unit


def _lower(text: str) -> str:
    """Lower case with as many characters."""
    low = text.lower()
    return low if len(low) == len(text) else "\u0130".join(part.lower() for part in text.split("\u0130"))


class Cutter:
    """Cuts batches of texts; keeps power tables of a block's size between calls."""

    def __init__(self):
        self._pow = self._inv = np.ones(1, dtype=np.uint64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n <= len(self._pow):
            return self._pow[:n], self._inv[:n]
        tables = wordhash._powers(wordhash._BASE, n), wordhash._powers(wordhash._BASE_INV, n)
        if n <= _KEPT_POWERS:
            self._pow, self._inv = tables
        return tables

    def cut(self, texts: Sequence[str]) -> Cuts:
        joined = "\n".join(map(_lower, texts)) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        blank = _SPACE[np.minimum(codes, len(_SPACE) - 1)]
        after = np.concatenate(([True], blank[:-1]))
        starts, ends = np.flatnonzero(~blank & after), np.flatnonzero(blank & ~after)
        up, down = self.powers(len(codes))
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(codes + _SALT) * up)))
        hashes = mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        bounds = np.concatenate(([0], np.searchsorted(starts, text_ends)))

        n = len(starts)
        is_cut = np.zeros(n, dtype=bool)
        is_cut[bounds[:-1][bounds[:-1] < bounds[1:]]] = True
        last = codes[ends[:-1] - 1]
        lines = np.cumsum(codes == 10)
        is_cut[1:] |= (last == 46) | (last == 33) | (last == 63) | (lines[starts[1:]] > lines[ends[:-1] - 1])
        if n >= UNIT_WORDS:
            least, width = (hashes & _HIGH) | np.arange(n, dtype=np.uint64), 1
            while width < UNIT_WORDS:
                step = min(width, UNIT_WORDS - width)
                least, width = np.minimum(least[:len(least) - step], least[step:]), width + step
            sentences = np.append(np.flatnonzero(is_cut), n)
            inside = np.repeat(sentences[1:], np.diff(sentences))[:len(least)] >= np.arange(len(least)) + UNIT_WORDS
            is_cut[(least[inside] & ~_HIGH).astype(np.int64)] = True
        return Cuts(joined, np.concatenate(([0], text_ends[:-1])), starts, ends, hashes, bounds, np.flatnonzero(is_cut))


def units(text: str) -> Iterator[tuple[int, int, int, str]]:
    """``(start, end, number of words, normalised text)`` of a text's units in order."""
    c = Cutter().cut([text])
    for a, b in zip(c.units, [*c.units[1:], len(c.starts)]):
        start, end = int(c.starts[a]), int(c.ends[b - 1])
        yield start, end, int(b - a), " ".join(c.joined[start:end].split())


def windows(c: Cuts, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first unit, last unit, text)`` of every window of at least ``min_words`` words, in order."""
    first, last = c.units, np.concatenate((c.units[1:], [len(c.starts)]))  # words
    text = np.searchsorted(c.bounds, first, "right") - 1
    number = np.arange(len(first))
    until = np.searchsorted(last, first + min_words)  # the unit that completes the words
    since = np.searchsorted(first, last - min_words, "right") - 1
    onward = first + min_words <= c.bounds[text + 1]
    back = last - min_words >= c.bounds[text]
    back[back] = until[since[back]] != number[back]  # those found from their first unit already
    a, b = np.concatenate((number[onward], since[back])), np.concatenate((until[onward], number[back]))
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    return a, b, text[a]


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows and their texts, a block at a time; only a slice of a batch is ever held as Python strings."""
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            some = whole.slice(at, _ROWS)
            texts = [t or "" for t in some.column(2).to_pylist()]
            for lo, hi in blocks(texts):
                yield some.slice(lo, hi - lo), texts[lo:hi]


def _window_rows(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Cutter()
        for batch, texts in _blocks_of(batches):
            c = cutter.cut(texts)
            a, b, text = windows(c, min_words)
            begin, end = c.units[a], np.concatenate((c.units[1:], [len(c.starts)]))[b]  # words
            up, down = cutter.powers(len(c.starts))
            n_words, digests = end - begin, []
            for h in (c.hashes, mix64(c.hashes ^ _SALT)):
                prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * up)))
                digests.append(mix64((prefix[end] - prefix[begin]) * down[begin] + n_words.astype(np.uint64)))
            first = np.zeros(len(a), dtype=bool)
            first[np.unique(digests[0] ^ mix64(text.astype(np.uint64) + _SALT), return_index=True)[1]] = True
            start = c.starts[begin]
            take = pa.array(text, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 pa.array((a - np.searchsorted(c.units, c.bounds[text])).astype(np.int32)), pa.array((b - a + 1).astype(np.int32)),
                 pa.array((begin - c.bounds[text]).astype(np.int32)), pa.array(n_words.astype(np.int32)),
                 pa.array(start - c.text_at[text], pa.int64()), pa.array(c.ends[end - 1] - start, pa.int64()),
                 pa.array(digests[0].view(np.int64)), pa.array((digests[1] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                 pa.array(first)],
                names=["doc_id", "text_key", "unit", "n_units", "word", "n_words", "start", "length", "digest", "check", "first"],
            )

    return run


def find_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, start, length, n_units, n_words, kept_in``: the passages to remove.

    ``text_key`` is ``xxhash64`` of the text; ``kept_in`` is the document that
    keeps most of the passage's windows (the document itself for a passage that
    it repeats).
    """
    if min_words <= UNIT_WORDS:
        raise ValueError(f"min_words must be above {UNIT_WORDS}")
    with temporary_tables(docs.sparkSession):
        return written(_find_repeats(docs, min_words, id_col, text_col), "repeat-spans", keep=True)


def _find_repeats(docs: DataFrame, min_words: int, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    table = rows.mapInArrow(tidy(_window_rows(min_words)), WINDOWS)
    rank = F.coalesce("doc_id", F.lit(_LAST_ID))
    key = ["digest", "check"]
    repeated = written(  # written, so that the join below reads both sides by shuffle and a very common digest can be split
        table.groupBy(*key).agg(F.min(rank).alias("kept_in"), F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select(*key, "kept_in"),
        "repeat-digests",
    )
    found = table.join(repeated, key)
    lost = (F.col("kept_in") < rank) | ~F.col("first")
    shared = written(  # the few ids, mostly none, that different texts share
        rows.select(rank.alias("kept_in"), "text_key").groupBy("kept_in").agg(F.min("text_key").alias("least"), F.max("text_key").alias("most"))
        .filter(~F.col("least").eqNullSafe(F.col("most"))).select("kept_in"),
        "repeat-ids",
    )
    if not shared.isEmpty():
        ties = found.filter(F.col("kept_in") == rank).join(shared, "kept_in", "left_semi")
        ties = written(ties.groupBy(*key).agg(F.min("text_key").alias("kept_key")), "repeat-ties")
        found = found.join(ties, key, "left")
        lost = lost | F.coalesce((F.col("kept_in") == rank) & (F.col("text_key") > F.col("kept_key")), F.lit(False))
    lost = found.filter(lost).drop("kept_key")
    doc = ["doc_id", "text_key"]
    # equal rows give equal windows: one of each is enough, and all rows share the spans
    lost = lost.drop(*key, "first").repartition(*doc).dropDuplicates([*doc, "unit", "n_units"])
    ends = {"end": ("start", "length"), "end_unit": ("unit", "n_units"), "end_word": ("word", "n_words")}
    lost = lost.select(*doc, "start", "unit", "word", "kept_in", *[(F.col(a) + F.col(n)).alias(e) for e, (a, n) in ends.items()])
    order = Window.partitionBy(*doc).orderBy("unit", "end_unit")
    until = F.max("end_unit").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = lost.withColumn("new", F.coalesce(F.col("unit") > until, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(order))
    sides = [*[F.min(c).alias(c) for c in ("start", "unit", "word")], *[F.max(c).alias(c) for c in ends]]
    by_keeper = runs.groupBy(*doc, "run", "kept_in").agg(*sides, F.count(F.lit(1)).alias("n"))
    spans = by_keeper.groupBy(*doc, "run").agg(*sides, F.max_by("kept_in", F.struct("n", -F.col("kept_in"))).alias("kept_in"))
    kept_in = F.when(F.col("kept_in") != _LAST_ID, F.col("kept_in"))
    return spans.select(*doc, "start", (F.col("end") - F.col("start")).alias("length"), (F.col("end_unit") - F.col("unit")).cast("bigint").alias("n_units"),
                        (F.col("end_word") - F.col("word")).cast("bigint").alias("n_words"), kept_in.alias("kept_in"))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text",
                   chars_col: str | None = None) -> DataFrame:
    """The input rows without their repeated passages; rows left without a word are dropped.

    ``chars_col`` names a column to be set to the new length in characters.
    """
    spans = find_repeats(docs, min_words, id_col, text_col)
    per_doc = spans.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_spans"))
    rows = rows_as_struct(docs, [id_col, text_col]).select(
        "_row", F.col(f"`_{id_col}`").cast("bigint").alias("_id"), F.col(f"`_{text_col}`").alias("_text"))
    cond = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.xxhash64("_text") == F.col("text_key"))
    joined = rows.join(per_doc, cond, "left")
    end = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("_spans", i - 1)["start"] + F.get("_spans", i - 1)["length"])
    until = lambda i: F.coalesce(F.get("_spans", i)["start"], F.char_length("_text"))
    parts = F.transform(F.sequence(F.lit(0), F.size("_spans")),
                        lambda i: F.substr(F.col("_text"), (end(i) + 1).cast("int"), (until(i) - end(i)).cast("int")))
    cut = joined.select("_row", "_spans", F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(F.array_join(parts, "")).alias("_cut"))
    kept = cut.filter(F.col("_spans").isNull() | (F.char_length(F.translate("_cut", BLANKS, "")) > 0))
    new = F.col("_row").withField(f"`{text_col}`", F.col("_cut"))
    if chars_col:
        new = new.withField(f"`{chars_col}`", F.when(F.col("_spans").isNull(), F.col("_row")[chars_col])
                            .otherwise(F.char_length("_cut").cast(docs.schema[chars_col].dataType)))
    return kept.select(new.alias("_row")).select("_row.*")
