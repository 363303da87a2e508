"""Periodic runs of words, found in tiles of each period octave and stitched (operator 12).

A run is a stretch of words with smallest period q, as long as it can be, of at
least ``MIN_LENGTH`` words and ``MIN_TURNS`` periods. Two equal words q apart are
a match; a run of period q is a stretch of at least ``(MIN_TURNS - 1) * q``
matches in a row.

The periods are split into octaves ``(S / 2, S]`` (the first one is 1 to
``FIRST_SPAN``). For every octave a text is exploded into overlapping tiles of 3 S
words, one for each boundary at a multiple of S: the words from S before it to
2 S after it. A run of the octave has at least S matches in a row, so one of its
matches starts on a boundary. A tile that holds no such stretch cannot help;
tiles where no word pair of the octave agrees for ``PROBE`` words on one side of
the boundary are not made at all (half of S matches lie on one side at least, and
S / 2 is never below ``PROBE``).

Tiles are dealt over the cluster and solved by themselves: a Z-function of the
tile from its boundary on, and one of its reversal, tell for every period how
far the matches reach to both sides. Stretches with a smaller period inside
their tile are multiples of another run's period and are left out. What is left
are interval fragments, at most S matches to each side; they are shuffled by
document and period and stitched where they overlap. Repeated rows give equal
fragments, which stitch to the same runs.

A text's words go to the digest of the collapsed text: of a run all words after
its first period are dropped. Texts without tiles are done in the first pass;
the others travel with their tiles and meet their runs by document id.

Words are compared by 64-bit hashes.

Defined cases: a null, empty or blank text has no words and no runs; rows that
share an id are told apart by ``xxhash64`` of their texts, rows equal in both
give equal results; null ids are ids; an empty table gives no rows; very long
texts are cut into tiles, no more than one text is held at a time. Columns other
than id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import WORD, tidy, written
from ferry.llm.wordhash import WordHasher, blocks

MIN_LENGTH, MIN_TURNS = 24, 3
#: The first octave has the periods from 1 on; with it, any run has as many matches in a row.
FIRST_SPAN = 16
#: Matches that a tile's boundary must have on one side.
PROBE = 8
#: Tiles in a record batch of the first pass, and rows taken from a batch at a time.
_TILES, _ROWS = 256, 512
_WORD = re.compile(WORD)

_PARTS = "doc_id bigint, text_key bigint, n_words bigint, words_sha256 string, text string, span int, at bigint, before int, words binary"
_RUNS = "array<struct<start:bigint,period:bigint,length:bigint>>"


def octaves(n: int) -> Iterator[tuple[int, int]]:
    """``(smallest period, span)`` of the octaves that a text of ``n`` words can have runs of."""
    low, span = 1, FIRST_SPAN
    while MIN_TURNS * low <= n and n >= MIN_LENGTH:
        yield low, span
        low, span = span + 1, 2 * span


def _agree(h: np.ndarray, a: np.ndarray, p: np.ndarray, lo: np.ndarray, hi: np.ndarray, step: int) -> np.ndarray:
    """Which pairs of places ``a`` and ``a + p`` hold equal words, and so do the ``PROBE - 1`` next ones in direction ``step``."""
    left = np.arange(len(a))
    for j in range(PROBE):
        x = a[left] + step * j
        left, x = left[ok := (x >= lo[left]) & (x + p[left] < hi[left])], x[ok]
        left = left[h[x] == h[x + p[left]]]
    return left


def candidate_tiles(h: np.ndarray, bounds: np.ndarray) -> dict[int, np.ndarray]:
    """For each octave's span the boundaries (places in ``h``) whose tile may hold part of a run; text i is ``h[bounds[i]:bounds[i + 1]]``."""
    out: dict[int, np.ndarray] = {}
    sizes = np.diff(bounds)
    for low, span in octaves(int(sizes.max(initial=0))):
        of = np.flatnonzero((sizes >= MIN_TURNS * low) & (sizes >= MIN_LENGTH))
        n = -(-sizes[of] // span)
        text = np.repeat(of, n)
        at = bounds[text] + span * (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n))
        found = []
        for part in np.array_split(np.arange(len(at)), max(1, len(at) * span >> 20)):  # a bounded grid at a time
            b, lo, hi = at[part], bounds[text[part]], bounds[text[part] + 1]
            grid = b[:, None] + np.arange(low, span + 1)[None, :]
            for step, first in ((1, 0), (-1, -1)):
                x = grid + first
                near = b + first
                same = (h[np.minimum(x, len(h) - 1)] == h[np.maximum(near, 0)][:, None]) & (x < hi[:, None]) & (near >= lo)[:, None]
                i, k = np.nonzero(same)
                ok = _agree(h, near[i], k + low, lo[i], hi[i], step)
                found.append(b[np.unique(i[ok])])
        boundaries = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        if len(boundaries):
            out[span] = boundaries
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every text, with the text itself if it has tiles, and a row for every tile."""
    hasher = WordHasher(lower=False)
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_words", pa.int64()), ("words_sha256", pa.string()),
                        ("text", pa.string()), ("span", pa.int32()), ("at", pa.int64()), ("before", pa.int32()), ("words", pa.binary())])
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            texts = [t or "" for t in batch.column(2).to_pylist()]
            data = [t.encode() for t in texts]
            for lo, hi in blocks(data):
                h, bounds = hasher.words(data[lo:hi])
                ids, keys = batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo)
                tiles = candidate_tiles(h, bounds)
                has = np.zeros(hi - lo, dtype=bool)
                for b in tiles.values():
                    has[np.searchsorted(bounds, b, "right") - 1] = True
                plain = [None if some else hashlib.sha256(" ".join(_WORD.findall(t)).encode()).hexdigest() for t, some in zip(texts[lo:hi], has)]
                nothing = pa.nulls(hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [ids, keys, pa.array(np.diff(bounds), pa.int64()), pa.array(plain, pa.string()),
                     pa.array([t if some else None for t, some in zip(texts[lo:hi], has)], pa.string()),
                     *[nothing.cast(f.type) for f in list(schema)[5:]]], schema=schema)
                for span, b in tiles.items():
                    for k in range(0, len(b), step := max(1, _TILES * FIRST_SPAN // span)):
                        some = b[k:k + step]
                        text = np.searchsorted(bounds, some, "right") - 1
                        first, last = np.maximum(some - span, bounds[text]), np.minimum(some + 2 * span, bounds[text + 1])
                        take = pa.array(text)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(take), keys.take(take), *[pa.nulls(len(some)).cast(f.type) for f in list(schema)[2:5]],
                             pa.array(np.full(len(some), span, np.int32)), pa.array(some - bounds[text], pa.int64()),
                             pa.array((some - first).astype(np.int32)),
                             pa.array([h[x:y].tobytes() for x, y in zip(first, last)], pa.binary())], schema=schema)


def z_function(s: list) -> list[int]:
    """For every place the length of the longest prefix of ``s`` that starts there."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(words: list, before: int, span: int) -> list[tuple[int, int, int]]:
    """``(period, first match, end of matches)`` relative to the boundary, at most ``span`` to each side."""
    low = 1 if span == FIRST_SPAN else span // 2 + 1
    ahead, behind = words[before:], words[:before]
    forward = z_function(ahead)
    back = z_function(behind[::-1] + [None] + words[:before + span][::-1])
    shift = 2 * before + 1 + min(span, len(ahead))  # where the reversed words from boundary + p - 1 down start: at shift - before - p

    def reach(p: int) -> tuple[int, int]:
        return min(back[shift - before - p], before), forward[p] if p < len(ahead) else 0

    out = []
    for p in range(low, min(span, len(ahead)) + 1):
        b, f = reach(p)
        f = min(f, span)
        if b + f < max(span, FIRST_SPAN):
            continue
        # the words of the stretch from -b to f + p; a smaller period of it divides p
        if not any(p % q == 0 and reach(q)[0] >= b and reach(q)[1] >= f + p - q for q in range(1, p // 2 + 1)):
            out.append((p, -b, f))
    return out


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(lo, _ROWS)
            rows, frags = [], []
            for i, (span, at, before, words) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2, 6)))):
                codes = np.unique(np.frombuffer(words, np.uint64), return_inverse=True)[1].tolist()
                for p, start, end in solve_tile(codes, before, span):
                    rows.append(i)
                    frags.append((p, at + start, at + end))
            take = pa.array(rows, pa.int64())
            period, start, end = zip(*frags) if frags else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *[pa.array(c, pa.int64()) for c in (period, start, end)]],
                names=["doc_id", "text_key", "period", "start", "end"])


def stitch(fragments: DataFrame) -> DataFrame:
    """Fragments ``doc_id, text_key, period, start, end`` -> one row for each run: ``doc_id, text_key, start, period, length``."""
    doc = ["doc_id", "text_key", "period"]
    order = Window.partitionBy(*doc).orderBy("start", "end")
    until = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    joined = fragments.withColumn("new", F.coalesce(F.col("start") > until, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(order))
    runs = joined.groupBy(*doc, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    length = F.col("end") - F.col("start") + F.col("period")
    return (runs.select("doc_id", "text_key", "start", "period", length.alias("length"))
            .filter(F.col("length") >= F.greatest(F.lit(MIN_LENGTH), MIN_TURNS * F.col("period"))))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(lo, _ROWS)
            out = []
            for text, runs in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                words = _WORD.findall(text)
                gone = np.zeros(len(words), dtype=bool)
                for r in runs or ():
                    gone[r["start"] + r["period"]:r["start"] + r["length"]] = True
                out.append(" ".join(w for w, g in zip(words, gone.tolist()) if not g))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), batch.column(4), pa.array(out, pa.string()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in out], pa.string())],
                names=["doc_id", "text_key", "n_words", "runs", "collapsed", "collapsed_sha256"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, n_words, runs, collapsed, collapsed_sha256`` for every row.

    ``runs`` has ``start, period, length`` in words, by start, then period.
    ``collapsed`` is the words that stay, joined by one space; it is null for
    a text without tiles, which keeps all its words. The digest is always there.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    parts = written(rows.mapInArrow(tidy(_parts), _PARTS), "run-tiles")
    tiles = parts.filter(F.col("words").isNotNull()).select("doc_id", "text_key", "span", "at", "before", "words")
    dealt = tiles.repartition(F.xxhash64("doc_id", "text_key", "span", "at"))
    fragments = dealt.mapInArrow(tidy(_solved), "doc_id bigint, text_key bigint, period bigint, start bigint, end bigint")
    runs = stitch(fragments)
    per_text = runs.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    per_text = per_text.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "runs")
    texts = parts.filter(F.col("words").isNull())
    tiled = texts.filter(F.col("text").isNotNull()).select("doc_id", "text_key", "n_words", "text")
    tiled = tiled.join(per_text, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_key") == F.col("_key")), "left")
    none = F.array().cast(_RUNS)
    tiled = tiled.select("doc_id", "text_key", "n_words", "text", F.coalesce("runs", none).alias("runs"))
    done = tiled.mapInArrow(tidy(_collapsed), f"doc_id bigint, text_key bigint, n_words bigint, runs {_RUNS}, collapsed string, collapsed_sha256 string")
    plain = texts.filter(F.col("text").isNull()).select(
        "doc_id", "text_key", "n_words", none.alias("runs"), F.lit(None).cast("string").alias("collapsed"), F.col("words_sha256").alias("collapsed_sha256"))
    return done.unionByName(plain)


def longest(column: str = "runs") -> Column:
    """The run with the greatest length over period; the first of equals. Null without runs."""
    none = F.lit(None).cast("struct<start:bigint,period:bigint,length:bigint>")
    more = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.aggregate(F.col(column), none, lambda best, x: F.when(more(best, x), x).otherwise(best))
