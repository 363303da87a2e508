"""Ranked lexical search over an inverted index in document shards (operator 13).

Terms are the runs of letters, digits and non-ASCII characters, A-Z lower-cased.
``build_index`` cuts the documents, where they lie, into shards of about
``SHARD_TERMS`` terms. A shard is one row of flat arrays: the documents' ids and
lengths, the sorted term hashes, each term's postings (documents in order, with
counts) and, to bound a list's scores without reading it, its largest count and
its shortest document.

``search`` answers items in blocks of at most about ``BLOCK_TERMS`` terms, which
go to the tasks; corpus figures (N, L and the document counts of the block's
terms) are sums over the whole index. In a shard an item is answered by a hybrid
of the two classic orders. Term at a time: the shortest lists, as long as they
have no more postings together than ``1 / SHORT`` of the shard's documents, are
summed into accumulators. These are from then on one more list, whose bound is
their largest sum. Document at a time: in windows of documents, only documents
from lists that could lift one into the first k (the essential ones: those left
when the lists with the smallest bounds are set aside as long as all bounds
together stay below the k-th score so far) are looked at; the other lists are
skipped to those documents, the greatest bound first, while the score plus
the bounds still open reaches the k-th score. The k-th score is carried on from
shard to shard of a task. Each task gives k rows an item; a rank window merges them.

Scores are whole numbers, so the result does not depend on shards or order.
Terms are compared by 64-bit hashes.

Defined cases: a null, empty or term-less text is in no list and not counted;
every row is a document of its own, also if ids repeat; a null id ranks last of
equal scores. Items that are equal in id and text are one item; items that share an id
only are answered each. An empty table, or items without terms, give no rows. A very
long document makes a shard by itself. Other columns are not read. Scores stay
within 64 bits as long as 25 * (longest document) * (documents) does.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import tidy, written
from ferry.llm.wordhash import WordHasher, blocks

#: Terms (with repeats) after which a shard is closed; bounds a task's memory.
SHARD_TERMS = 1_500_000
SHARD_DOCS = 1 << 16
#: Distinct terms, item by item, of the items that are answered in one pass over the index.
BLOCK_TERMS = 200_000
#: The accumulators take in short lists up to this part of a shard's documents.
SHORT = 4
#: Documents looked at before the bounds are compared with the k-th score again.
WINDOW = 1024
_ROWS = 512
#: Every ASCII byte that is neither letter nor digit.
_BETWEEN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_INDEX = ("n_docs bigint, n_terms bigint, ids array<bigint>, lengths binary, terms binary, starts binary, docs binary, counts binary, "
          "most binary, shortest binary")


def _hashed(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``(first column, term hashes, bounds)`` of blocks of rows."""
    hasher = WordHasher(separator=_BETWEEN)
    for whole in batches:
        for at in range(0, whole.num_rows, _ROWS):
            batch = whole.slice(at, _ROWS)
            texts = [(t or "").encode() for t in batch.column(column).to_pylist()]
            for lo, hi in blocks(texts):
                yield batch.column(0).slice(lo, hi - lo), *hasher.words(texts[lo:hi])


def _shard(ids: list[pa.Array], hashes: list[np.ndarray], lengths: list[np.ndarray]) -> pa.RecordBatch:
    length = np.concatenate(lengths)
    some = length > 0
    kept = length[some].astype(np.int32)
    doc = np.repeat(np.arange(len(kept)), kept)
    terms, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
    pairs, counts = np.unique(inverse * len(kept) + doc, return_counts=True)
    term, doc = np.divmod(pairs, max(1, len(kept)))
    starts = np.searchsorted(term, np.arange(len(terms) + 1))
    most = np.maximum.reduceat(counts, starts[:-1]) if len(terms) else counts
    shortest = np.minimum.reduceat(kept[doc], starts[:-1]) if len(terms) else counts
    all_ids = pa.concat_arrays(ids).filter(pa.array(some))
    as_bytes = [a.astype(t).tobytes() for a, t in ((kept, np.int32), (terms, np.uint64), (starts, np.int32), (doc, np.int32), (counts, np.int32),
                                                   (most, np.int32), (shortest, np.int32))]
    return pa.RecordBatch.from_arrays(
        [pa.array([len(kept)], pa.int64()), pa.array([int(kept.sum(dtype=np.int64))], pa.int64()),
         pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), all_ids), *[pa.array([b], pa.binary()) for b in as_bytes]],
        names=["n_docs", "n_terms", "ids", "lengths", "terms", "starts", "docs", "counts", "most", "shortest"])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids, hashes, lengths, n_terms, n_docs = [], [], [], 0, 0
    for some_ids, h, bounds in _hashed(batches, 1):
        if n_docs and (n_terms + len(h) > SHARD_TERMS or n_docs + len(some_ids) > SHARD_DOCS):
            yield _shard(ids, hashes, lengths)
            ids, hashes, lengths, n_terms, n_docs = [], [], [], 0, 0
        ids.append(some_ids)
        hashes.append(h)
        lengths.append(np.diff(bounds))
        n_terms, n_docs = n_terms + len(h), n_docs + len(some_ids)
    if n_docs:
        yield _shard(ids, hashes, lengths)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of all rows, written to shared scratch storage."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return written(rows.mapInArrow(tidy(_shards), _INDEX), "search-index")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, h, bounds in _hashed(batches, 1):
        item = np.repeat(np.arange(len(keys)), np.diff(bounds))
        order = np.lexsort((h, item))
        item, h = item[order], h[order]
        first = np.flatnonzero(np.concatenate(([True], (item[1:] != item[:-1]) | (h[1:] != h[:-1])))) if len(h) else np.empty(0, np.int64)
        times = np.diff(np.append(first, len(h)))
        yield pa.RecordBatch.from_arrays(
            [keys.take(pa.array(item[first])), pa.array(h[first].view(np.int64)), pa.array(times, pa.int64())], names=["item", "term", "times"])


def _counter(vocabulary: np.ndarray):
    """Document counts of the vocabulary's terms (sorted hashes), for each shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1)):
                terms, starts = np.frombuffer(terms.as_buffer(), np.uint64), np.frombuffer(starts.as_buffer(), np.int32)
                if len(terms):
                    at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
                    total += np.where(terms[at] == vocabulary, starts[at + 1] - starts[at], 0)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(vocabulary[seen].view(np.int64)), pa.array(total[seen])], names=["term", "df"])

    return run


class Shard:
    """One index row, with the scores' length part for the corpus figures."""

    def __init__(self, row: dict, n_all: int, l_all: int):
        self.ids = row["ids"].values
        view = lambda name, kind: np.frombuffer(row[name].as_buffer(), kind)
        self.terms, self.starts = view("terms", np.uint64), view("starts", np.int32)
        self.docs, self.counts = view("docs", np.int32), view("counts", np.int32)
        m = lambda n: 75 + 25 * n.astype(np.int64) * n_all // max(1, l_all)
        self.length_part = 12 * m(view("lengths", np.int32))
        most = view("most", np.int32).astype(np.int64)
        self.best = 1_000_000_000 * most // (1000 * most + 12 * m(view("shortest", np.int32)))

    def scores(self, lo: int, hi: int) -> np.ndarray:
        return self.scores_at(slice(lo, hi))

    def scores_at(self, at) -> np.ndarray:
        tf = self.counts[at].astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + self.length_part[self.docs[at]])


class Best:
    """The k best documents of an item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.null = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def least(self) -> int:
        """A lower score cannot be among them."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = np.concatenate((self.score, score)), np.concatenate((self.id, ids)), np.concatenate((self.null, null))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]


class _Accumulators:
    """The short lists' sums, read as one list."""

    def __init__(self, shard: Shard, lists: list[tuple[int, int]]):
        docs = np.concatenate([shard.docs[shard.starts[t]:shard.starts[t + 1]] for t, _ in lists])
        scores = np.concatenate([w * shard.scores(shard.starts[t], shard.starts[t + 1]) for t, w in lists])
        self.docs, inverse = np.unique(docs, return_inverse=True)
        self.sums = np.zeros(len(self.docs), np.int64)
        np.add.at(self.sums, inverse, scores)
        self.bound = int(self.sums.max())

    def at(self, places) -> np.ndarray:
        return self.sums[places]


class _Postings:
    """A long list; scores are worked out where it is read."""

    def __init__(self, shard: Shard, term: int, weight: int):
        self._shard, self._weight, self._lo = shard, weight, int(shard.starts[term])
        self.docs = shard.docs[self._lo:shard.starts[term + 1]]
        self.bound = weight * int(shard.best[term])

    def at(self, places) -> np.ndarray:
        places = slice(places.start + self._lo, places.stop + self._lo) if isinstance(places, slice) else places + self._lo
        return self._weight * self._shard.scores_at(places)


def search_shard(shard: Shard, lists: list[tuple[int, int]], best: Best, ids: np.ndarray, null: np.ndarray) -> None:
    """Add a shard's documents to an item's best; ``lists`` has the places of its terms in the shard and their weights."""
    sizes = np.diff(shard.starts)
    lists = sorted(lists, key=lambda x: sizes[x[0]])
    taken, held = 0, 0
    while taken < len(lists) and held + sizes[lists[taken][0]] <= len(ids) // SHORT:
        held += sizes[lists[taken][0]]
        taken += 1
    sources = [_Accumulators(shard, lists[:taken])] if taken else []
    sources += [_Postings(shard, t, w) for t, w in lists[taken:]]
    sources.sort(key=lambda s: s.bound)
    below = np.concatenate(([0], np.cumsum([s.bound for s in sources], dtype=np.int64)))  # of the first i lists together
    for lo in range(0, len(ids), WINDOW):
        first = int(np.searchsorted(below, best.least, "left")) - 1  # lists before it cannot make a document by themselves
        if first >= len(sources):
            return
        sums = np.zeros(min(WINDOW, len(ids) - lo), np.int64)
        touched = np.zeros(len(sums), bool)
        for s in sources[first:]:
            places = slice(*np.searchsorted(s.docs, (lo, lo + len(sums))))
            here = s.docs[places] - lo
            sums[here] += s.at(places)  # a document is in a list once
            touched[here] = True
        left = np.flatnonzero(touched)
        for i in range(first - 1, -1, -1):
            left = left[sums[left] + below[i + 1] >= best.least]
            if not len(left):
                break
            s = sources[i]
            place = np.searchsorted(s.docs, left + lo)
            hit = place < len(s.docs)
            hit[hit] = s.docs[place[hit]] == left[hit] + lo
            sums[left[hit]] += s.at(place[hit])
        left = left[sums[left] >= best.least]
        if len(left):
            best.add(sums[left], ids[left + lo], null[left + lo])


def _searcher(items: list[tuple[np.ndarray, np.ndarray]], n_all: int, l_all: int, k: int):
    """``items`` has each item's term hashes and weights."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                shard = Shard(row, n_all, l_all)
                ids, null = shard.ids.fill_null(0).to_numpy(zero_copy_only=False), shard.ids.is_null().to_numpy(zero_copy_only=False)
                if not len(shard.terms):
                    continue
                for mine, (terms, weights) in zip(best, items):
                    at = np.minimum(np.searchsorted(shard.terms, terms), len(shard.terms) - 1)
                    there = (shard.terms[at] == terms) & (weights > 0)
                    if there.any():
                        search_shard(shard, list(zip(at[there].tolist(), weights[there].tolist())), mine, ids, null)
        for i, mine in enumerate(best):
            if len(mine.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine.score), i, np.int64)), pa.array(mine.id, pa.int64(), mask=mine.null), pa.array(mine.score)],
                    names=["item", "doc_id", "score"])

    return run


def _search_block(index: DataFrame, rows: list, n_all: int, l_all: int, k: int) -> DataFrame:
    """``rows`` has ``item_id, text_key, term, times`` of a block's items, by item."""
    spark = index.sparkSession
    keys = list(dict.fromkeys((r["item_id"], r["text_key"]) for r in rows))
    number = {key: i for i, key in enumerate(keys)}
    vocabulary = np.unique(np.array([r["term"] for r in rows], np.int64).view(np.uint64))
    counts = index.select("terms", "starts").mapInArrow(tidy(_counter(vocabulary)), "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).collect()
    weight = {r["term"]: math.floor(1000 * math.log((2 * n_all + 2) / (2 * r["df"] + 1))) for r in counts}
    lists: list[tuple[list, list]] = [([], []) for _ in keys]
    for r in rows:
        if r["term"] in weight:
            terms, weights = lists[number[r["item_id"], r["text_key"]]]
            terms.append(r["term"])
            weights.append(weight[r["term"]] * r["times"])
    items = [(np.array(t, np.int64).view(np.uint64), np.array(w, np.int64)) for t, w in lists]
    found = index.select("ids", "lengths", "terms", "starts", "docs", "counts", "most", "shortest").mapInArrow(tidy(_searcher(items, n_all, l_all, k)), "item bigint, doc_id bigint, score bigint")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(keys)], "item bigint, item_id bigint")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(index: DataFrame, items: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's k best documents with a score above 0.

    Items are answered in blocks of about ``BLOCK_TERMS`` terms; a block's terms
    and weights are what goes through the driver to the tasks.
    """
    text = F.col(f"`{text_col}`").cast("string")
    asked = items.select(F.col(f"`{id_col}`").cast("bigint").alias("item_id"), F.xxhash64(text).alias("text_key"), text.alias("text")).distinct()
    keyed = asked.select(F.struct("item_id", "text_key").alias("item"), "text")
    terms = written(keyed.mapInArrow(tidy(_item_terms), "item struct<item_id:bigint,text_key:bigint>, term bigint, times bigint")
                    .select("item.*", "term", "times"), "search-items")
    figures = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    n_all, l_all = int(figures["n"] or 0), int(figures["l"] or 0)
    n_blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("item_id", "text_key"), F.lit(n_blocks))
    out = None
    for b in range(n_blocks):
        rows = terms.filter(block == b).orderBy("item_id", "text_key", "term").collect()
        found = _search_block(index, rows, n_all, l_all, k)
        out = found if out is None else out.unionByName(found)
    return out
