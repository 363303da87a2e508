"""Near-duplicate documents by an LSH forest over MinHash signatures (operator 3).

  1. Each document's word shingles give a digest of the set and a signature of
     ``SIZE`` MinHash values, one byte of each. Documents with equal sets are
     one node.
  2. The signature is sorted in ``ORDERS`` orders; order t is the signature
     rotated by t * ``STEP``. Nodes that share no prefix of ``DEPTH`` values
     with another in any order have no near duplicate and end here.
  3. The other nodes are range-partitioned and sorted per order, so neighbours
     are those with the longest common prefixes. In a region (a run with a
     common prefix) of up to ``REGION`` nodes all are compared by signature;
     a more crowded region is taken apart at deeper prefixes, and its nodes
     are also compared with their ``NEIGHBOURS`` nearest in the order and with
     the region's most central nodes. Pairs whose signatures agree nearly
     enough connect, and components of these pairs are candidate clusters.
  4. A cluster's texts are brought together and every pair that the
     signatures do not rule out is confirmed on the full shingle sets, unless
     it is already connected. A cluster too large for one task is cut into
     blocks, and each pair of blocks is a task of its own.
  5. Components of the confirmed links give the result.

A pair at the threshold is missed if it shares no prefix in any order, or if
its signatures agree 4.5 standard deviations less than expected: about one
pair in 100,000. The work of step 4 grows with the square of a cluster's
number of different texts, in signature comparisons of some nanoseconds.

Defined cases: a null text, or one without words, has an empty set and is
linked with nothing; null ids rank last, a component of null ids only has
component_id null; rows that repeat an id and a text share their component;
an empty table gives no rows. Columns other than id and text are only carried
by ``remove_near_duplicates``.
"""

from __future__ import annotations

import hashlib
import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import BLANKS, rows_as_struct, temporary_tables, tidy, written
from ferry.llm.components import components
from ferry.llm.wordhash import WordHasher, blocks, shingle_set

WORDS, PERCENT = 5, 80
SIZE, ORDERS, STEP, DEPTH = 128, 24, 5, 4
REGION, NEIGHBOURS, HUBS = 512, 64, 4
_SMALL = 4
#: Rows of the sorted order that a task holds at most.
_HELD = 4096
#: Weight of a cluster that one task confirms; larger ones are cut into blocks. A node weighs 1 and 1 more per 2,000 shingles.
CLUSTER = 2048
_LAST_ID = 2**63 - 1
_ROWS = 512

_RNG = np.random.Generator(np.random.PCG64(77))
_XOR = _RNG.integers(0, 2**32, SIZE, dtype=np.uint32)[:, None]
_MUL = (_RNG.integers(0, 2**31, SIZE, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]


# ------------------------------------------------------------------ inside tasks

def signature(shingles: np.ndarray) -> np.ndarray:
    """One byte of the smallest value of each of ``SIZE`` hash functions over a non-empty set."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(SIZE, 2**32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 1024):
        y = (x[None, at:at + 1024] ^ _XOR) * _MUL
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        y ^= y >> np.uint32(12)
        np.minimum(low, y.min(axis=1), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


def shingle_sets(texts: list[str | None], words: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    data = [(t or "").encode() for t in texts]
    for lo, hi in blocks(data):
        hashes, bounds = hasher.words(data[lo:hi])
        for i in range(hi - lo):
            yield shingle_set(hashes[bounds[i]:bounds[i + 1]], words)


def least_matches(percent: int) -> int:
    """Equal signature bytes that a pair at the threshold has, less 4.5 standard deviations."""
    p = percent / 100
    return max(1, math.floor(SIZE * p - 4.5 * math.sqrt(SIZE * p * (1 - p))))


class Union:
    """Disjoint sets over 0 .. n-1."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.root[max(i, j)] = min(i, j)

    def labels(self) -> np.ndarray:
        root = self.root
        while True:
            up = root[root]
            if np.array_equal(up, root):
                return root
            root = self.root = up


def centres(sig: np.ndarray) -> np.ndarray:
    """Rows by how many of their values are the most frequent of their column, best first."""
    if len(sig) < 3:
        return np.arange(len(sig))
    score = np.zeros(len(sig), dtype=np.int64)
    for k in range(sig.shape[1]):
        score += sig[:, k] == np.bincount(sig[:, k], minlength=256).argmax()
    return np.argsort(-score, kind="stable")


def _link_all(sig: np.ndarray, at: np.ndarray, least: int, sets: Union) -> None:
    for i in range(len(at) - 1):
        hits = np.flatnonzero((sig[at[i]] == sig[at[i + 1:]]).sum(axis=1) >= least)
        for j in hits:
            sets.join(at[i], at[i + 1 + j])


def link_region(sig: np.ndarray, least: int) -> Union:
    """Connect the rows of one region (sorted, sharing a prefix) whose signatures agree in ``least`` places."""
    n, sets = len(sig), Union(len(sig))
    runs = [(0, n, DEPTH)]
    while runs:  # deeper where it is crowded
        lo, hi, depth = runs.pop()
        if hi - lo <= REGION or depth == sig.shape[1]:
            if hi - lo <= REGION:
                _link_all(sig, np.arange(lo, hi), least, sets)
            continue
        cuts = np.flatnonzero(sig[lo + 1:hi, depth] != sig[lo:hi - 1, depth]) + lo + 1
        edges = [lo, *cuts.tolist(), hi]
        runs += [(a, b, depth + 1) for a, b in zip(edges, edges[1:]) if b - a > 1]
    if n > REGION:
        for step in range(1, min(NEIGHBOURS, n - 1) + 1):
            for i in np.flatnonzero((sig[:-step] == sig[step:]).sum(axis=1) >= least):
                sets.join(i, i + step)
        for hub in centres(sig)[:HUBS]:
            for i in np.flatnonzero((sig == sig[hub]).sum(axis=1) >= least):
                sets.join(hub, i)
    return sets


def _star(nodes: np.ndarray, sets: Union) -> tuple[np.ndarray, np.ndarray]:
    """Links of every node with the first of its set."""
    labels = sets.labels()
    rest = np.flatnonzero(labels != np.arange(len(labels)))
    return nodes[rest], nodes[labels[rest]]


def _neighbour_links(least: int):
    def region_links(order: np.ndarray, sig: np.ndarray, nodes: np.ndarray, final: bool) -> tuple[list, int]:
        """Links of the regions in a sorted stretch, and where its last region begins if more may follow."""
        new = np.ones(len(order), dtype=bool)
        new[1:] = (order[1:] != order[:-1]) | (sig[1:, :DEPTH] != sig[:-1, :DEPTH]).any(axis=1)
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(order))
        rest = len(order) if final or not len(starts) or ends[-1] - starts[-1] >= _HELD else int(starts[-1])
        whole = ends <= rest
        starts, ends = starts[whole], ends[whole]
        out = []
        for step in range(1, _SMALL):  # all small regions at once
            low = np.concatenate([np.arange(0, 0), *[starts[ends - starts == n] + k for n in range(step + 1, _SMALL + 1) for k in range(n - step)]])
            low = low[(sig[low] == sig[low + step]).sum(axis=1) >= least]
            if len(low):
                out.append((nodes[low], nodes[low + step]))
        large = ends - starts > _SMALL
        for lo, hi in zip(starts[large].tolist(), ends[large].tolist()):
            out.append(_star(nodes[lo:hi], link_region(sig[lo:hi], least)))
        if rest < len(order):
            return out, rest
        # a region that goes on beyond what a task holds overlaps with its next part
        return out, len(order) if final else max(len(order) - REGION, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, sig, nodes = np.empty(0, np.int64), np.empty((0, SIZE), np.uint8), np.empty(0, np.int64)

        def emit(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[k] for f in found]), pa.int64()) for k in (0, 1)], names=["a", "b"])

        for whole in batches:
            for at in range(0, whole.num_rows, _HELD):
                b = whole.slice(at, _HELD)
                order = np.concatenate([order, b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)])
                sig = np.concatenate([sig, np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, SIZE)])
                nodes = np.concatenate([nodes, b.column(2).to_numpy(zero_copy_only=False)])
                found, rest = region_links(order, sig, nodes, final=False)
                order, sig, nodes = order[rest:], sig[rest:], nodes[rest:]
                if found:
                    yield emit(found)
        found, _ = region_links(order, sig, nodes, final=True)
        if found:
            yield emit(found)

    return run


def confirm(sets: list[np.ndarray], sig: np.ndarray, side: np.ndarray | None, percent: int) -> Union:
    """Connect the sets with 100 * intersection >= percent * union.

    ``side`` (0 or 1) limits the comparison to pairs from both sides. Central
    sets come first: once they connect a group, its other pairs are not needed.
    """
    n, least = len(sets), least_matches(percent)
    joined, size = Union(n), np.array([len(s) for s in sets])
    todo = centres(sig)
    for k in range(n - 1):
        i, rest = todo[k], todo[k + 1:]
        near = 100 * np.minimum(size[i], size[rest]) >= percent * np.maximum(size[i], size[rest])
        if side is not None:
            near &= side[rest] != side[i]
        rest = rest[near]
        rest = rest[(sig[rest] == sig[i]).sum(axis=1) >= least]
        if len(rest):
            labels = joined.labels()
            rest = rest[labels[rest] != labels[i]]
        if not len(rest):
            continue
        own, flat = sets[i], np.concatenate([sets[j] for j in rest])
        at = np.searchsorted(own, flat)
        at[at == len(own)] = 0
        starts = np.concatenate(([0], np.cumsum(size[rest])[:-1]))
        common = np.add.reduceat((own[at] == flat).astype(np.int64), starts)
        for j in rest[100 * common >= percent * (size[i] + size[rest] - common)]:
            joined.join(i, j)
    return joined


def _confirmed_links(words: int, percent: int):
    """Rows (cluster, left, right, block, node, sig, text) sorted by the first three -> links."""

    def links(rows: list[tuple], hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
        sets = list(shingle_sets([r[6] for r in rows], words, hasher))
        sig = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(-1, SIZE)
        side = None if rows[0][1] == rows[0][2] else np.array([int(r[3] == rows[0][2]) for r in rows])
        nodes = np.array([r[4] for r in rows], dtype=np.int64)
        return _star(nodes, confirm(sets, sig, side, percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = WordHasher(), []
        for whole in batches:
            for lo in range(0, whole.num_rows, _ROWS):
                a, b = [], []
                for row in zip(*(c.to_pylist() for c in whole.slice(lo, _ROWS).columns)):
                    if held and row[:3] != held[0][:3]:
                        x, y = links(held, hasher)
                        a.append(x)
                        b.append(y)
                        held = []
                    held.append(row)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(v), pa.int64()) for v in (a, b)], names=["a", "b"])
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in links(held, hasher)], names=["a", "b"])

    return run


def _measure(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for whole in batches:
            for lo in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(lo, _ROWS)
                size, digest, sig = [], [], []
                for s in shingle_sets(batch.column(2).to_pylist(), words, hasher):
                    size.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sig.append(signature(s).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                    names=["doc_id", "text_key", "n_shingles", "digest", "sig"],
                )

    return run


# ------------------------------------------------------------------ plan

def _prefix_keys() -> Column:
    """The first ``DEPTH`` values of every order, with the order's number, as one BIGINT each."""
    pair = lambda at, n: F.conv(F.hex(F.substring("sig", at + 1, n)), 16, 10).cast("bigint")
    return F.array(*[pair(t * STEP, DEPTH) + F.lit(t * 256**DEPTH) for t in range(ORDERS)])


def _rotated(t: int) -> Column:
    at = t * STEP
    return F.concat(F.substring("sig", at + 1, SIZE - at), F.substring("sig", 1, at))


def candidate_links(nodes: DataFrame, percent: int) -> DataFrame:
    """``a, b`` from ``node, sig``: pairs that the forest finds near enough, one star per group it connects."""
    keys = nodes.select("node", F.explode(_prefix_keys()).alias("key"))
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("key")
    near = keys.join(shared, "key", "left_semi").select("node").distinct()
    near = written(nodes.select("node", "sig").join(near, "node", "left_semi"), "forest-near")
    orders = F.array(*[F.struct(F.lit(t).alias("t"), _rotated(t).alias("sig")) for t in range(ORDERS)])
    rows = near.select("node", F.explode(orders).alias("o")).select(F.col("o.t").alias("t"), F.col("o.sig").alias("sig"), "node")
    in_order = rows.repartitionByRange("t", "sig", "node").sortWithinPartitions("t", "sig", "node")
    return in_order.mapInArrow(tidy(_neighbour_links(least_matches(percent))), "a bigint, b bigint")


def _cells(clusters: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, cluster, left, right, block``: the tasks in which each node of a cluster is compared."""
    weighed = clusters.join(nodes.select("node", "n_shingles"), "node")
    weight = weighed.groupBy("component").agg(F.sum(1 + F.expr("n_shingles div 2000")).alias("w"))
    n_blocks = F.when(F.col("w") <= CLUSTER, F.lit(1)).otherwise(F.ceil(F.col("w") * 2 / CLUSTER)).cast("bigint")
    placed = weighed.join(weight.select("component", n_blocks.alias("k")), "component")
    placed = placed.select("node", F.col("component").alias("cluster"), "k", F.pmod(F.xxhash64("node"), F.col("k")).alias("block"))
    each = placed.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("other"))
    return each.select("node", "cluster", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, n_shingles, component, component_id, kept``, one row per document.

    Documents with 100 * intersection >= ``percent`` * union of their sets of
    ``words``-word shingles are linked; ``component_id`` is the smallest id
    reachable, ``component`` a number for the same (null for an empty set) and
    ``text_key`` is ``xxhash64`` of the text.
    """
    with temporary_tables(docs.sparkSession):
        return written(_near_duplicates(docs, words, percent, id_col, text_col), "forest-result", keep=True)


def _near_duplicates(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    measured = written(rows.mapInArrow(tidy(_measure(words)), "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, sig binary"), "forest-sets")
    ranked = measured.withColumn("rank", F.coalesce("doc_id", F.lit(_LAST_ID)))
    same = ["digest", "sig", "n_shingles"]
    classes = (  # equal sets are one node; its text is that of the smallest id with the smallest text_key
        ranked.filter(F.col("digest").isNotNull()).groupBy(*same, "text_key").agg(F.min("rank").alias("rank"))
        .groupBy(*same).agg(F.min("rank").alias("first"), F.min("text_key").alias("text_key"), F.min_by("rank", "text_key").alias("of"))
    )
    nodes = written(classes.withColumn("node", F.monotonically_increasing_id()), "forest-nodes")
    clusters = components(candidate_links(nodes, percent))
    cells = written(_cells(clusters, nodes), "forest-cells")
    wanted = nodes.join(cells.select("node").distinct(), "node", "left_semi").select("node", "sig", F.col("text_key").alias("_key"), "of")
    texts = rows.join(wanted, (F.col("text_key") == F.col("_key")) & (F.coalesce("doc_id", F.lit(_LAST_ID)) == F.col("of")))
    texts = texts.dropDuplicates(["node"]).select("node", "sig", "text")
    tasks = cells.join(texts, "node").select("cluster", "left", "right", "block", "node", "sig", "text")
    grouped = tasks.repartition("cluster", "left", "right").sortWithinPartitions("cluster", "left", "right", "node")
    links = written(grouped.mapInArrow(tidy(_confirmed_links(words, percent)), "a bigint, b bigint"), "forest-links")
    member = components(links)
    placed = nodes.select("digest", "first", "node").join(member, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    lowest = placed.groupBy("component").agg(F.min("first").alias("lowest"))
    of_class = placed.join(lowest, "component").select("digest", "component", "lowest")
    out = measured.drop("sig").join(of_class, "digest", "left")
    component_id = F.when(F.col("digest").isNull(), F.col("doc_id")).when(F.col("lowest") != _LAST_ID, F.col("lowest"))
    out = out.select("doc_id", "text_key", "n_shingles", "component", component_id.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def remove_near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with one document of each component, that with the smallest id.

    Of rows that share that id, one with the smallest ``text_key`` stays; a
    component of null ids only keeps one row. Rows without words are kept.
    """
    found = near_duplicates(docs, words, percent, id_col, text_col)
    rank = lambda c: F.coalesce(F.col(c), F.lit(_LAST_ID))
    keep = (
        found.filter((F.col("n_shingles") > 0) & F.col("kept")).groupBy("component")
        .agg(F.min(rank("doc_id")).alias("_keep"), F.min("text_key").alias("_keep_key")).drop("component")
    )
    both = rows_as_struct(docs, [id_col, text_col]).select(
        "_row", F.col(f"`_{id_col}`").cast("bigint").alias("_id"), F.col(f"`_{text_col}`").cast("string").alias("_text"))
    worded = F.char_length(F.translate(F.coalesce("_text", F.lit("")), BLANKS, "")) > 0
    keyed = both.filter(worded).select("_row", rank("_id").alias("_rank"), F.xxhash64("_text").alias("_key"))
    kept = keyed.join(keep, (F.col("_rank") == F.col("_keep")) & (F.col("_key") == F.col("_keep_key")), "left_semi")
    kept = kept.dropDuplicates(["_rank", "_key"]).select("_row")
    return kept.unionByName(both.filter(~worded).select("_row")).select("_row.*")
