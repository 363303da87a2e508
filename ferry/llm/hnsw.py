"""Approximate nearest neighbours by one HNSW graph per shard (operator 5).

Equal vectors are one node of the graph that carries its smallest ids, as many
as a result can show, so a vector that a third of all rows share neither fills
a shard nor hides its neighbours. Nodes are dealt to shards of about
``SHARD_ROWS`` by a hash. Each shard's graph is built in one task and stored
as one row of flat arrays: vectors, levels and neighbour lists.

Queries are grouped in blocks; every block meets every shard, each pair in one
task that holds one graph and one block. The best of each shard are merged by
score. Scores are cosines in double precision on the given vectors, equal
scores rank by the smaller id.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, nor do rows without an id; rows that repeat
an id with different vectors are all candidates, and an id is found once, by
the best of its vectors and of the query's; vectors of different lengths are
in separate graphs; a search for more than the index was built for is refused; fewer candidates than asked for give fewer rows; an empty
table gives no rows. Columns other than id and vector are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import written

SHARD_ROWS = 4096
QUERY_BLOCK = 4096
LINKS, EF_BUILD, EF_SEARCH = 16, 80, 120
SEED = 20240301


class Graph:
    """A navigable small-world graph over unit vectors, in flat arrays.

    ``neighbours[l]`` is an array of (nodes, degree) node numbers, -1 where
    empty; level 0 has twice the degree of the others.
    """

    def __init__(self, vectors: np.ndarray, links: int = LINKS):
        n = len(vectors)
        self.vectors, self.links = vectors, links
        rng = np.random.Generator(np.random.PCG64([SEED, n]))
        self.levels = np.minimum((-np.log(1 - rng.random(n)) / np.log(links)).astype(np.int32), 8)
        self.neighbours = [np.full((n, 2 * links if l == 0 else links), -1, dtype=np.int32) for l in range(int(self.levels.max(initial=0)) + 1)]
        self.entry = -1
        self._seen = np.zeros(n, dtype=np.int64)
        self._mark = 0

    def build(self, ef: int = EF_BUILD) -> "Graph":
        for i in range(len(self.vectors)):
            self._insert(i, ef)
        return self

    def _search(self, q: np.ndarray, start: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """The ``ef`` nearest found on a level as (distance, node), nearest first; ``start`` in the same form."""
        self._mark += 1
        mark, seen, near, vectors = self._mark, self._seen, self.neighbours[level], self.vectors
        for _, i in start:
            seen[i] = mark
        todo = list(start)
        heapq.heapify(todo)
        best = [(-d, i) for d, i in start]
        heapq.heapify(best)
        while todo:
            d, i = heapq.heappop(todo)
            if d > -best[0][0] and len(best) >= ef:
                break
            new = near[i]
            new = new[new >= 0]
            new = new[seen[new] != mark]
            if not len(new):
                continue
            seen[new] = mark
            far = 1.0 - vectors[new] @ q
            worst = -best[0][0]
            if len(best) >= ef:
                keep = far < worst
                new, far = new[keep], far[keep]
            for e, j in zip(far.tolist(), new.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (-e, j))
                elif e < -best[0][0]:
                    heapq.heapreplace(best, (-e, j))
                else:
                    continue
                heapq.heappush(todo, (e, j))
        return sorted((-d, i) for d, i in best)

    def _spread(self, found: list[tuple[float, int]], m: int) -> list[int]:
        """Up to ``m`` of the found nodes, near ones first, none nearer to a chosen one than to the new node; then the nearest others."""
        ids = np.array([i for _, i in found])
        between = 1.0 - self.vectors[ids] @ self.vectors[ids].T
        chosen: list[int] = []
        left: list[int] = []
        for k, (d, _) in enumerate(found):
            if len(chosen) == m:
                break
            (left if chosen and between[k, chosen].min() < d else chosen).append(k)
        chosen += left[:m - len(chosen)]
        return ids[chosen].tolist()

    def _insert(self, i: int, ef: int) -> None:
        level = int(self.levels[i])
        if self.entry < 0:
            self.entry = i
            return
        q = self.vectors[i]
        top = int(self.levels[self.entry])
        start = [(float(1.0 - self.vectors[self.entry] @ q), self.entry)]
        for l in range(top, level, -1):
            start = self._search(q, start, 1, l)
        for l in range(min(level, top), -1, -1):
            start = self._search(q, start, ef, l)
            near = self.neighbours[l]
            chosen = self._spread(start, self.links)
            near[i, :len(chosen)] = chosen
            for j in chosen:
                row = near[j]
                free = np.flatnonzero(row < 0)
                if len(free):
                    row[free[0]] = i
                    continue
                both = np.append(row, i)
                far = 1.0 - self.vectors[both] @ self.vectors[j]
                order = np.argsort(far, kind="stable")
                near[j] = self._spread(list(zip(far[order].tolist(), both[order].tolist())), len(row))
        if level > top:
            self.entry = i

    def nearest(self, q: np.ndarray, ef: int = EF_SEARCH) -> list[int]:
        """The ``ef`` nearest nodes found, nearest first."""
        if self.entry < 0:
            return []
        start = [(float(1.0 - self.vectors[self.entry] @ q), self.entry)]
        for l in range(int(self.levels[self.entry]), 0, -1):
            start = self._search(q, start, 1, l)
        return [i for _, i in self._search(q, start, ef, 0)]

    def flat(self) -> dict:
        return {"entry": self.entry, "levels": self.levels.tobytes(), "neighbours": [x.tobytes() for x in self.neighbours]}

    @classmethod
    def of(cls, vectors: np.ndarray, entry: int, levels: bytes, neighbours: list[bytes]) -> "Graph":
        self = cls.__new__(cls)
        n = len(vectors)
        self.vectors, self.entry, self.links = vectors, entry, LINKS
        self.levels = np.frombuffer(levels, np.int32)
        self.neighbours = [np.frombuffer(x, np.int32).reshape(n, -1) for x in neighbours]
        self._seen, self._mark = np.zeros(n, dtype=np.int64), 0
        return self


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision; scaled by their largest component first, so no square overflows."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


_INDEX = "dim int, shard bigint, entry int, levels binary, neighbours array<binary>, vectors binary, ids array<array<bigint>>"
_INDEX_ARROW = pa.schema([
    ("dim", pa.int32()), ("shard", pa.int64()), ("entry", pa.int32()), ("levels", pa.binary()), ("neighbours", pa.list_(pa.binary())),
    ("vectors", pa.binary()), ("ids", pa.list_(pa.list_(pa.int64()))),
])
_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def _build(table: pa.Table) -> pa.Table:
    rows = table.sort_by([("first", "ascending")])  # the same graph on every run
    vectors = _matrix(rows.column("vec"))
    graph = Graph(unit(vectors)).build()
    row = {"dim": vectors.shape[1], "shard": rows.column("shard")[0].as_py(), "vectors": vectors.tobytes(), "ids": rows.column("ids").to_pylist()}
    return pa.Table.from_pylist([row | graph.flat()], schema=_INDEX_ARROW)


def clean(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vec, dim``: one row per id and different vector, only vectors that have a cosine."""
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), vec.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & finite & F.exists("vec", lambda x: x != 0))
    return rows.groupBy("vec_id", "vec").agg(F.size("vec").alias("dim"))


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The stored graphs of ``vec_id, vec, dim``: one row per shard, with ``k``. Every vector is a node; of equal ones the k + 1 smallest ids are kept."""
    order = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= k + 1)
    nodes = few.groupBy("vec", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("first", F.col("ids")[0])
    nodes = written(nodes, "ann-nodes")
    sizes = nodes.groupBy("dim").agg(  # one row per length of vector
        F.ceil(F.count(F.lit(1)) / shard_rows).cast("bigint").alias("shards"))
    dealt = nodes.join(F.broadcast(sizes), "dim").withColumn("shard", F.pmod(F.xxhash64("vec"), F.col("shards")))
    graphs = dealt.select("dim", "shard", "vec", "ids", "first").groupBy("dim", "shard").applyInArrow(_build, _INDEX)
    return written(graphs.withColumn("k", F.lit(k)), "ann-index")


def _search_block(k: int, ef: int):
    def run(queries: pa.Table, index: pa.Table) -> pa.Table:
        if not queries.num_rows or not index.num_rows:
            return _FOUND.empty_table()
        g = index.to_pylist()[0]
        vectors = np.frombuffer(g["vectors"], np.float64).reshape(-1, g["dim"])
        scaled = unit(vectors)
        graph = Graph.of(scaled, g["entry"], g["levels"], g["neighbours"])
        ids, out = g["ids"], ([], [], [])
        for query_id, q in zip(queries.column("query_id").to_pylist(), unit(_matrix(queries.column("vec")))):
            nodes = graph.nearest(q, ef)
            scores = (scaled[nodes] @ q).tolist()
            found: dict[int, float] = {}
            for s, node in zip(scores, nodes):
                for i in ids[node]:
                    if i != query_id:
                        found[i] = max(s, found.get(i, s))
            for s, i in heapq.nsmallest(k, ((-s, i) for i, s in found.items())):
                out[0].append(query_id)
                out[1].append(i)
                out[2].append(-s)
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _FOUND)], schema=_FOUND)

    return run


def search(index: DataFrame, queries: DataFrame, k: int, ef: int = EF_SEARCH, block_rows: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for each row of ``query_id, vec, dim``, without its own id."""
    built = index.agg(F.min("k")).first()[0]
    if built is not None and k > built:
        raise ValueError(f"the index was built for k = {built}")
    n_blocks = max(1, -(-queries.count() // block_rows))
    shards = index.groupBy(F.col("dim").alias("_dim")).agg((F.max("shard") + 1).alias("_shards"))  # one row per length of vector
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    asked = queries.join(F.broadcast(shards), F.col("dim") == F.col("_dim")).select(
        "query_id", "vec", "dim", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks).cast("bigint")).alias("block"), upto(F.col("_shards")).alias("shard"))
    spread = index.select("*", upto(F.lit(n_blocks).cast("bigint")).alias("block"))
    key = ["dim", "shard", "block"]
    found = asked.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(_search_block(k, ef), "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
