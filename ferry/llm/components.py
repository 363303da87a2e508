"""Connected components of a link table, by alternating large and small stars.

Each round points every node's larger neighbours (large star), then its
smaller ones (small star), at the smallest node around it, until nothing
changes; paths shrink to stars in a number of rounds that grows with the
logarithm of their length. A round is one job whose result is written to the
shared folder. Nothing but a count and a checksum reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferry.llm.common import remove, written


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    r = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(h, F.lit(2**40))), F.bit_xor(h)).first()
    return tuple(r)


def _round(edges: DataFrame) -> DataFrame:
    # large star: larger neighbours of a node point at the smallest of the node and its neighbours
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    # small star: a node and its smaller neighbours point at the smallest of them
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    near = large.join(low, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return near.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for every node of ``links(a, b)``; ids are BIGINT."""
    pairs = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(pairs.distinct(), "component-edges")
    state = _state(edges)
    while True:
        last, edges = edges, written(_round(edges), "component-edges")
        remove(last)
        new = _state(edges)
        if new == state:
            break
        state = new
    member = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return member.unionByName(roots)
