"""Mixing sources to target weights (operator 6, native).

Sizes are added up per source; each source gets a weight by its place in code
point order (null last) and a target: its weighted share of all words, at
most ``limit`` times its size, the excess shared again by weight until no
target is above its limit. The repetition rate is target / size; a document
is taken floor(rate) times, plus once more if a hash of its id, content and
the seed, read as a number in [0, 1), is below the fraction. So the draw is a
Bernoulli trial that reruns and retries repeat exactly.

Water filling without a loop: with the sources in order of limit per weight,
let share(i) be what one unit of weight gets if all sources before i are held
at their limits. share grows while the next source is above its limit and
falls afterwards, so its maximum is the final share per weight.

Defined cases: a null text has size 0; a source without words has target 0
and none of its documents is taken; null is a source of its own; rows equal
in id and text share a draw; an empty table gives no rows. Columns other than
id, text and source are only read by ``mix``, which returns whole rows.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferry.llm.common import rows_as_struct, salted_join, word_count, written

WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = "mix-1"
#: A per-source table of at most this many rows is broadcast; a larger one is joined by a salted shuffle.
BROADCAST_SOURCES = 10_000


def draw(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) with 52 random bits, from the seed, the id and the content."""
    key = F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("|"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``; one row per source throughout."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    weighed = totals.withColumn("_weight", weight).withColumn("_limit", F.col("source_size") * limit)
    order = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    held = F.coalesce(F.sum("_limit").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    share = (F.sum("source_size").over(Window.partitionBy()) - held) / rest
    shares = weighed.withColumn("_share", share)
    best = F.max("_share").over(Window.partitionBy())
    return shares.select(
        "source", "source_size",
        F.least(F.col("_limit").cast("double"), best * F.col("_weight")).alias("target"),
    )


def copies(target: Column, source_size: Column, u: Column) -> Column:
    """floor(rate), plus one if the draw falls below the fraction."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (u < rate - F.floor(rate)).cast("int")).cast("bigint")


def _with_targets(rows: DataFrame, targets: DataFrame, source: str, u: str) -> DataFrame:
    if targets.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        named = targets.withColumnRenamed("source", "_target_of")
        return rows.join(F.broadcast(named), F.col(source).eqNullSafe(F.col("_target_of")), "left").drop("_target_of")
    return salted_join(rows, targets, {source: "source"}, F.xxhash64(u))


def plan_mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, seed: str = SEED,
             id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, source, size, source_size, target, copies``: how often the mix takes each document."""
    text = F.col(f"`{text_col}`")
    sizes = written(  # the texts are read and counted once
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"),
            draw(F.col(f"`{id_col}`"), text, seed).alias("_u"),
        ),
        "mix-sizes",
    )
    targets = written(source_targets(sizes, weights, limit), "mix-targets")
    joined = _with_targets(sizes, targets, "source", "_u")
    return joined.select("doc_id", "source", "size", "source_size", "target",
                         copies(F.col("target"), F.col("source_size"), F.col("_u")).alias("copies"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT, seed: str = SEED,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed rows: each input row as often as the mix takes it, with all its columns."""
    text = F.col(f"`{text_col}`")
    sizes = docs.select(F.col(f"`{source_col}`").alias("source"), word_count(text).alias("size"))
    targets = written(source_targets(sizes, weights, limit), "mix-targets")
    rows = rows_as_struct(docs, [id_col, text_col, source_col]).select(
        "_row", F.col(f"`_{source_col}`").alias("_source"), draw(F.col(f"`_{id_col}`"), F.col(f"`_{text_col}`"), seed).alias("_u")
    )
    joined = _with_targets(rows, targets, "_source", "_u")
    n = copies(F.col("target"), F.col("source_size"), F.col("_u"))
    taken = joined.select("_row", n.alias("_n")).filter(F.col("_n") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n")))).select("_row.*")
