"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce, wraps
from typing import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.session import remove_path, scratch_path

#: A word: a run of characters other than ASCII blanks (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"
#: The same separators, for ``translate``.
BLANKS = " \t\n\x0b\x0c\r"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def word_count(text: Column) -> Column:
    """Number of words of a text as BIGINT; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


#: The open scopes of this thread, the innermost last.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("ferry_temporary_tables", default=())


@contextmanager
def temporary_tables(spark: SparkSession) -> Iterator[None]:
    """Remove the tables ``written`` inside, but for those kept, once nothing reads them any more."""
    scopes = _open.get()
    mine: list[str] = []
    token = _open.set((*scopes, mine))
    try:
        yield
    finally:
        _open.reset(token)
        for path in mine:
            remove_path(spark, path)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written as Parquet below the shared scratch folder and read again.

    Cuts the lineage in a place all executors see, so a lost executor costs a
    re-read and not a recomputation. ``keep`` leaves the table to the scope
    around the innermost one of ``temporary_tables``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    scopes = _open.get()[:-1] if keep else _open.get()
    if scopes:
        scopes[-1].append(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function over a task's batches, that hands freed memory back to the system when the task ends.

    Python workers outlive their tasks, and what one stage freed but kept would
    be missing in the next one.
    """
    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return tidied


def remove(table: DataFrame) -> None:
    """Remove a table that ``written`` returned, before its scope ends."""
    remove_path(table.sparkSession, table._written_to)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    salt: Column,
    salts: int = 16,
    how: str = "left",
) -> DataFrame:
    """Join a large ``left`` with a ``right`` that has one row per key, nulls matching nulls.

    ``on`` maps left key columns to right ones. Every left key is spread over
    ``salts`` partitions by ``salt`` (a hash of what tells its rows apart) and
    every right row is repeated for each of them, so a key that holds a large
    share of the left rows does not land in one task. Returns the left columns
    and the right columns that are not keys.
    """
    spread = left.withColumn("_salt", F.pmod(salt, F.lit(salts)).cast("int"))
    keys = [F.col(r).alias(f"_key{i}") for i, r in enumerate(on.values())]
    rest = [c for c in right.columns if c not in on.values()]
    copies = right.select(*keys, *rest, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_copy"))
    cond = [F.col(l).eqNullSafe(F.col(f"_key{i}")) for i, l in enumerate(on)] + [F.col("_salt") == F.col("_copy")]
    joined = spread.join(copies, reduce(lambda a, b: a & b, cond), how)
    return joined.select(*left.columns, *rest)


def rows_as_struct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``_row`` (the whole input row) beside copies of ``columns`` named ``_<column>``.

    Operators that return their input rows work on this form, so no input
    column can clash with one of theirs.
    """
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), *[F.col(f"`{c}`").alias(f"_{c}") for c in columns])
