"""Landed-row envelope (T1-T7): blank->null, surrogate key, metadata, payload.

Landed table columns, in order:
  surrogate_key_id, source_id, created_by, created_timestamp, updated_by,
  updated_timestamp, data_payload
followed by the load metadata ``page``, ``pos`` and the partition column
``load_id``. ``load_ts`` and ``user`` are arguments so that a rerun of the
same load reproduces the same rows and keys.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The landed columns and their order.
ENVELOPE_COLUMNS = (
    "surrogate_key_id",
    "source_id",
    "created_by",
    "created_timestamp",
    "updated_by",
    "updated_timestamp",
    "data_payload",
)
LOAD_COLUMNS = ("page", "pos", "load_id")


def blank_to_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Empty strings -> NULL in top-level string columns (nested blanks stay)."""
    return df.replace("", None, subset=list(subset) if subset else None)


def blank_payload(df: DataFrame, payload_col: str = "data_payload") -> DataFrame:
    """T1 on a record struct: empty strings in its top-level string fields -> NULL (nested blanks stay)."""
    fields = df.schema[payload_col].dataType.fields
    value = lambda f: F.col(payload_col)[f.name]
    cols = [(F.when(value(f) != "", value(f)) if isinstance(f.dataType, StringType) else value(f)).alias(f.name) for f in fields]
    return df.withColumn(payload_col, F.struct(*cols)) if cols else df


def payload_json(payload: Column) -> Column:
    """Canonical JSON of a record, keeping null fields (for hashing)."""
    return F.to_json(payload, {"ignoreNullFields": "false"})


def surrogate_key(source_id: Column, load_ts: Column, page: Column, pos: Column, payload: Column) -> Column:
    """SHA-256 over source, load time, record position and record content.

    ``(page, pos)`` keeps equal records of one load apart; the load time keeps
    loads apart. With a fixed ``load_ts`` a rerun gives the same keys.
    """
    return F.sha2(F.concat_ws(":", source_id, load_ts.cast("string"), page.cast("string"), pos.cast("string"), payload_json(payload)), 256)


def envelope(
    records: DataFrame,
    source_id: str,
    load_id: str,
    load_ts: str | Column | None = None,
    user: str | None = None,
    payload_cols: Sequence[str] | None = None,
    page_col: str = "page",
    pos_col: str = "pos",
) -> DataFrame:
    """Wrap typed records in the landed-row envelope (one lazy projection).

    The payload is the struct column ``data_payload`` if there is one, so that
    a record may have fields named like the metadata; else it is built from
    ``payload_cols`` (default: all columns but page and position).
    """
    if payload_cols is None and "data_payload" in records.columns:
        payload = F.col("data_payload")
    else:
        cols = list(payload_cols) if payload_cols is not None else [c for c in records.columns if c not in (page_col, pos_col)]
        payload = F.struct(*[F.col(f"`{c}`") for c in cols])
    if load_ts is None:
        ts = F.current_timestamp()
    elif isinstance(load_ts, Column):
        ts = load_ts.cast("timestamp")
    else:
        ts = F.lit(load_ts).cast("timestamp")
    who = F.lit(user) if user is not None else F.current_user()
    src = F.lit(source_id)
    return records.select(
        surrogate_key(src, ts, F.col(page_col), F.col(pos_col), payload).alias("surrogate_key_id"),
        src.alias("source_id"),
        who.alias("created_by"),
        ts.alias("created_timestamp"),
        who.alias("updated_by"),
        ts.alias("updated_timestamp"),
        payload.alias("data_payload"),
        F.col(page_col).cast("bigint").alias("page"),
        F.col(pos_col).cast("bigint").alias("pos"),
        F.lit(load_id).alias("load_id"),
    )


def rows_as_json(df: DataFrame, alias: str = "json") -> DataFrame:
    """Each row as one JSON object (null fields kept), on the executors."""
    return df.select(payload_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias(alias))
