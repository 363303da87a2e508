"""Dynamic record schema: census, inference, merge, diff, ignore, conform.

Type rules: string -> STRING, integer -> BIGINT, fraction -> DOUBLE, bool ->
BOOLEAN, object -> STRUCT, array -> ARRAY, null-only -> STRING. Integers beyond
BIGINT are DECIMAL(p, 0) of as many digits as the longest one has (up to 38;
longer ones are fractions to Spark). Whole numbers form a chain BIGINT <
DECIMAL(p, 0) < STRING, along which merging and widening keep every digit.
Conflicts: BIGINT with DOUBLE -> DOUBLE, anything else -> STRING. A field that
holds wide integers beside fractions in one load is DOUBLE.

Inference is one aggregate over all records (``schema_of_variant_agg``, partial
in every task); the driver receives one schema text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    ByteType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

CORRUPT = "_corrupt_record"
PAYLOAD = "data_payload"
_INTEGRAL = (LongType, IntegerType, ShortType, ByteType)
_FRACTIONAL = (DoubleType, FloatType, DecimalType)


# ---------------------------------------------------------------- census

def census(records: DataFrame, record_col: str = "record") -> DataFrame:
    """Distinct record shapes with their counts (a hash aggregate over the shape texts)."""
    return records.groupBy(F.schema_of_variant(F.col(record_col)).alias("schema")).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- inference (G1)

def infer_schema(records: DataFrame, record_col: str = "record") -> StructType:
    """G1: the merged Spark schema of all object records (see module doc)."""
    v = F.col(record_col)
    # a whole number beside a fraction without decimals (1 and 2.0) merges to a DECIMAL(20, 0) as well: only a value of its own tells
    wide = F.schema_of_variant(v).rlike(r"DECIMAL\((19|[23]\d),0\)")
    row = records.agg(F.schema_of_variant_agg(F.when(is_object(v), v)).alias("s"), F.max(wide).alias("wide")).first()
    found = variant_type(row["s"], bool(row["wide"]))
    if not isinstance(found, StructType):
        return StructType([])
    check_names(found)
    return found


def check_names(schema: StructType) -> None:
    """Refuse fields that differ in case only: a table cannot hold both, and neither may be lost."""
    by_lower: dict[str, str] = {}
    for f in schema.fields:
        other = by_lower.setdefault(f.name.lower(), f.name)
        if other != f.name:
            raise ValueError(f"fields {other!r} and {f.name!r} differ in case only")
        inner = f.dataType
        while isinstance(inner, ArrayType):
            inner = inner.elementType
        if isinstance(inner, StructType):
            check_names(inner)


_TOKEN = re.compile(r"`(?:[^`]|``)*`|DECIMAL\(\d+,\d+\)|[^<>,:\s]+|[<>,:]")
_SCALARS = {"BIGINT": LongType(), "DOUBLE": DoubleType(), "FLOAT": DoubleType(), "BOOLEAN": BooleanType()}


def variant_type(text: str, wide: bool = True) -> DataType:
    """The Spark type for a variant schema text such as ``OBJECT<a: BIGINT, b: ARRAY<VOID>>`` (rules in the module doc).

    ``wide``: whether there is an integer beyond BIGINT at all.
    """
    tokens = iter(_TOKEN.findall(text))

    def parse(token: str) -> DataType:
        if token == "ARRAY":
            next(tokens)  # <
            inner = parse(next(tokens))
            next(tokens)  # >
            return ArrayType(inner, True)
        if token == "OBJECT":
            next(tokens)
            fields, name = [], next(tokens)
            while name != ">":
                next(tokens)  # :
                key = name[1:-1].replace("``", "`") if name.startswith("`") else name
                fields.append(StructField(key, parse(next(tokens)), True))
                name = next(tokens)
                if name == ",":
                    name = next(tokens)
            return StructType(fields)
        if token.startswith("DECIMAL"):
            digits, scale = map(int, re.findall(r"\d+", token))
            return DecimalType(digits, 0) if wide and digits > 18 and not scale else DoubleType()
        return _SCALARS.get(token, StringType())

    return parse(next(tokens))


# ----------------------------------------------------------------- merge

def _is_whole(t: DataType) -> bool:
    return isinstance(t, _INTEGRAL) or isinstance(t, DecimalType) and t.scale == 0


def _digits(t: DataType) -> int:
    return t.precision if isinstance(t, DecimalType) else 19


def merge_types(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(b, NullType):
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merge_types(a.elementType, b.elementType), True)
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return LongType()
    if _is_whole(a) and _is_whole(b):
        return DecimalType(max(_digits(a), _digits(b)), 0)
    if any(isinstance(t, DecimalType) and t.scale == 0 for t in (a, b)):
        return StringType()  # next to a fraction a double would lose digits
    if isinstance(a, _INTEGRAL + _FRACTIONAL) and isinstance(b, _INTEGRAL + _FRACTIONAL):
        return DoubleType()
    return StringType()


def merge_schemas(existing: StructType, current: StructType) -> StructType:
    """Existing fields keep their place; new fields are appended in their order."""
    cur = {f.name: f for f in current.fields}
    out = []
    for f in existing.fields:
        if f.name in cur:
            out.append(StructField(f.name, merge_types(f.dataType, cur[f.name].dataType), True))
        else:
            out.append(StructField(f.name, f.dataType, True))
    seen = {f.name for f in existing.fields}
    out += [StructField(f.name, f.dataType, True) for f in current.fields if f.name not in seen]
    return StructType(out)


def keep_stored(existing: StructType, current: StructType) -> StructType:
    """``merge_schemas``, but no stored type changes: what does not fit it is for ``rejected_fields``."""
    cur = {f.name: f.dataType for f in current.fields}

    def kept(old: DataType, new: DataType | None) -> DataType:
        return keep_stored(old, new) if isinstance(old, StructType) and isinstance(new, StructType) else old

    out = [StructField(f.name, kept(f.dataType, cur.get(f.name)), True) for f in existing.fields]
    have = set(existing.fieldNames())
    return StructType(out + [StructField(f.name, f.dataType, True) for f in current.fields if f.name not in have])


# ----------------------------------------------------------------- diff

def flatten_schema(schema: StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(dotted path, type) for every leaf and struct, in schema order."""
    out: list[tuple[str, str]] = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        out.append((path, f.dataType.simpleString()))
        dt = f.dataType
        while isinstance(dt, ArrayType):
            dt = dt.elementType
        if isinstance(dt, StructType):
            out += flatten_schema(dt, path + ".")
    return out


@dataclass
class SchemaDiff:
    only_in_current: list[tuple[str, str]] = field(default_factory=list)
    only_in_existing: list[tuple[str, str]] = field(default_factory=list)
    type_changed: list[tuple[str, str, str]] = field(default_factory=list)

    def __bool__(self) -> bool:
        return bool(self.only_in_current or self.type_changed)

    def as_dict(self) -> dict:
        return {
            "only_in_current": self.only_in_current,
            "only_in_existing": self.only_in_existing,
            "type_changed": self.type_changed,
        }


def schema_diff(existing: StructType, current: StructType) -> SchemaDiff:
    """G3 on the driver (schemas are metadata, bounded by the number of fields)."""
    old = dict(flatten_schema(existing))
    new = dict(flatten_schema(current))
    d = SchemaDiff()
    d.only_in_current = [(p, t) for p, t in new.items() if p not in old]
    d.only_in_existing = [(p, t) for p, t in old.items() if p not in new]
    d.type_changed = [(p, old[p], t) for p, t in new.items() if p in old and old[p] != t
                      and not (t.startswith("struct") and old[p].startswith("struct"))
                      and not (t.startswith("array<struct") and old[p].startswith("array<struct"))]
    return d


def schema_fields(spark: SparkSession, schema: StructType) -> DataFrame:
    """The flattened schema as a DataFrame ``(path, type)`` for set operations."""
    return spark.createDataFrame(flatten_schema(schema), "path string, type string")


def new_fields(spark: SparkSession, existing: StructType, current: StructType) -> DataFrame:
    """G3 as a DataFrame: fields of ``current`` not in ``existing`` (exceptAll)."""
    return schema_fields(spark, current).exceptAll(schema_fields(spark, existing))


# ----------------------------------------------------------------- ignore

def drop_fields(schema: StructType, names: Iterable[str]) -> StructType:
    """Remove top-level or dotted nested fields from a schema."""
    names = list(names)
    top = {n for n in names if "." not in n}
    nested: dict[str, list[str]] = {}
    for n in names:
        if "." in n:
            head, rest = n.split(".", 1)
            nested.setdefault(head, []).append(rest)
    out = []
    for f in schema.fields:
        if f.name in top:
            continue
        dt = f.dataType
        if f.name in nested:
            if isinstance(dt, StructType):
                dt = drop_fields(dt, nested[f.name])
            elif isinstance(dt, ArrayType) and isinstance(dt.elementType, StructType):
                dt = ArrayType(drop_fields(dt.elementType, nested[f.name]), True)
        out.append(StructField(f.name, dt, True))
    return StructType(out)


# ------------------------------------------------------------- schema audit

def schema_audit_rows(
    spark: SparkSession, table: str, diff: SchemaDiff, ignored: Sequence[str], event_ts
) -> DataFrame:
    """One row per new or retyped field, for the append-only schema audit."""
    rows = [(table, p, None, t, "added") for p, t in diff.only_in_current]
    rows += [(table, p, old, new, "type_changed") for p, old, new in diff.type_changed]
    rows += [(table, n, None, None, "ignored") for n in ignored]
    df = spark.createDataFrame(rows, "table_name string, field_path string, old_type string, new_type string, change string")
    return df.withColumn("event_ts", F.lit(event_ts).cast(TimestampType()))


# ------------------------------------------------------------- conform

def conform(
    records: DataFrame,
    schema: StructType,
    record_col: str = "record",
    keep: Sequence[str] = ("page", "pos"),
    corrupt_col: str = CORRUPT,
) -> DataFrame:
    """Type every record with ``schema``, as the struct ``data_payload`` beside ``keep``; missing fields come back NULL.

    Parsing is permissive: a value that does not fit its field becomes NULL
    and the whole record is copied to ``corrupt_col`` so it can be
    quarantined instead of silently losing data.
    """
    full = StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])
    typed = F.from_json(
        F.to_json(F.col(record_col)), full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col}
    )
    rows = records.select(*keep, typed.alias("_r"))
    payload = F.struct(*[F.col("_r")[f.name].alias(f.name) for f in schema.fields]) if schema.fields else F.lit(None).cast("struct<>")
    bad = F.col("_r").isNull() | F.col("_r")[corrupt_col].isNotNull()
    return rows.select(*keep, payload.alias(PAYLOAD), F.when(bad, F.coalesce(F.col("_r")[corrupt_col], F.lit(""))).alias(corrupt_col))


def rejected_fields(record: Column, payload: Column, schema: StructType) -> Column:
    """The record's values that its typed payload lost, as an array of ``(path, text)``.

    A value is lost if the record has one and the payload has NULL. A list, or
    a value where an object belongs, counts as one value.
    """
    none = F.array().cast("array<struct<path:string,text:string>>")

    def of(fields: StructType, typed: Column, names: tuple[str, ...]) -> Column:
        found = [none]
        for f in fields.fields:
            path = (*names, f.name)
            value = F.try_variant_get(record, "$" + "".join("['" + n.replace("'", "\\'") + "']" for n in path), "variant")
            text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
            lost = value.isNotNull() & (F.schema_of_variant(value) != "VOID") & typed[f.name].isNull()
            item = F.array(F.struct(F.lit(".".join(path)).alias("path"), text.alias("text")))
            inner = of(f.dataType, typed[f.name], path) if isinstance(f.dataType, StructType) else none
            found.append(F.when(lost, item).otherwise(inner))
        return F.concat(*found)

    return of(schema, payload, ())


def conform_fields(records: DataFrame, schema: StructType, record_col: str = "record", keep: Sequence[str] = ("page", "pos")) -> DataFrame:
    """G6 field by field: ``conform`` whose rows keep every value that fits, with the others in ``rejects``.

    The corrupt column is set for records that are no objects only.
    """
    rows = conform(records.select(*keep, F.col(record_col).alias("_record")), schema, "_record", [*keep, "_record"])
    object_ = is_object(F.col("_record"))
    lost = F.when(object_, rejected_fields(F.col("_record"), F.col(PAYLOAD), schema))
    return rows.select(*keep, PAYLOAD, lost.alias("rejects"), F.when(~F.coalesce(object_, F.lit(False)), F.coalesce(CORRUPT, F.lit(""))).alias(CORRUPT))


def split_corrupt(conformed: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined rows)."""
    good = conformed.filter(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = conformed.filter(F.col(corrupt_col).isNotNull())
    return good, bad


def is_object(record: Column) -> Column:
    return F.schema_of_variant(record).startswith("OBJECT")
