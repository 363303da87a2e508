"""Record extraction from response bodies.

Bodies are parsed once into a VARIANT (JSON with ``try_parse_json``, XML with
``from_xml(..., 'variant')``), the record list is found at a dotted path and
exploded with its position. All of it is built-in, JVM-side expressions.

JSON: of a key that an object repeats, the last value counts.

XML: every value keeps its text. Spark's reader would turn ``0012`` into 12 and
``1e3`` into 1000, so texts and attribute values are put between two marks
(``_MARK``, a private-use character, which is dropped from values that hold it)
before the reader sees them. Of the marked values only those become numbers or
booleans that read back as the same text: whole numbers of up to 18 digits and
fractions of up to 15 without leading or trailing zeros (but for ``7.0``),
``true`` and ``false``.
Namespace declarations are no fields. Prefixes are dropped from names unless
``prefixes`` is set, which keeps elements of two namespaces apart; a path's names
then match with or without their prefix. Text of blanks only counts as empty.

Paths are dotted (``data.items``). For XML the root element is the row, so a
path starts below it (``item`` for ``<root><item/>...</root>``). For SOAP
bodies namespaces are ignored and the records are looked up below ``Body``
and below each child of ``Body`` (the operation's response wrapper).
"""

from __future__ import annotations

import re
from contextlib import contextmanager
from typing import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PLAIN = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")
_MARK = "\ue0f0"
#: What is done to an XML body before it is parsed: no declarations, marks around every value.
_MARKED = (
    (_MARK, ""),
    (r"<\?xml[^>]*\?>", ""),
    (r"\sxmlns(?::[^\s=<>]+)?\s*=\s*(?:\"[^\"]*\"|'[^']*')", ""),
    (r"(\s[^\s=<>\"'/]+\s*=\s*\")([^\"<]*)\"", f'$1{_MARK}$2{_MARK}"'),
    (r"(\s[^\s=<>\"'/]+\s*=\s*')([^'<]*)'", f"$1{_MARK}$2{_MARK}'"),
    (r"<!\[CDATA\[", f"<![CDATA[{_MARK}"),
    (r"\]\]>", f"{_MARK}]]>"),
    (r">([^<>]*[^<>\s][^<>]*)<", f">{_MARK}$1{_MARK}<"),
)
#: Marked values that a number or boolean gives back as they are.
_EXACT = f'"{_MARK}(0|-?[1-9][0-9]{{0,17}}|true|false|(?!-?0[.]000)-?(?:0|[1-9][0-9]{{0,6}})[.][0-9]{{0,7}}[1-9]){_MARK}"'
#: Whole numbers written as fractions; with an exponent they become doubles, which keep their ".0".
_POINT_ZERO = f'"{_MARK}(-?(?:0|[1-9][0-9]{{0,6}})[.]0){_MARK}"'


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once: a column named twice in a generator or a condition is computed twice."""
    return F.get(F.transform(F.array(value), body), 0)


def variant_path(field: str | None) -> str:
    """Dotted field name -> variant path (``data.items`` -> ``$.data.items``)."""
    if not field:
        return "$"
    out = ["$"]
    for part in field.split("."):
        out.append(f".{part}" if _PLAIN.match(part) else "['" + part.replace("'", "\\'") + "']")
    return "".join(out)


@contextmanager
def last_key_wins(spark: SparkSession) -> Iterator[None]:
    """Plans made inside read JSON objects that repeat a key; the session's setting is put back."""
    name = "spark.sql.variant.allowDuplicateKeys"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def parse_body(body: Column, response_format: str = "json", prefixes: bool = False) -> Column:
    """Body text -> VARIANT; an unparseable body gives NULL (no task failure).

    For JSON the plan must be made inside ``last_key_wins``, else an object with a repeated key is unparseable.
    """
    if response_format == "json":
        return F.try_parse_json(body)
    if response_format == "xml":
        for pattern, by in _MARKED:
            body = F.regexp_replace(body, pattern, by)
        options = {"ignoreNamespace": "false" if prefixes else "true", "mode": "PERMISSIVE"}
        # inside a higher-order function, because the generated code of from_xml into a variant does not compile in Spark 4.1
        parsed = F.get(F.transform(F.array(body), lambda b: F.from_xml(b, "variant", options)), 0)
        text = F.regexp_replace(F.regexp_replace(F.to_json(parsed), _EXACT, "$1"), _POINT_ZERO, "$1E0")
        return F.try_parse_json(F.replace(text, F.lit(_MARK), F.lit("")))
    raise ValueError(f"unknown response format {response_format!r}")


def _child(v: Column, name: str) -> Column:
    """The value of a key, or of the first key with that local name."""
    def found(value: Column) -> Column:
        fields = F.try_variant_get(value, "$", "map<string,variant>")
        local = F.filter(F.map_entries(fields), lambda e: F.substring_index(e["key"], ":", -1) == name)
        return F.coalesce(F.try_variant_get(value, variant_path(name) if ":" not in name else f"$['{name}']", "variant"), F.get(local, 0)["value"])

    return _let(v, found)


def _records_at(v: Column, field: str | None, prefixes: bool = False) -> Column:
    """ARRAY<VARIANT> at a path: an array as is, a single object wrapped, else NULL."""
    if prefixes and field:
        for name in field.split("."):
            v = _child(v, name)
        field = None

    def listed(value: Column) -> Column:
        arr = F.try_variant_get(value, "$", "array<variant>")
        return _let(arr, lambda a: F.when(a.isNotNull(), a).when(F.schema_of_variant(value).startswith("OBJECT"), F.array(value)))

    return _let(F.try_variant_get(v, variant_path(field), "variant"), listed)


def records_column(parsed: Column, field: str | None, soap: bool = False, prefixes: bool = False) -> Column:
    """The record list of one parsed body as ARRAY<VARIANT>."""
    if not soap:
        return _records_at(parsed, field, prefixes)

    def below(body: Column) -> Column:
        children = F.map_values(F.try_variant_get(body, "$", "map<string,variant>"))
        nested = F.flatten(F.filter(F.transform(children, lambda c: _records_at(c, field, prefixes)), lambda a: a.isNotNull()))
        return F.coalesce(_records_at(body, field, prefixes), _let(nested, lambda n: F.when(F.size(n) > 0, n)))

    return _let(_child(parsed, "Body") if prefixes else F.try_variant_get(parsed, "$.Body", "variant"), below)


def count_column(parsed: Column, count_field: str) -> Column:
    """The total announced by a body (BIGINT, NULL when absent)."""
    return F.try_variant_get(parsed, variant_path(count_field), "bigint")


# What a body turned out to be.
OK, UNPARSEABLE, NO_RECORDS = "ok", "unparseable", "no_records"


def _judged(parsed: Column, data_field: str | None, soap: bool, prefixes: bool, missing: str, total: Column | None = None) -> Column:
    """``status``, ``n_records`` and, if given, ``total`` of a parsed body, as a struct."""
    def told(recs: Column) -> Column:
        status = F.when(parsed.isNull(), F.lit(UNPARSEABLE)).when(recs.isNull(), F.lit(missing)).otherwise(F.lit(OK))
        n = F.when(recs.isNull(), F.lit(0)).otherwise(F.size(recs)).cast("bigint")
        return F.struct(status.alias("status"), n.alias("n_records"), *([] if total is None else [total.alias("total")]))

    return _let(records_column(parsed, data_field, soap, prefixes), told)


def body_status(body: Column, data_field: str | None, response_format: str = "json", soap: bool = False,
                prefixes: bool = False) -> tuple[Column, Column]:
    """``(status, n_records)`` of a body. In XML an empty list looks like a missing one and counts as 0 records."""
    missing = OK if response_format == "xml" else NO_RECORDS
    found = _let(parse_body(body, response_format, prefixes), lambda p: _judged(p, data_field, soap, prefixes, missing))
    return found["status"], found["n_records"]


def extract_records(
    bodies: DataFrame,
    data_field: str | None,
    response_format: str = "json",
    soap: bool = False,
    body_col: str = "body",
    keep: Sequence[str] = ("page",),
    prefixes: bool = False,
) -> DataFrame:
    """Bodies -> one row per record: ``keep`` columns, ``pos`` and ``record`` (VARIANT).

    ``pos`` is the record's 0-based place in its body, so ``(page, pos)``
    identifies a record within a load.
    """
    parsed = parse_body(F.col(body_col), response_format, prefixes)
    recs = records_column(parsed, data_field, soap, prefixes)
    with last_key_wins(bodies.sparkSession):
        return bodies.select(*keep, F.posexplode(recs).alias("pos", "record"))


def parsed_bodies(bodies: DataFrame, response_format: str = "json", body_col: str = "body", keep: Sequence[str] = ("page",),
                  prefixes: bool = False) -> DataFrame:
    """``keep`` columns and ``parsed`` (VARIANT), for bodies that are parsed and stored before their records are read more than once."""
    with last_key_wins(bodies.sparkSession):
        return bodies.select(*keep, parse_body(F.col(body_col), response_format, prefixes).alias("parsed"))


def parsed_records(parsed: DataFrame, data_field: str | None, soap: bool = False, keep: Sequence[str] = ("page",),
                   prefixes: bool = False) -> DataFrame:
    """``extract_records`` of ``parsed_bodies``."""
    return parsed.select(*keep, F.posexplode(records_column(F.col("parsed"), data_field, soap, prefixes)).alias("pos", "record"))


def body_summary(
    bodies: DataFrame,
    data_field: str | None,
    count_field: str | None = None,
    response_format: str = "json",
    soap: bool = False,
    body_col: str = "body",
    keep: Sequence[str] = ("page",),
    prefixes: bool = False,
) -> DataFrame:
    """Per body: parse status, announced total (C1) and records found."""
    def told(parsed: Column) -> Column:
        total = count_column(parsed, count_field) if count_field else F.lit(None).cast("bigint")
        return _judged(parsed, data_field, soap, prefixes, NO_RECORDS, total)

    found = _let(parse_body(F.col(body_col), response_format, prefixes), told)
    with last_key_wins(bodies.sparkSession):
        return bodies.select(*keep, found.alias("_found")).select(*keep, "_found.status", "_found.total", "_found.n_records")
