"""Request bodies (K7-K10) as column expressions.

  array_dict   one JSON array of objects per batch
  dict         one JSON object per row (one request per row)
  nested_json  {"results": [ ... ]} per batch
  xml          <root><item>...</item>...</root> per batch
JSON keeps null fields; XML omits them and escapes text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_JSON = {"ignoreNullFields": "false"}


def nest_at(path: str, value: Column) -> Column:
    """Wrap ``value`` in objects along a dotted path: ``a.b`` -> {"a": {"b": value}}."""
    for part in reversed(path.split(".")):
        value = F.struct(value.alias(part))
    return value


def array_dict_body(items: Column) -> Column:
    """K7: ``[{...}, {...}]``."""
    return F.to_json(items, _JSON)


def dict_body(row: Column) -> Column:
    """K8: ``{...}`` for a single row."""
    return F.to_json(row, _JSON)


def nested_json_body(items: Column, key: str = "results") -> Column:
    """``{"results": [...]}``; ``key`` may be a dotted path."""
    return F.to_json(nest_at(key, items), _JSON)


def xml_body(items: Column, root: str = "root", item: str = "item") -> Column:
    """K9: ``<root><item>...</item>...</root>``."""
    return F.to_xml(F.struct(items.alias(item)), {"rowTag": root})


def encode_batch(items: Column, api_dataformat: str, root: str = "root", item: str = "item") -> Column:
    if api_dataformat == "array_dict":
        return array_dict_body(items)
    if api_dataformat == "nested_json":
        return nested_json_body(items)
    if api_dataformat == "xml":
        return xml_body(items, root, item)
    raise ValueError(f"api-dataformat {api_dataformat!r} is not a batch format")
