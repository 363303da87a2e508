"""Typed job configuration.

The keys of the dictionary form are the ones the exchange jobs are configured
with (hyphenated names, nested ``params``/``body`` for paging). Unknown values
for the dispatch keys raise ``ValueError`` before any Spark work starts.
Transport keys (url, headers, credentials) are not read here: the user's
``fetch``/``send`` callables own the transport.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any, Mapping

# The accepted settings of the dispatch keys.
DATAFLOWS = ("Inbound", "Outbound")
PAGINATION_TYPES = ("limit-offset", "pageindex-size")
RESPONSE_FORMATS = ("json", "xml")
API_DATAFORMATS = ("array_dict", "dict", "xml", "nested_json")


@dataclass(frozen=True)
class ExchangeConfig:
    source_id: str
    destination_id: str = ""
    dataflow: str = "Inbound"
    # inbound paging: None = one unpaged request
    pagination_type: str | None = None
    page_size: int | None = None  # params.limit or body.pageSize
    response_format: str = "json"
    data_field: str | None = None  # dotted path to the record list
    count_field: str | None = None  # dotted path to the total
    namespace: str | None = None  # XML: if set, names keep their prefixes, so two namespaces stay apart
    soap: bool = False  # 'wsdl' endpoints: records found below the SOAP Body
    table_name: str | None = None
    df_limit: int | None = None  # rows per landing wave
    # outbound
    source_query: str | None = None
    api_limit: int | None = None
    api_dataformat: str | None = None
    xml_root: str = "root"
    xml_item: str = "item"
    # incremental
    adhoc_start_date: str | None = None
    # landing: at least this many pages per fetch task in a wave (one file each)
    min_pages_per_task: int = 32

    def __post_init__(self) -> None:
        if self.dataflow not in DATAFLOWS:
            raise ValueError(f"dataflow must be one of {DATAFLOWS}, got {self.dataflow!r}")
        if self.pagination_type is not None and self.pagination_type not in PAGINATION_TYPES:
            raise ValueError(f"pagination-type must be one of {PAGINATION_TYPES}, got {self.pagination_type!r}")
        if self.pagination_type is not None and (self.page_size is None or self.page_size < 1):
            raise ValueError("a paged source needs a page size of at least 1")
        if self.response_format not in RESPONSE_FORMATS:
            raise ValueError(f"response-format must be one of {RESPONSE_FORMATS}, got {self.response_format!r}")
        if self.api_dataformat is not None and self.api_dataformat not in API_DATAFORMATS:
            raise ValueError(f"api-dataformat must be one of {API_DATAFORMATS}, got {self.api_dataformat!r}")
        if self.api_limit is not None and self.api_limit < 1:
            raise ValueError("api-limit must be at least 1")
        if self.dataflow == "Outbound" and self.api_dataformat is None:
            raise ValueError("an outbound flow needs api-dataformat")

    @classmethod
    def from_dict(cls, conf: Mapping[str, Any]) -> "ExchangeConfig":
        """Build from the hyphenated dictionary form."""
        ptype = conf.get("pagination-type") or None
        page_size = None
        if ptype == "limit-offset":
            page_size = (conf.get("params") or {}).get("limit")
        elif ptype == "pageindex-size":
            page_size = (conf.get("body") or {}).get("pageSize")
        table = None
        if conf.get("table-name"):
            parts = [conf.get("catalog-name"), conf.get("schema-name"), conf.get("table-name")]
            table = ".".join(p for p in parts if p)
        return cls(
            source_id=str(conf["source-id"]),
            destination_id=str(conf.get("destination-id", "")),
            dataflow=conf.get("dataflow", "Inbound"),
            pagination_type=ptype,
            page_size=page_size,
            response_format=conf.get("response-format", "json"),
            data_field=conf.get("data-field"),
            count_field=conf.get("count-field"),
            namespace=conf.get("namespace"),
            soap="wsdl" in str(conf.get("url", "")),
            table_name=table,
            df_limit=conf.get("df-limit"),
            source_query=conf.get("source-query"),
            api_limit=conf.get("api-limit"),
            api_dataformat=conf.get("api-dataformat"),
            adhoc_start_date=conf.get("adhoc_start_date") or None,
        )

    def with_(self, **changes: Any) -> "ExchangeConfig":
        return replace(self, **changes)

    @property
    def wave_pages(self) -> int:
        """Pages fetched and landed per Spark job by the flush rule (df-limit rows); 0 without one."""
        if not self.pagination_type or not self.df_limit or not self.page_size:
            return 0
        return max(1, -(-int(self.df_limit) // int(self.page_size)))

    def wave_size(self, cores: int) -> int:
        """Pages per wave on a cluster with ``cores`` task slots.

        ``df-limit`` decides if it is given. Without it, ``min_pages_per_task``
        pages per core: a wave keeps every slot busy, each task lands one file
        of a useful size, and a large source is not cut into a huge number of
        small jobs. A wave is the unit lost on failure.
        """
        return self.wave_pages or max(1, int(self.min_pages_per_task)) * max(1, int(cores))
