"""A paged API stand-in for the flow tests: serves records from a list.

Picklable (plain class, module importable by the Python workers), so it can be
the ``fetch`` callable run on executors. ``fail_pages`` makes chosen pages
raise, and ``fail_marker`` (a file path) switches the failure off once the
file exists, to test a rerun after a failed page.
"""

from __future__ import annotations

import json
import os
import xml.sax.saxutils as su


class FakeApi:
    def __init__(self, records, page_size=None, count_field="total", fmt="json",
                 fail_pages=(), fail_marker=None, pagination="limit-offset"):
        self.records = list(records)
        self.page_size = page_size
        self.count_field = count_field
        self.fmt = fmt
        self.fail_pages = set(fail_pages)
        self.fail_marker = fail_marker
        self.pagination = pagination

    def _slice(self, req):
        if req.get("kind") == "count":
            return []
        if "offset" in req:
            o, l = int(req["offset"]), int(req["limit"])
            return self.records[o:o + l]
        if "pageIndex" in req:
            s = int(req["pageSize"])
            i = int(req["pageIndex"]) - 1
            return self.records[i * s:(i + 1) * s]
        return self.records

    def __call__(self, req):
        page = req.get("page")
        if page in self.fail_pages and not (self.fail_marker and os.path.exists(self.fail_marker)):
            raise RuntimeError(f"page {page} unavailable")
        items = self._slice(req)
        if self.fmt == "xml":
            parts = []
            for r in (self.records if req.get("kind") == "count" else items):
                fields = "".join(f"<{k}>{su.escape(str(v))}</{k}>" for k, v in r.items() if v is not None)
                parts.append(f"<item>{fields}</item>")
            return "<root>" + "".join(parts) + "</root>"
        body = {"data": {"items": items}}
        if self.count_field:
            body[self.count_field] = len(self.records)
        return json.dumps(body)


class Recorder:
    """A ``send`` that appends each delivered body to a file per batch."""

    def __init__(self, folder, fail_batches=()):
        self.folder = folder
        self.fail_batches = set(fail_batches)

    def __call__(self, batch_num, body):
        if batch_num in self.fail_batches and not os.path.exists(os.path.join(self.folder, "heal")):
            raise RuntimeError("receiver down")
        with open(os.path.join(self.folder, f"batch-{batch_num:06d}-{os.getpid()}-{id(body)}"), "w") as f:
            f.write(body)
