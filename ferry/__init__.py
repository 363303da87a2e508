"""ferry: move records between paged APIs and tables with Spark doing the data work.

Inbound: plan pages, fetch them on executors, land the raw bodies, extract and
type the records under an inferred, evolving schema, wrap them in an envelope
and append them so that a rerun does not duplicate rows.

Outbound: run a SQL query, split the result into stable batches, encode each
batch as JSON or XML and hand it to a user-supplied ``send`` callable,
skipping batches that were already delivered.

Everything is a DataFrame transformation; the driver only sees scalars and
small, bounded metadata (schemas, block counts).
"""

import sys

from ferry.config import ExchangeConfig

# Functions of this package run on executors (mapInPandas, foreachBatch).
# Pickling them by value means the Python workers need not import the
# package, so nothing has to be shipped with --py-files for them to work.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark: ship the package instead
    pass

__all__ = ["ExchangeConfig"]
