"""All queries of the library but those for training data."""

from __future__ import annotations

from . import notices, records, streams, tables, upkeep

QUERIES = dict(tables.QUERIES)
ORACLES = dict(tables.ORACLES)
__all__ = ["QUERIES", "ORACLES", "notices", "records", "streams", "upkeep"]
