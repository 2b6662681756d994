"""All registered queries of the engine, and their DuckDB twins."""

from __future__ import annotations

from . import curate_queries, entry_queries, file_queries, gate_queries, quota_queries, stream_queries, text_queries  # noqa: F401  they register themselves
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
