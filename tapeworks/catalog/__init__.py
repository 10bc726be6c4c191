"""Named queries over the test tables, each with the SQL that must agree with it."""

from __future__ import annotations

from tapeworks.catalog import adapters, discovery, manifest, readers, rows, sinks, streams
from tapeworks.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "adapters", "discovery", "manifest", "readers", "rows", "sinks", "streams"]
