"""All registered queries and their SQL."""

from __future__ import annotations

from .queries import boundaries, connectors, extracts, feeds, health, scans, stores, stories, texts
from .queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "boundaries", "connectors", "extracts", "feeds", "health", "scans", "stores", "stories", "texts"]
