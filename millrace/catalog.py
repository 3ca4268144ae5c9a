"""All queries of the library and their SQL."""

from __future__ import annotations

from .plans import builders, checks, documents, files, leaks, measures, more, sampling, sinks, texts  # noqa: F401  (they register their queries)
from .plans.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
