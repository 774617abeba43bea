"""Every operator as a named query over the given tables, with a plain-SQL counterpart."""

from sparkgrad.catalog import backward, forward, loops, records, reshaping, sigmoid, streams, tiled  # noqa: F401
from sparkgrad.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
