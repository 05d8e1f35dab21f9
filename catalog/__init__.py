"""Every query of the library on the given tables."""

from catalog import features, live, models, pricing, reports, tables  # noqa: F401
from catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
