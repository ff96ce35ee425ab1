"""Registered queries over the driver tables, each with DuckDB SQL where expressible."""

from catalog.registry import ORACLES, QUERIES
from catalog import cleaning_queries, model_queries, profile_queries, storage_queries, trading_queries, window_queries  # noqa: F401  (registers its queries)

__all__ = ["ORACLES", "QUERIES"]
