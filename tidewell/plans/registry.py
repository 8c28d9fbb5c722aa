"""Names of the sales queries, their Spark functions and their DuckDB SQL."""

from __future__ import annotations

from tidewell.plans import customer_queries, layer_queries, stream_queries  # noqa: F401  (registers its queries)
from tidewell.plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
