"""All registered queries."""

from dwellspark.plans import (  # noqa: F401
    fixtures,
    queries_filters,
    queries_managers,
    queries_norms,
    queries_series,
    queries_sources,
    queries_tracking,
)
from dwellspark.plans import queries_runs  # noqa: E402, F401, I001  (uses the SQL of the others)
from dwellspark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
