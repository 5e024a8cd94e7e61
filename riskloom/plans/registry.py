"""Everything that is registered; importing a query module registers its queries."""

from riskloom.plans import feature_queries, ml_queries, stream_queries, table_queries  # noqa: F401
from riskloom.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
