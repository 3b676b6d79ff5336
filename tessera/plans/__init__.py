"""The registered queries, each next to the SQL it is compared with."""

from tessera.plans import (  # noqa: F401  (importing registers the queries)
    aggregation,
    columns,
    features,
    filters,
    missing,
    paths,
    profile,
    sampling,
    tables,
    text,
)
from tessera.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
