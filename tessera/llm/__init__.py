"""Operators for training-data pipelines and their registered queries."""

from tessera.llm import queries as _queries  # noqa: F401  (importing registers)
from tessera.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
