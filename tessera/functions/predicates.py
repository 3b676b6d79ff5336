"""Predicates whose null handling differs from SQL's comparison operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F


def not_any_of(column: Column, values: Sequence[object]) -> Column:
    """True unless ``column`` equals one of ``values``; nulls are kept."""
    return reduce(and_, (~column.eqNullSafe(F.lit(value)) for value in values), F.lit(True))
