from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def small(spark):
    """Makes a one-partition-or-more table from rows and a schema."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)

    return make
