"""Shape, statistics and checks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import profile
from tessera.plans.registry import query, table


@query("SELECT count(*) AS n_rows, 6 AS n_columns FROM orders")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_shape(table(spark, sf_dir, "orders"))


_NUMERIC = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
]
_WHOLE = _NUMERIC[:4]
_TEXT = ["l_returnflag", "l_linestatus"]


@query(
    " UNION ALL ".join(
        [
            f"""
            SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean,
                   round(stddev_samp({c}), 4) AS stddev,
                   cast(min({c}) AS double) AS min_value, cast(max({c}) AS double) AS max_value,
                   {f'cast(min({c}) AS bigint)' if c in _WHOLE else 'cast(NULL AS bigint)'} AS min_whole,
                   {f'cast(max({c}) AS bigint)' if c in _WHOLE else 'cast(NULL AS bigint)'} AS max_whole,
                   cast(NULL AS varchar) AS min_text, cast(NULL AS varchar) AS max_text
            FROM lineitem
            """
            for c in _NUMERIC
        ]
        + [
            f"""
            SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, NULL, NULL, min({c}), max({c}) FROM lineitem
            """
            for c in _TEXT
        ]
    )
)
def describe_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = profile.describe_long(table(spark, sf_dir, "lineitem"))
    return stats.withColumns({c: F.round(c, 4) for c in ("mean", "stddev")})


@query(
    """
    SELECT count(*) AS n_rows, cast(min(len(embedding)) AS integer) AS min_length,
           cast(max(len(embedding)) AS integer) AS max_length,
           count(*) FILTER (WHERE embedding IS NULL OR len(embedding) <> 64) AS n_wrong
    FROM embeddings
    """
)
def vector_length_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.vector_length_check(table(spark, sf_dir, "embeddings"), "embedding", 64)
