"""Predicates."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.predicates import not_any_of
from tessera.plans.registry import query, table


@query(
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice, cast(l_shipdate AS date) AS ship_day
    FROM lineitem
    WHERE l_shipdate >= timestamp '1998-01-01' AND l_shipdate <= timestamp '1998-01-31'
    """
)
def filter_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String literals against a timestamp; coerced once, then pushed to the scan."""
    return (
        table(spark, sf_dir, "lineitem")
        .filter(
            (F.col("l_shipdate") >= F.lit("1998-01-01"))
            & (F.col("l_shipdate") <= F.lit("1998-01-31"))
        )
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_extendedprice",
            F.col("l_shipdate").cast("date").alias("ship_day"),
        )
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_totalprice BETWEEN 100000.0 AND 200000.0
    """
)
def filter_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.filter(orders.o_totalprice.between(100000.0, 200000.0)).select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_mktsegment") == "BUILDING")
        .select("c_custkey", "c_name", "c_acctbal")
    )


@query(
    """
    SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer
    WHERE (c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY')
      AND NOT (c_acctbal < 0.0) AND c_nationkey >= 5
    """
)
def filter_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    return (
        table(spark, sf_dir, "customer")
        .filter(
            ((segment == "BUILDING") | (segment == "MACHINERY"))
            & ~(balance < 0.0)
            & (F.col("c_nationkey") >= 5)
        )
        .select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    )


@query(
    """
    SELECT DISTINCT p_brand, p_name, regexp_matches(p_name, '^[b, r]') AS starts_with_b_or_r
    FROM part
    """
)
def rlike_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class also holds the comma and the space, so those match as well."""
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_brand", "p_name", part.p_name.rlike("^[b, r]").alias("starts_with_b_or_r")
    ).distinct()


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' AND p_name LIKE 's_a%'")
def filter_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.col("p_name")
    return (
        table(spark, sf_dir, "part")
        .where(name.like("%ring%") & name.like("s_a%"))
        .select("p_partkey", "p_name")
    )


@query(
    """
    SELECT kind, round(avg(p_retailprice), 4) AS avg_price, round(avg(p_size), 4) AS avg_size
    FROM (SELECT CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS kind,
                 p_retailprice, p_size FROM part)
    WHERE kind IS DISTINCT FROM 'ECONOMY' AND kind IS DISTINCT FROM 'MEDIUM'
    GROUP BY kind
    """
)
def exclude_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two kinds are left out and the rows without a kind stay.

    Catalyst moves the predicate below the aggregate, to the scan.
    """
    kind = F.when(F.col("p_type") != "PROMO", F.col("p_type"))
    return (
        table(spark, sf_dir, "part")
        .groupBy(kind.alias("kind"))
        .agg(
            F.round(F.avg("p_retailprice"), 4).alias("avg_price"),
            F.round(F.avg("p_size"), 4).alias("avg_size"),
        )
        .where(not_any_of(F.col("kind"), ["ECONOMY", "MEDIUM"]))
    )
