"""Projections, derived columns, order and limit."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.registry import query, table


@query("SELECT p_type FROM part")
def select_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_type")


@query("SELECT l_quantity, l_extendedprice, l_discount FROM lineitem")
def select_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        ["l_quantity", "l_extendedprice", "l_discount"]
    )


@query(
    """
    SELECT o_orderkey, o_totalprice, cast(o_orderdate AS date) AS order_day FROM orders
    """
)
def add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.withColumn("order_day", orders.o_orderdate.cast("date")).select(
        "o_orderkey", "o_totalprice", "order_day"
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice AS total_price, o_orderpriority
    FROM orders
    """
)
def rename_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .withColumnRenamed("o_totalprice", "total_price")
        .withColumnRenamed("no_such_column", "ignored")
        .drop("o_orderdate")
    )


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def drop_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").drop("c_mktsegment")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
           CASE WHEN l_extendedprice >= 50000.0 THEN 1 ELSE 0 END AS is_large
    FROM lineitem
    """
)
def case_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        F.when(lineitem["l_extendedprice"] >= 50000.0, 1).otherwise(0).alias("is_large"),
    )


@query(
    """
    SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
    """
)
def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", "o_totalprice", "o_orderpriority")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(10)
    )


@query(
    """
    SELECT cast(l_shipdate AS date) AS ship_day, l_orderkey, l_linenumber,
           l_quantity, l_extendedprice
    FROM lineitem WHERE l_returnflag = 'R'
    ORDER BY ship_day, l_orderkey, l_linenumber
    """
)
def series_for_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order ends in the row's key, so a day with many rows can be split."""
    return (
        table(spark, sf_dir, "lineitem")
        .where(F.col("l_returnflag") == "R")
        .select(
            F.col("l_shipdate").cast("date").alias("ship_day"),
            "l_orderkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
        )
        .orderBy("ship_day", "l_orderkey", "l_linenumber")
    )
