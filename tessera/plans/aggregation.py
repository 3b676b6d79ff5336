"""Grouped and global aggregates, through the DataFrame API and through SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.aggregates import (
    collect_distinct,
    collect_values,
    first_last,
    grouped_means,
    grouped_range_stats,
)
from tessera.plans.registry import query, table
from tessera.session import register_view


def rounded(df: DataFrame, *columns: str, places: int = 4) -> DataFrame:
    """Round means, whose last digits depend on the order of addition."""
    return df.withColumns({c: F.round(c, places) for c in columns})


@query(
    """
    SELECT p_brand, round(avg(p_size), 4) AS avg_p_size,
           round(avg(p_retailprice), 4) AS avg_p_retailprice
    FROM part GROUP BY p_brand
    """
)
def group_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["p_size", "p_retailprice"]
    means = grouped_means(table(spark, sf_dir, "part"), "p_brand", columns)
    return rounded(means, *(f"avg_{c}" for c in columns))


@query(
    """
    SELECT l_returnflag,
           cast(min(l_shipdate) AS date) AS first_date,
           cast(max(l_shipdate) AS date) AS last_date,
           min(l_quantity) AS min_l_quantity, max(l_quantity) AS max_l_quantity,
           round(avg(l_quantity), 4) AS avg_l_quantity,
           min(l_extendedprice) AS min_l_extendedprice,
           max(l_extendedprice) AS max_l_extendedprice,
           round(avg(l_extendedprice), 4) AS avg_l_extendedprice,
           min(l_discount) AS min_l_discount, max(l_discount) AS max_l_discount,
           round(avg(l_discount), 4) AS avg_l_discount
    FROM lineitem
    WHERE l_shipdate >= timestamp '1996-01-02' AND l_shipdate <= timestamp '1998-01-31'
    GROUP BY l_returnflag
    """
)
def group_min_max_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate")
    in_range = (day >= F.lit("1996-01-02")) & (day <= F.lit("1998-01-31"))
    measures = ["l_quantity", "l_extendedprice", "l_discount"]
    stats = grouped_range_stats(
        table(spark, sf_dir, "lineitem").filter(in_range),
        "l_returnflag",
        day.cast("date"),
        measures,
    )
    return rounded(stats, *(f"avg_{c}" for c in measures))


@query(
    """
    SELECT c_mktsegment, round(avg(c_acctbal), 4) AS average_balance
    FROM customer GROUP BY c_mktsegment
    """
)
def sql_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(table(spark, sf_dir, "customer"), "customer_view")
    return spark.sql(
        """
        SELECT c_mktsegment, round(avg(c_acctbal), 4) AS average_balance
        FROM customer_view
        GROUP BY c_mktsegment
        """
    )


@query(
    """
    SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n
    FROM lineitem GROUP BY l_returnflag, l_linestatus, l_linenumber
    ORDER BY n DESC, l_returnflag, l_linestatus, l_linenumber
    """
)
def sql_stack_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_view(table(spark, sf_dir, "lineitem"), "lineitem_view")
    return spark.sql(
        """
        SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n
        FROM lineitem_view
        GROUP BY l_returnflag, l_linestatus, l_linenumber
        ORDER BY n DESC, l_returnflag, l_linestatus, l_linenumber
        """
    )


@query("SELECT round(avg(c_acctbal), 4) AS mean_balance FROM customer")
def global_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.round(F.mean("c_acctbal"), 4).alias("mean_balance")
    )


@query("SELECT count(*) AS n_rows FROM orders")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").agg(F.count("*").alias("n_rows"))


@query("SELECT count(*) AS n_distinct FROM (SELECT DISTINCT p_name, p_brand, p_type FROM part)")
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .select("p_name", "p_brand", "p_type")
        .distinct()
        .agg(F.count("*").alias("n_distinct"))
    )


@query(
    """
    SELECT o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total_price
    FROM orders GROUP BY o_orderpriority
    """
)
def group_count_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderpriority")
        .agg(
            F.count("*").alias("n_orders"),
            F.round(F.sum("o_totalprice"), 2).alias("total_price"),
        )
    )


@query(
    """
    SELECT user_id, arg_min(value, event_id) AS first_value,
           arg_max(value, event_id) AS last_value
    FROM events GROUP BY user_id
    """
)
def group_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_last(table(spark, sf_dir, "events"), "user_id", "value", ["event_id"])


@query(
    """
    SELECT user_id, arg_min(value, event_id) FILTER (value > 50) AS first_value,
           arg_max(value, event_id) FILTER (value > 50) AS last_value
    FROM events GROUP BY user_id
    """
)
def group_first_last_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small values count as missing and are passed over."""
    events = table(spark, sf_dir, "events").withColumn("value", F.expr("nullif(value, if(value > 50, null, value))"))
    return first_last(events, "user_id", "value", ["event_id"], ignore_nulls=True)


@query(
    """
    SELECT o_custkey, chunk, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS items
    FROM (SELECT o_custkey, o_orderkey, cast((row_number() OVER (
                     PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 4 AS integer) AS chunk
          FROM orders)
    GROUP BY o_custkey, chunk
    """
)
def group_collect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of four values; most customers have several."""
    lists = collect_values(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", list_rows=4)
    return lists.withColumn("items", F.array_join("items", ","))


@query(
    """
    SELECT o_custkey, chunk, string_agg(o_orderpriority, ',' ORDER BY o_orderpriority) AS items
    FROM (SELECT o_custkey, o_orderpriority, cast((row_number() OVER (
                     PARTITION BY o_custkey ORDER BY o_orderpriority) - 1) // 2 AS integer) AS chunk
          FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders))
    GROUP BY o_custkey, chunk
    """
)
def group_collect_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = collect_distinct(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority", list_rows=2)
    return sets.withColumn("items", F.array_join("items", ","))
