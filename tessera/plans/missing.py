"""Missing values. The tables have none, so a fixed rule makes some."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import missing
from tessera.plans.registry import query, table


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh event has no value, every eleventh no type."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 7 != 0, F.col("value").cast("int")).alias("whole_value"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_type")).alias("event_type"),
    )


_EVENTS = """
    WITH e AS (
        SELECT event_id, user_id,
               CASE WHEN event_id % 7 <> 0 THEN value END AS value,
               CASE WHEN event_id % 7 <> 0 THEN cast(trunc(value) AS integer) END AS whole_value,
               CASE WHEN event_id % 11 <> 0 THEN event_type END AS event_type
        FROM events
    )
"""


@query(_EVENTS + "SELECT * FROM e WHERE value IS NOT NULL AND event_type IS NOT NULL")
def na_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).na.drop()


@query(
    _EVENTS
    + """
    SELECT event_id, round(coalesce(value, (SELECT avg(value) FROM e)), 6) AS value,
           coalesce(whole_value, (SELECT cast(trunc(avg(whole_value)) AS integer) FROM e))
               AS whole_value
    FROM e
    """
)
def na_fill_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select("event_id", "value", "whole_value")
    filled = missing.fill_mean(events, ["value", "whole_value"])
    return filled.withColumn("value", F.round("value", 6))


@query(
    """
    SELECT c_custkey, c_name,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END
               AS c_mktsegment
    FROM customer
    """
)
def na_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return customer.na.replace("BUILDING", "CONSTRUCTION", subset=["c_mktsegment"])


@query(
    _EVENTS
    + """
    SELECT event_id, round(coalesce(value, (SELECT median(value) FROM e)), 6) AS value FROM e
    """
)
def na_fill_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _events(spark, sf_dir).select("event_id", "value")
    return missing.fill_median(events, "value").withColumn("value", F.round("value", 6))


@query(
    _EVENTS
    + """
    SELECT event_id, user_id, round(coalesce(value, median(value) OVER g), 6) AS value,
           coalesce(whole_value, cast(trunc(median(whole_value) OVER g) AS integer)) AS whole_value
    FROM e WINDOW g AS (PARTITION BY user_id, event_type)
    """
)
def na_fill_median_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns, each filled with the median of its group; some groups have no type."""
    filled = missing.fill_median(
        _events(spark, sf_dir), ["value", "whole_value"], ["user_id", "event_type"]
    )
    return filled.select("event_id", "user_id", F.round("value", 6).alias("value"), "whole_value")


@query(
    _EVENTS
    + """
    SELECT event_id, coalesce(event_type, (
               SELECT event_type FROM e WHERE event_type IS NOT NULL
               GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type
    FROM e
    """
)
def na_fill_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing.fill_mode(_events(spark, sf_dir).select("event_id", "event_type"), "event_type")


@query(
    """
    WITH o AS (
        SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 THEN cast(o_orderdate AS date) END AS day,
               CASE WHEN o_orderkey % 9 <> 0 THEN cast(round(o_totalprice, 2) AS decimal(12, 2)) END
                   AS price,
               CASE WHEN o_orderkey % 9 <> 0 THEN 1152921504606846977 + o_orderkey END AS big
        FROM orders
    )
    SELECT o_orderkey,
           coalesce(day, (SELECT day FROM o WHERE day IS NOT NULL GROUP BY day
                          ORDER BY count(*) DESC, day LIMIT 1)) AS day,
           coalesce(cast(price AS varchar), (SELECT cast(cast(
               round(sum(price)::decimal(38, 8) / count(price), 2) AS decimal(12, 2)) AS varchar) FROM o))
               AS price,
           coalesce(big, (SELECT (quantile_disc(big, 0.5) + coalesce(
               (SELECT min(big) FROM o WHERE big > (SELECT quantile_disc(big, 0.5) FROM o)
                AND (SELECT count(big) % 2 = 0 FROM o)), quantile_disc(big, 0.5))) // 2 FROM o)) AS big
    FROM o
    """
)
def na_fill_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mode of a date, mean of a decimal and median of large integers, under a dotted name."""
    there = F.col("o_orderkey") % 9 != 0
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(there, F.col("o_orderdate").cast("date")).alias("order.day"),
        F.when(there, F.round("o_totalprice", 2).cast("decimal(12,2)")).alias("order.price"),
        F.when(there, F.lit(1152921504606846977) + F.col("o_orderkey")).alias("order.big"),
    )
    filled = missing.fill_mode(orders, "order.day")
    filled = missing.fill_mean(filled, ["order.price"])
    filled = missing.fill_median(filled, "order.big")
    return filled.select(
        "o_orderkey",
        F.col("`order.day`").alias("day"),
        F.col("`order.price`").cast("string").alias("price"),
        F.col("`order.big`").alias("big"),
    )


_CUSTOMER = """
    WITH c AS (
        SELECT c_custkey, c_nationkey, c_mktsegment,
               CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS c_acctbal
        FROM customer
    ), ranked AS (
        SELECT q.c_custkey, d.c_acctbal,
               row_number() OVER (PARTITION BY q.c_custkey ORDER BY {distance}, d.c_custkey) AS nth
        FROM c q JOIN c d ON q.c_acctbal IS NULL AND d.c_acctbal IS NOT NULL
    ), filled AS (
        SELECT c_custkey, avg(c_acctbal) AS c_acctbal FROM ranked WHERE nth <= 5
        GROUP BY c_custkey
    )
    SELECT c.c_custkey, round(coalesce(c.c_acctbal, f.c_acctbal), 4) AS c_acctbal
    FROM c LEFT JOIN filled f ON c.c_custkey = f.c_custkey
"""


def _fill_balance(spark: SparkSession, sf_dir: str, features, **options) -> DataFrame:
    """Every tenth customer has no balance."""
    balance = F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal"))
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", balance.alias("c_acctbal")
    )
    filled = missing.fill_knn(customer, "c_acctbal", features, "c_custkey", **options)
    return filled.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"))


@query(_CUSTOMER.format(distance="abs(d.c_nationkey - q.c_nationkey)"))
def na_fill_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature, and many customers share its value."""
    return _fill_balance(spark, sf_dir, "c_nationkey")


@query(
    _CUSTOMER.format(
        distance="(d.c_nationkey - q.c_nationkey) ** 2 + (d.c_custkey - q.c_custkey) ** 2"
    )
)
def na_fill_knn_euclidean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fill_balance(spark, sf_dir, ["c_nationkey", "c_custkey"])


@query(
    _CUSTOMER.format(
        distance="abs(d.c_nationkey - q.c_nationkey) + abs(d.c_custkey - q.c_custkey)"
    )
)
def na_fill_knn_manhattan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fill_balance(spark, sf_dir, ["c_nationkey", "c_custkey"], metric="manhattan")


@query(
    _CUSTOMER.format(
        distance="CASE WHEN d.c_nationkey <> q.c_nationkey THEN 1 ELSE 0 END"
        " + CASE WHEN d.c_mktsegment <> q.c_mktsegment THEN 1 ELSE 0 END"
    )
)
def na_fill_knn_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fill_balance(spark, sf_dir, ["c_nationkey", "c_mktsegment"], metric="hamming")


@query(
    _CUSTOMER.format(
        distance="abs(d.c_nationkey - q.c_nationkey) ** 3 + abs(d.c_custkey - q.c_custkey) ** 3"
    )
)
def na_fill_knn_minkowski(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ["c_nationkey", "c_custkey"]
    return _fill_balance(spark, sf_dir, features, metric="minkowski", power=3.0)


def _nearest(rows: str, key: str, target: str, distance: str) -> str:
    """SQL that fills ``target`` of the common table ``r`` from its five nearest rows."""
    return f"""
    WITH r AS ({rows}), ranked AS (
        SELECT q.{key}, d.{target},
               row_number() OVER (PARTITION BY q.{key} ORDER BY {distance}, d.{key}) AS nth
        FROM r q JOIN r d ON q.{target} IS NULL AND d.{target} IS NOT NULL AND {distance} IS NOT NULL
    ), filled AS (
        SELECT {key}, avg({target}) AS found FROM ranked WHERE nth <= 5 GROUP BY {key}
    )
    SELECT r.{key}, round(coalesce(r.{target}, found), 4) AS {target}
    FROM r LEFT JOIN filled ON filled.{key} = r.{key}
    """


@query(
    _nearest(
        """SELECT event_id, epoch_us(ts) / 1e6 AS at, user_id,
                  CASE WHEN event_id % 7 <> 0 THEN value END AS value,
                  var_samp(epoch_us(ts) / 1e6) OVER () AS vt, var_samp(user_id) OVER () AS vu,
                  covar_samp(epoch_us(ts) / 1e6, user_id) OVER () AS vtu
           FROM events""",
        "event_id",
        "value",
        "(q.vu * (q.at - d.at) ** 2 - 2 * q.vtu * (q.at - d.at) * (q.user_id - d.user_id)"
        " + q.vt * (q.user_id - d.user_id) ** 2) / (q.vt * q.vu - q.vtu ** 2)",
    )
)
def na_fill_knn_mahalanobis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feature in seconds since 1970, the other in tens."""
    days = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date"))
    seconds = (days * 24 + F.hour("ts")) * 3600.0 + F.minute("ts") * 60
    events = table(spark, sf_dir, "events").select(
        "event_id",
        (seconds + F.expr("extract(SECOND FROM ts)").cast("double")).alias("at"),
        "user_id",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"),
    )
    filled = missing.fill_knn(events, "value", ["at", "user_id"], "event_id", metric="mahalanobis")
    return filled.select("event_id", F.round("value", 4).alias("value"))


@query(
    _nearest(
        """SELECT vec_id, embedding AS e, CASE WHEN vec_id % 10 <> 0 THEN label END AS label
           FROM embeddings""",
        "vec_id",
        "label",
        "list_sum(list_transform(range(1, 17), lambda i: (q.e[i]::double - d.e[i]::double) ** 2))",
    )
)
def na_fill_knn_sixteen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen features: components of vectors."""
    names = [f"e{i}" for i in range(16)]
    label = F.when(F.col("vec_id") % 10 != 0, F.col("label").cast("double"))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", label.alias("label"), *(F.col("embedding")[i].alias(n) for i, n in enumerate(names))
    )
    filled = missing.fill_knn(rows, "label", names, "vec_id")
    return filled.select("vec_id", F.round("label", 4).alias("label"))


# Features of a part: remainders, words and steps of its columns.
_PART = {
    "brand": "p_brand",
    "kind": "p_type",
    "size": "p_size",
    "first_word": "split_part(p_name, ' ', 1)",
    "second_word": "split_part(p_name, ' ', 2)",
    "step": "cast(floor(p_retailprice / 100) AS int)",
    **{f"by_{n}": f"p_partkey % {n}" for n in (3, 5, 7, 11, 13, 17)},
}


def _differ(names: list[str]) -> str:
    """Number of differing features scaled up from those that both have, null without any."""
    both = " + ".join(f"(q.{n} IS NOT NULL AND d.{n} IS NOT NULL)::int" for n in names)
    apart = " + ".join(f"coalesce(q.{n} <> d.{n}, false)::int" for n in names)
    return f"(({apart}) * {len(names)} / nullif({both}, 0)::double)"


def _parts(lacking: bool) -> str:
    """Every tenth part has no price; if ``lacking``, some have no brand, kind or size."""
    rules = {"brand": "p_partkey % 4 <> 1", "kind": "p_partkey % 6 <> 2", "size": "p_partkey % 9 <> 3"}
    chosen = [*rules] if lacking else list(_PART)
    features = ", ".join(
        f"CASE WHEN {rules[n] if lacking else 'true'} THEN {_PART[n]} END AS {n}" for n in chosen
    )
    return f"""SELECT p_partkey, CASE WHEN p_partkey % 10 <> 0 THEN p_retailprice END AS price,
                      {features} FROM part"""


def _fill_price(spark: SparkSession, sf_dir: str, lacking: bool) -> DataFrame:
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    parts = spark.sql(_parts(lacking))
    names = parts.columns[2:]
    filled = missing.fill_knn(
        parts, "price", names, "p_partkey", metric="hamming", partial=lacking
    )
    return filled.select("p_partkey", F.round("price", 4).alias("price"))


@query(_nearest(_parts(False), "p_partkey", "price", _differ(list(_PART))))
def na_fill_knn_hamming_twelve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve categories."""
    return _fill_price(spark, sf_dir, lacking=False)


@query(_nearest(_parts(True), "p_partkey", "price", _differ(["brand", "kind", "size"])))
def na_fill_knn_hamming_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories that some of the parts lack."""
    return _fill_price(spark, sf_dir, lacking=True)


_LACKING = """SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS c_acctbal,
                     CASE WHEN c_custkey % 6 NOT IN (1, 2) THEN c_nationkey END AS nation,
                     CASE WHEN c_custkey % 4 <> 2 THEN c_custkey END AS place
              FROM customer"""


@query(
    _nearest(
        _LACKING,
        "c_custkey",
        "c_acctbal",
        "((coalesce((q.nation - d.nation) ** 2, 0) + coalesce((q.place - d.place) ** 2, 0)) * 2"
        " / nullif((q.nation IS NOT NULL AND d.nation IS NOT NULL)::int"
        " + (q.place IS NOT NULL AND d.place IS NOT NULL)::int, 0)::double)",
    )
)
def na_fill_knn_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers that lack one or both features; those without any stay unfilled."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("customer")
    filled = missing.fill_knn(
        spark.sql(_LACKING), "c_acctbal", ["nation", "place"], "c_custkey", partial=True
    )
    return filled.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"))
