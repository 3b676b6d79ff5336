"""Classes, sample plans and samples."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import sampling
from tessera.plans.registry import query, table
from tessera.sinks import read_by_label, write_by_label
from tessera.workspace import scratch_path

WANTED = ["src0", "src3", "src7", "not_there"]


@query("SELECT DISTINCT source FROM documents")
def strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.strata(table(spark, sf_dir, "documents"), "source")


@query(
    """
    SELECT source, count(*) AS n, grouping(source) = 1 AS is_total
    FROM documents GROUP BY ROLLUP (source)
    """
)
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_counts_with_total(table(spark, sf_dir, "documents"), "source")


@query(
    f"""
    SELECT w.source, count(d.doc_id) AS n
    FROM (SELECT unnest({WANTED}) AS source) w LEFT JOIN documents d ON d.source = w.source
    GROUP BY w.source
    """
)
def class_counts_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.class_counts_of(table(spark, sf_dir, "documents"), WANTED, "source")


@query("SELECT count(DISTINCT source) AS n_classes FROM documents")
def class_count_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").agg(F.count_distinct("source").alias("n_classes"))


def _proportional(source: str, label: str, size: int) -> str:
    """Common tables ``plan`` of the proportional rule, with the label as its seed key."""
    return f"""
    WITH counts AS (
        SELECT {label} AS label, count(*) AS c FROM {source} GROUP BY {label}
    ), drafted AS (
        SELECT label, c,
               cast(round_even({size} / (SELECT sum(c) FROM counts)::double * c, 0) AS bigint) AS q
        FROM counts
    ), residual AS (
        SELECT {size} - sum(q) AS r FROM drafted
    ), movable AS (
        SELECT label, row_number() OVER (ORDER BY md5('42:' || label)) AS nth
        FROM drafted, residual WHERE (r > 0 AND q < c) OR (r < 0 AND q > 0)
    ), plan AS (
        SELECT d.label, d.c AS n,
               cast(d.q + CASE WHEN m.nth <= abs(r) THEN sign(r) ELSE 0 END AS bigint) AS quota
        FROM drafted d CROSS JOIN residual LEFT JOIN movable m ON m.label = d.label
    )
    """


def _equal(source: str, label: str, size: int) -> str:
    """Common tables ``plan`` of the equal rule."""
    return f"""
    WITH RECURSIVE counts AS (
        SELECT {label} AS label, count(*) AS c,
               row_number() OVER (ORDER BY {label}) AS nth
        FROM {source} GROUP BY {label}
    ), shape AS (
        SELECT count(*) AS k, {size} // count(*) AS base, {size} % count(*) AS extra FROM counts
    ), walk AS (
        SELECT cast(0 AS bigint) AS nth, cast(NULL AS varchar) AS label, cast(0 AS bigint) AS n,
               cast(0 AS bigint) AS quota, cast(extra AS bigint) AS carry
        FROM shape
        UNION ALL
        SELECT c.nth, c.label, c.c,
               least(c.c, base + CASE WHEN carry > 0 THEN 1 ELSE 0 END),
               CASE WHEN c.c >= base + CASE WHEN carry > 0 THEN 1 ELSE 0 END
                    THEN greatest(carry - 1, 0)
                    ELSE carry + base + CASE WHEN carry > 0 THEN 1 ELSE 0 END - c.c END
        FROM walk w JOIN counts c ON c.nth = w.nth + 1, shape
    ), plan AS (
        SELECT label, n, quota FROM walk WHERE nth > 0
    )
    """


@query(_proportional("part", "p_type", 100) + "SELECT label AS p_type, n, quota FROM plan")
def sample_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = sampling.class_counts(table(spark, sf_dir, "part"), "p_type")
    return sampling.proportional_plan(counts, 100, "p_type")


@query(
    _proportional("documents", "source", 90)
    + "SELECT cast(sum(quota) AS bigint) AS n_planned, count(*) AS n_classes FROM plan"
)
def plan_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = sampling.class_counts(table(spark, sf_dir, "documents"), "source")
    return sampling.proportional_plan(counts, 90, "source").agg(
        F.sum("quota").alias("n_planned"), F.count("*").alias("n_classes")
    )


@query(
    _proportional("part", "p_type", 100)
    + """
    , ranked AS (
        SELECT *, row_number() OVER (
                   PARTITION BY p_type ORDER BY md5('42:' || p_partkey)) AS nth
        FROM part
    )
    SELECT p_partkey, p_name, p_type, p_retailprice
    FROM ranked JOIN plan ON label = p_type WHERE nth <= quota
    """
)
def sample_proportional(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    return sampling.sample_proportional(part, 100, "p_type", "p_partkey").rows


@query(
    _proportional("lineitem", "l_returnflag", 3000)
    + """
    , ranked AS (
        SELECT *, row_number() OVER (
                   PARTITION BY l_returnflag
                   ORDER BY md5('42:' || length(l_orderkey::varchar) || '.' || l_orderkey
                                || ':' || length(l_partkey::varchar) || '.' || l_partkey
                                || ':' || length(l_suppkey::varchar) || '.' || l_suppkey
                                || ':' || length(l_linenumber::varchar) || '.' || l_linenumber)
               ) AS nth
        FROM lineitem
    )
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_extendedprice
    FROM ranked JOIN plan ON label = l_returnflag WHERE nth <= quota
    """
)
def sample_few_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three classes, each with about a third of all rows."""
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lineitem = table(spark, sf_dir, "lineitem").select(*key, "l_returnflag", "l_extendedprice")
    return sampling.sample_proportional(lineitem, 3000, "l_returnflag", key).rows


@query(
    _equal("documents", "source || '-' || lang", 100)
    + "SELECT label, n, quota FROM plan"
)
def sample_equal_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.equal_plan(sampling.class_counts(_by_language(spark, sf_dir)), 100)


@query(
    _equal("documents", "source || '-' || lang", 100)
    + """
    , ranked AS (
        SELECT doc_id, source || '-' || lang AS class, n_chars, row_number() OVER (
                   PARTITION BY source, lang ORDER BY md5('42:' || doc_id)) AS nth
        FROM documents
    )
    SELECT doc_id, label, n_chars FROM ranked JOIN plan ON label = class WHERE nth <= quota
    """
)
def sample_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _by_language(spark, sf_dir).select("doc_id", "label", "n_chars")
    return sampling.sample_equal(documents, 100, "label", "doc_id").rows


def _by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of very different size."""
    return table(spark, sf_dir, "documents").withColumn(
        "label", F.concat_ws("-", "source", "lang")
    )


@query(
    _proportional("documents", "source", 90)
    + """
    , ranked AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY md5('42:' || doc_id)) AS nth
        FROM documents
    )
    SELECT doc_id, source, text FROM ranked JOIN plan ON label = source WHERE nth <= quota
    """
)
def sample_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample is written to one folder per class and read back with its payload."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sample = sampling.sample_proportional(documents, 90, "source", "doc_id")
    path = scratch_path(spark, "sample")
    write_by_label(sample.rows, path, "source", files_per_label=1, spread_by="doc_id")
    return read_by_label(spark, path, "source")
