"""Round trips through the file formats and folders.

What is written goes to the shared folder, to a new path each time.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.paths import path_label
from tessera.plans.registry import query, table
from tessera.sinks import read_by_label, save, write_by_label, write_csv, write_json, write_parquet, write_text
from tessera.sinks.files import write_files
from tessera.sources import (
    list_files,
    listed_files,
    read_csv,
    read_files,
    read_json,
    read_parquet,
    read_text_files,
    read_text_lines,
)
from tessera.workspace import scratch_path


@query("SELECT cast(n_nationkey AS varchar) AS n_nationkey, n_name FROM nation")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected columns, with header; without a schema all come back as strings."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "nation"), path, ["n_nationkey", "n_name"])
    return read_csv(spark, path, header=True)


@query("SELECT doc_id, text, lang FROM documents")
def csv_multiline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line ends, quotes and white space at their ends come back as they were."""
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "documents"), path, ["doc_id", "text", "lang"])
    schema = "doc_id bigint, text string, lang string"
    return read_csv(spark, path, header=True, schema=schema, multiline=True)


@query("SELECT replace(text, chr(10), ' / ') AS value FROM documents")
def text_line_ends_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text")
    write_text(table(spark, sf_dir, "documents"), path, "text", line_end=" / ")
    return read_text_lines(spark, path)


@query(
    """
    SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '00' || (p_size % 3) WHEN 1 THEN ''
                      WHEN 2 THEN cast(p_size AS varchar) END AS label
    FROM part
    """
)
def labels_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that look like numbers, are empty or null come back from folders as they were."""
    path = scratch_path(spark, "labels")
    size = F.col("p_size")
    label = (
        F.when(size % 4 == 0, F.concat(F.lit("00"), size % 3))
        .when(size % 4 == 1, "")
        .when(size % 4 == 2, size.cast("string"))
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))
    write_by_label(parts, path, files_per_label=2, spread_by="p_partkey")
    return read_by_label(spark, path)


@query(
    """
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price,
           cast(o_orderdate AS date) AS day, true AS priority_unreadable
    FROM orders
    """
)
def csv_declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names go by position, and the text in the integer column becomes null."""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    write_csv(
        orders, path, ["o_orderkey", "o_orderstatus", "o_totalprice", "day", "o_orderpriority"]
    )
    declared = read_csv(
        spark,
        path,
        header=True,
        schema="order_id bigint, status string, price double, day date, priority int",
    )
    return declared.withColumn("priority_unreadable", F.col("priority").isNull()).drop("priority")


@query(
    """
    SELECT cast(n_nationkey AS bigint) AS n_nationkey, n_name,
           cast(n_regionkey AS bigint) AS n_regionkey
    FROM nation
    """
)
def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json")
    write_json(table(spark, sf_dir, "nation"), path)
    return read_json(spark, path)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, sf_dir, "supplier"), path)
    return read_parquet(spark, path)


@query("SELECT l_orderkey, l_quantity, l_extendedprice, l_discount FROM lineitem")
def save_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "saved")
    columns = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount"]
    save(table(spark, sf_dir, "lineitem"), path, "parquet", columns)
    return read_parquet(spark, path)


@query("SELECT url AS value FROM pages")
def text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "text")
    write_text(table(spark, sf_dir, "pages"), path, "url")
    return read_text_lines(spark, path)


@query("SELECT cast(r_regionkey AS varchar) AS _c0, r_name AS _c1 FROM region")
def csv_no_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    write_csv(table(spark, sf_dir, "region"), path, header=False)
    return read_csv(spark, path)


@query("SELECT c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a separator of its own; numbers come back as numbers."""
    path = scratch_path(spark, "csv")
    columns = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    write_csv(table(spark, sf_dir, "customer"), path, columns, sep="|")
    return read_csv(spark, path, sep="|", header=True, infer=True)


@query("SELECT cast(sum(length(url) + 1) AS bigint) AS n_chars FROM pages")
def whole_text_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """However many files the lines went to, their contents add up."""
    path = scratch_path(spark, "text")
    write_text(table(spark, sf_dir, "pages"), path, "url")
    return read_text_files(spark, path).agg(F.sum(F.length("value")).alias("n_chars"))


@query("SELECT DISTINCT 'source=' || source AS folder FROM documents")
def listed_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class folders that a listing finds; no file is opened for it."""
    path = scratch_path(spark, "folders")
    write_by_label(table(spark, sf_dir, "documents").select("doc_id", "source"), path, "source",
                   files_per_label=1, spread_by="doc_id")
    listing = list_files(spark, path, "parquet", recursive=True)
    return listing.select(path_label("path").alias("folder")).distinct()


@query(
    """
    SELECT source AS label,
           doc_id || CASE WHEN doc_id % 2 = 0 THEN '.txt' ELSE '.md' END AS file,
           strlen(coalesce(text, '')) AS length, md5(coalesce(text, '')) AS digest
    FROM documents
    """
)
def scanned_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a file in its source's folder, found by a glob and read, all by tasks."""
    path = scratch_path(spark, "tree")
    end = F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise(".md")
    documents = table(spark, sf_dir, "documents").select(
        F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), end).alias("name"),
        F.coalesce("text", F.lit("")).alias("content"),
    )
    decoys = documents.select(F.concat("name", F.lit(".part")).alias("name"), F.lit("").alias("content"))
    write_files(documents.union(decoys.where("name LIKE '%0.txt.part'")), path)
    files = read_files(listed_files(spark, path, "*.{txt,md}"))
    return files.select(
        path_label("path").alias("label"),
        F.element_at(F.split("path", "/"), -1).alias("file"),
        F.length("content").cast("long").alias("length"),
        F.md5("content").alias("digest"),
    )
