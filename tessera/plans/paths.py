"""Strings that are paths, URIs or keys, and regular expressions."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import paths
from tessera.plans.registry import query, table


@query(
    """
    SELECT page_id, len(string_split(url, '/')) AS n_segments,
           string_split(url, '/')[3] AS host, string_split(url, '/')[-1] AS last_segment
    FROM pages
    """
)
def url_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = paths.path_segments("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.size(segments).cast("bigint").alias("n_segments"),
        F.try_element_at(segments, F.lit(3)).alias("host"),
        F.try_element_at(segments, F.lit(-1)).alias("last_segment"),
    )


@query("SELECT page_id, string_split(url, '/')[-2] AS label FROM pages")
def label_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", paths.path_label("url").alias("label"))


@query(
    r"""
    SELECT page_id, replace(replace(url, '/', '\'), '\', '/') AS path,
           replace(replace(concat(url, ' copy'), '/', '_'), ' ', '_') AS file_name
    FROM pages
    """
)
def path_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    backslashed = F.replace(F.col("url"), F.lit("/"), F.lit("\\"))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        paths.normalize_path(backslashed).alias("path"),
        paths.flat_name(F.concat("url", F.lit(" copy"))).alias("file_name"),
    )


@query(
    """
    SELECT doc_id, source || '/' || lang AS folder_key,
           source || '/' || doc_id || '.txt' AS file_key
    FROM documents
    """
)
def object_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        paths.object_key("source", "lang").alias("folder_key"),
        paths.object_key("source", "doc_id", "txt").alias("file_key"),
    )


@query(
    """
    WITH uris AS (
        SELECT page_id, regexp_replace(url, '^https://', 's3://') AS uri FROM pages
    ), rest AS (
        SELECT page_id, uri, starts_with(uri, 's3://') AS is_object,
               substr(uri, strpos(uri, '://') + 3) AS tail
        FROM uris
    )
    SELECT page_id, is_object,
           CASE WHEN strpos(tail, '/') > 0 THEN substr(tail, 1, strpos(tail, '/') - 1)
                ELSE tail END AS bucket,
           CASE WHEN strpos(tail, '/') > 0 THEN substr(tail, strpos(tail, '/') + 1)
                ELSE '' END AS key
    FROM rest
    """
)
def uri_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secure addresses are given the object-store scheme, so both cases occur."""
    uri = F.regexp_replace("url", "^https://", paths.OBJECT_SCHEME)
    return (
        table(spark, sf_dir, "pages")
        .select("page_id", uri.alias("uri"))
        .select(
            "page_id",
            paths.is_object_uri("uri").alias("is_object"),
            paths.uri_bucket("uri").alias("bucket"),
            paths.uri_key("uri").alias("key"),
        )
    )


@query("SELECT doc_id, strlen(text) AS n_bytes FROM documents")
def payload_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", paths.byte_size("text").cast("bigint").alias("n_bytes")
    )


@query("SELECT doc_id, regexp_replace(text, '[0-9]+', '#', 'g') AS masked FROM documents")
def regexp_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.regexp_replace("text", "[0-9]+", "#").alias("masked")
    )


@query(
    """
    SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
           regexp_extract(url, '[?&]page=([0-9]+)', 1) AS page_number
    FROM pages
    """
)
def regexp_extract_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"),
        F.regexp_extract("url", "[?&]page=([0-9]+)", 1).alias("page_number"),
    )


@query(
    """
    SELECT doc_id, len(string_split_regex(text, '[.!?]+')) AS n_pieces,
           string_split_regex(text, '[.!?]+')[1] AS first_piece
    FROM documents
    """
)
def regexp_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = F.split("text", "[.!?]+")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.size(pieces).cast("bigint").alias("n_pieces"),
        F.element_at(pieces, 1).alias("first_piece"),
    )
