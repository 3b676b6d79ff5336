"""Feature vectors of the embeddings table, and the flagship query."""

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.paths import path_label
from tessera.operators.features import (
    content_features,
    image_features as features_of_images,
    linear_model,
    pooled_weights,
    vector_features as features_of_vectors,
)
from tessera.operators.pixels import FEATURE_WIDTH
from tessera.operators.weights import mapped_weights
from tessera.plans.registry import query, table
from tessera.sinks import write_parquet
from tessera.sinks.files import write_files
from tessera.sources import listed_images, read_parquet
from tessera.workspace import scratch_path

COMPONENTS = 4
VECTOR_WIDTH = 64


def small_weights() -> list[np.ndarray]:
    """A 4 x 64 matrix of small integers, so that results can be checked in SQL."""
    row, column = np.indices((COMPONENTS, VECTOR_WIDTH))
    return [(7 * column + 3 * row) % 11 - 5.0]


_COMPONENT_SQL = ", ".join(
    f"round(list_dot_product(embedding::double[], {row.tolist()}::double[]), 3) AS f{j}"
    for j, row in enumerate(small_weights()[0])
)


def _components(features: DataFrame) -> list:
    return [F.round(F.element_at("features", j + 1), 3).alias(f"f{j}") for j in range(COMPONENTS)]


@query(f"SELECT vec_id, label, {_COMPONENT_SQL} FROM embeddings")
def vector_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = features_of_vectors(
        table(spark, sf_dir, "embeddings"),
        "embedding",
        small_weights(),
        linear_model,
        element="double",
        keep=["vec_id", "label"],
    )
    return features.select("vec_id", "label", *_components(features))


@query(f"SELECT vec_id, label, {_COMPONENT_SQL} FROM embeddings")
def vector_features_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weights are a file that the workers of an executor map."""
    features = features_of_vectors(
        table(spark, sf_dir, "embeddings"),
        "embedding",
        mapped_weights(spark, small_weights()),
        linear_model,
        element="double",
        batch_bytes=64 * 1024,
        keep=["vec_id", "label"],
    )
    return features.select("vec_id", "label", *_components(features))


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, label, embedding`` with the label taken from a path of class and id."""
    vectors = table(spark, sf_dir, "embeddings").select(
        F.format_string("vectors/class %s/%s.vec", "label", "vec_id").alias("path"), "embedding"
    )
    return vectors.withColumn("label", path_label("path"))


@query(
    f"""
    SELECT 'vectors/class ' || label || '/' || vec_id || '.vec' AS path,
           'class ' || label AS label, {_COMPONENT_SQL}, {COMPONENTS} AS n_features
    FROM embeddings
    """
)
def feature_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "features")
    features = features_of_vectors(
        labelled_vectors(spark, sf_dir), "embedding", small_weights(), element="double"
    )
    write_parquet(features, path)
    stored = read_parquet(spark, path)
    return stored.select(
        "path", "label", *_components(stored), F.size("features").alias("n_features")
    )


@query(
    f"""
    SELECT cast(vec_id AS varchar) AS path, 'class ' || label AS label,
           {FEATURE_WIDTH} AS n_features, true AS in_range
    FROM embeddings
    """
)
def image_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector taken as an 8 x 8 grey image, through the image path to 1280 features."""
    side = 8
    shade = F.transform(
        "embedding",
        lambda x: F.lpad(F.hex(F.least(F.abs(F.round(x * 255)), F.lit(255)).cast("int")), 2, "0"),
    )
    images = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("path"),
        F.concat(F.lit("class "), "label").alias("label"),
        F.struct(
            F.lit(side).alias("height"),
            F.lit(side).alias("width"),
            F.lit(1).alias("nChannels"),
            F.unhex(F.array_join(shade, "")).alias("data"),
        ).alias("image"),
    )
    features = features_of_images(images, pooled_weights())
    return features.select(
        "path",
        "label",
        F.size("features").alias("n_features"),
        F.forall("features", lambda x: x.between(0, 6)).alias("in_range"),
    )


def decode_square(content: bytes) -> np.ndarray:
    """Grey squares: the side in one byte, then a byte for each pixel."""
    if not content or len(content) != 1 + content[0] ** 2:
        raise ValueError("not a grey square")
    side = content[0]
    grey = np.frombuffer(content, np.uint8, offset=1).reshape(side, side, 1)
    return np.repeat(grey, 3, axis=2)


def mean_model(weights: list[np.ndarray]):
    """The mean of all scaled pixels, times each weight."""
    return lambda batch: batch.mean(axis=(1, 2, 3))[:, None] * weights[0]


@query(
    """
    SELECT 'squares/class ' || label || '/' || vec_id || '.grey' AS path, 'class ' || label AS label,
           CASE WHEN vec_id % 17 <> 0 THEN round(2 * (shade / 127.5 - 1), 3) END AS f0,
           CASE WHEN vec_id % 17 <> 0 THEN round(-3 * (shade / 127.5 - 1), 3) END AS f1,
           CASE WHEN vec_id % 17 = 0 THEN 'not a grey square' END AS error
    FROM (SELECT *, cast(least(abs(round_even(embedding[1]::double * 255, 0)), 255) AS integer) AS shade
          FROM embeddings)
    """
)
def image_bytes_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoded images in a column, some of them cut short, dealt out before the model."""
    shade = F.least(F.abs(F.bround(F.element_at("embedding", 1).cast("double") * 255)), F.lit(255))
    pixels = F.repeat(F.lpad(F.hex(shade.cast("int")), 2, "0"), 64)
    whole = F.concat(F.lit("08"), pixels)
    images = (
        table(spark, sf_dir, "embeddings")
        .select(
            F.format_string("squares/class %s/%s.grey", "label", "vec_id").alias("path"),
            F.unhex(F.when(F.col("vec_id") % 17 == 0, F.substring(whole, 1, 40)).otherwise(whole)).alias(
                "content"
            ),
        )
        .withColumn("label", path_label("path"))
        .repartition(8, "path")
    )
    features = content_features(
        images, [np.array([2.0, -3.0])], mean_model, decode=decode_square, batch_rows=16
    )
    return features.select(
        "path",
        "label",
        F.round(F.get("features", F.lit(0)).cast("double"), 3).alias("f0"),
        F.round(F.get("features", F.lit(1)).cast("double"), 3).alias("f1"),
        "error",
    )


# Pixels of the resized image whose cubic weights are multiples of 1/1024, hence exact.
PROBED = (45, 101, 171)


def probe_model(weights: list[np.ndarray]):
    """The first channel at each pair of the given rows and columns, as 0..255."""
    at = weights[0]
    return lambda batch: np.rint((batch[:, at[:, None], at[None, :], 0] + 1) * 127.5)


@query(
    f"""
    WITH taps AS (
        SELECT x, c, CASE WHEN d < 1 THEN 1.5 * d ** 3 - 2.5 * d ** 2 + 1
                          WHEN d < 2 THEN -0.5 * d ** 3 + 2.5 * d ** 2 - 4 * d + 2
                          ELSE 0 END AS w
        FROM (SELECT x, c, abs((c + 0.5::double) - (x + 0.5::double) * 8 / 224) AS d
              FROM (SELECT unnest({list(PROBED)}) AS x), range(8) AS t(c))
    ), files AS (
        SELECT * FROM embeddings WHERE vec_id % 5 <> 0
    ), pixels AS (
        SELECT vec_id, i // 8 AS r, i % 8 AS c,
               least(abs(round_even(embedding[i + 1]::double * 255, 0)), 255) AS shade
        FROM files, range(64) AS t(i) WHERE vec_id % 17 <> 0
    ), across AS (
        SELECT vec_id, r, x, least(greatest(round_even(sum(w * shade), 0), 0), 255) AS shade
        FROM pixels JOIN taps USING (c) GROUP BY ALL
    ), whole AS (
        SELECT vec_id, t.x AS y, a.x, least(greatest(round_even(sum(w * shade), 0), 0), 255) AS shade
        FROM across AS a JOIN taps AS t ON a.r = t.c GROUP BY ALL
    ), probed AS (
        SELECT vec_id, string_agg(cast(cast(shade AS integer) AS varchar), ' ' ORDER BY y, x) AS probed
        FROM whole GROUP BY vec_id
    )
    SELECT vec_id, 'class ' || label AS label, probed,
           CASE WHEN vec_id % 17 = 0 THEN 'not a grey square' END AS error
    FROM files LEFT JOIN probed USING (vec_id)
    """
)
def image_file_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in folders of classes: listed by a glob, some cut short, 8 x 8 resized to 224 x 224."""
    shades = F.transform(
        "embedding",
        lambda x: F.lpad(
            F.hex(F.least(F.abs(F.bround(x.cast("double") * 255)), F.lit(255)).cast("int")), 2, "0"
        ),
    )
    pixels = F.concat(F.lit("08"), F.array_join(shades, ""))
    ending = F.when(F.col("vec_id") % 5 == 0, "raw").otherwise("grey")
    files = table(spark, sf_dir, "embeddings").select(
        F.format_string("class %s/%s.%s", "label", "vec_id", ending).alias("name"),
        F.unhex(F.when(F.col("vec_id") % 17 == 0, F.substring(pixels, 1, 40)).otherwise(pixels)).alias(
            "content"
        ),
    )
    root = scratch_path(spark, "image-files")
    write_files(files, root)
    features = content_features(
        listed_images(spark, root, "*.grey"),
        [np.array(PROBED)],
        probe_model,
        decode=decode_square,
        batch_bytes=1 << 20,
    )
    return features.select(
        F.regexp_extract("path", r"([0-9]+)\.grey$", 1).cast("bigint").alias("vec_id"),
        "label",
        F.array_join(F.transform("features", lambda x: x.cast("int").cast("string")), " ").alias("probed"),
        "error",
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path to label, batch inference with broadcast weights, check of every vector."""
    wide = [np.random.default_rng(42).normal(size=(FEATURE_WIDTH, VECTOR_WIDTH))]
    features = features_of_vectors(labelled_vectors(spark, sf_dir), "embedding", wide)
    return features.withColumn("n_features", F.size("features")).withColumn(
        "is_complete", F.col("n_features") == FEATURE_WIDTH
    )
