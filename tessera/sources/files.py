"""Sources whose unit is a file: images, listings and text.

Paths may be local or object-store URIs (``s3a://bucket/prefix``); the connector
is a matter of the cluster's configuration.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tessera.functions.paths import path_label

BATCH_BYTES = 1 << 20


def image_files(
    spark: SparkSession, path: str, pattern: str = "*.jpg", recursive: bool = True
) -> DataFrame:
    """Binary files below ``path`` whose name matches ``pattern``."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(path)
    )


def labelled_images(spark: SparkSession, path: str, pattern: str = "*.jpg") -> DataFrame:
    """:func:`image_files` plus ``label``, the name of the parent folder."""
    return image_files(spark, path, pattern).withColumn("label", path_label("path"))


def with_contents(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds ``content``, read by the task that holds the row; no other file is opened.

    Paths are opened through Arrow's file systems, so a store needs to be one of
    those (local, HDFS, S3, GCS) or an ``fsspec`` one.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size, first = [], 0, 0
            for row, name in enumerate(batch.column(path).to_pylist()):
                store, inner = _store(name)
                with store.open_input_stream(inner, compression=None) as file:
                    held.append(file.read())
                size += len(held[-1])
                # Small files share a batch, a large one ends it.
                if size >= BATCH_BYTES or row + 1 == batch.num_rows:
                    some = batch.slice(first, len(held))
                    yield pa.RecordBatch.from_arrays(
                        [*some.columns, pa.array(held, pa.binary())], names=[*some.schema.names, "content"]
                    )
                    held, size, first = [], 0, row + 1

    schema = StructType([*files.schema.fields, StructField("content", BinaryType())])
    return files.mapInArrow(read, schema)


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI as Spark writes it: percent signs and spaces stand for themselves."""
    scheme, found, rest = uri.partition(":")
    if not found or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    host, _, inner = rest.lstrip("/").partition("/")
    store, _ = fs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{host}")
    return store, f"{host}/{inner}" if scheme.startswith(("s3", "gs")) else f"/{inner}"


def list_files(
    spark: SparkSession, root: str, ext: str | None = None, recursive: bool = False
) -> DataFrame:
    """``path, name, length, modificationTime`` of files, contents never read.

    ``name`` is relative to ``root``. Only names with a dot match, as with ``*.ext``.
    """
    listing = image_files(spark, root, f"*.{ext or '*'}", recursive)
    prefix = F.regexp_replace(F.lit(root.rstrip("/")), r"^[a-z0-9]+:/*", "/")
    plain = F.regexp_replace("path", r"^[a-z0-9]+:/*", "/")
    return listing.select(
        "path",
        plain.substr(F.length(prefix) + 2, F.length("path")).alias("name"),
        "length",
        "modificationTime",
    )


def decode_images(
    spark: SparkSession, path: str, pattern: str = "*.jpg", drop_invalid: bool = False
) -> DataFrame:
    """``path, label, image`` with pixels decoded inside the JVM.

    A file that cannot be decoded keeps its row with ``image.height = -1`` unless
    ``drop_invalid`` is set. The image source percent-encodes its origin; it is
    decoded here so that labels equal folder names ('+' is literal in a path).
    """
    images = (
        spark.read.format("image")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .option("dropInvalid", str(drop_invalid).lower())
        .load(path)
    )
    origin = F.url_decode(F.replace(F.col("image.origin"), F.lit("+"), F.lit("%2B")))
    return images.select(origin.alias("path"), "image").select(
        "path", path_label("path").alias("label"), "image"
    )


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row ``value`` per line."""
    return spark.read.text(path)


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row ``path, value`` per file, contents whole."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), "value"
    )
