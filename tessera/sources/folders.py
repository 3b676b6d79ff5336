"""Folders listed and read by tasks.

Spark's file sources list on the driver, which then holds the name of every file. Here each
level of the tree is a job whose tasks list the folders of that level; the driver learns
how many there are, and no name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.paths import path_label
from tessera.sources.files import _store, with_contents
from tessera.workspace import materialize_observed

# Folders that a task lists, files that it opens at least, and at most of files and bytes once
# every core has tasks, and entries of a batch.
FOLDERS_PER_TASK = 64
FILES_PER_TASK = 32
MOST_FILES, MOST_BYTES = 8192, 256 << 20
ENTRIES = 10_000

ENTRY = pa.schema(
    [
        ("path", pa.string()),
        ("name", pa.string()),
        ("length", pa.int64()),
        ("modificationTime", pa.timestamp("us", "UTC")),
        ("is_folder", pa.bool_()),
    ]
)


def glob_expression(pattern: str) -> str:
    """A file-name glob as a regular expression: ``* ? [abc] [^abc] {a,b} \\x``."""
    out, depth, at = "", 0, 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            at += 1
            out += re.escape(pattern[at])
        elif c in "*?":
            out += {"*": ".*", "?": "."}[c]
        elif c == "[" and (end := pattern.find("]", at + 2)) > 0:
            held = pattern[at + 1 : end].replace("\\", "\\\\")
            out += "[" + ("^" + held[1:] if held[0] in "!^" else held) + "]"
            at = end
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += re.escape(c)
        at += 1
    if depth:
        raise ValueError(f"unclosed {{ in {pattern!r}")
    return out


def listed_files(
    spark: SparkSession, root: str, pattern: str = "*", recursive: bool = True
) -> DataFrame:
    """``path, name, length, modificationTime`` of the files below ``root`` that match.

    ``name`` is relative to ``root``; ``pattern`` is held against its last part. As in Spark's own
    sources, files and folders that begin with ``_`` or ``.`` are left out. The listing is
    made at once, one job a level, and written to the shared folder.
    """
    if not re.match(r"[a-z][a-z0-9+.-]*:", root):
        root = "file:" + str(Path(root).absolute())
    matches = re.compile(glob_expression(pattern))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder, below in zip(batch.column("path").to_pylist(), batch.column("name").to_pylist()):
                store, inner = _store(folder)
                rows = []
                for found in store.get_file_info(fs.FileSelector(inner)):
                    own, is_folder = found.base_name, found.type == fs.FileType.Directory
                    if own[:1] in "_." or not (is_folder or matches.fullmatch(own)):
                        continue
                    place, name = f"{folder.rstrip('/')}/{own}", f"{below}/{own}".lstrip("/")
                    changed = None if found.mtime_ns is None else found.mtime_ns // 1000
                    rows.append((place, name, found.size or 0, changed, is_folder))
                for at in range(0, len(rows), ENTRIES):
                    columns = zip(*rows[at : at + ENTRIES])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(columns, ENTRY)], schema=ENTRY
                    )

    schema = "path string, name string, length long, modificationTime timestamp, is_folder boolean"
    open_ = spark.createDataFrame([(root.rstrip("/"), "")], "path string, name string")
    least, folders, levels = spark.sparkContext.defaultParallelism, 1, []
    while folders:
        tasks = min(folders, max(least, folders // FOLDERS_PER_TASK))
        entries, seen = materialize_observed(
            open_.repartition(tasks, "path").mapInArrow(look, schema),
            "listing",
            folders=F.count_if("is_folder"),
        )
        levels.append(entries.where("NOT is_folder").drop("is_folder"))
        open_ = entries.where("is_folder").select("path", "name")
        folders = seen["folders"] if recursive else 0
    return reduce(DataFrame.unionByName, levels)


def reading_tasks(count: int, size: int, cores: int, files_per_task: int = FILES_PER_TASK) -> int:
    """Tasks that open ``count`` files of ``size`` bytes in all.

    One for ``files_per_task`` files until each core has four; more only for as many files or
    bytes as make a task long, so that tasks and blocks of the shuffle to them stay few.
    """
    needed = max(4 * cores, -(-count // MOST_FILES), -(-size // MOST_BYTES))
    return max(1, min(count // files_per_task, needed))


def read_files(files: DataFrame, files_per_task: int = FILES_PER_TASK) -> DataFrame:
    """:func:`listed_files` with ``content``, opened by a number of tasks that follows the data."""
    count, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    return with_contents(files.repartition(reading_tasks(count, size, cores, files_per_task), "path"))


def listed_images(spark: SparkSession, root: str, pattern: str = "*.jpg") -> DataFrame:
    """Images as :func:`labelled_images` returns them, listed and read by tasks."""
    files = read_files(listed_files(spark, root, pattern))
    return files.select("path", "modificationTime", "length", "content", path_label("path").alias("label"))
