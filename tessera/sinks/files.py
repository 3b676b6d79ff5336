"""Rows as files under their own names."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.files import _store
from tessera.workspace import materialize

# Folders that a task remembers to have made.
FOLDERS = 10_000


def write_files(rows: DataFrame, root: str, name: str = "name", content: str = "content") -> DataFrame:
    """Each row's ``content`` at ``root/<name>``; returns ``name, path, length`` of what was written.

    An attempt writes under a name of its own, which listings skip, and gives the file its name
    when it is whole: a lost or repeated attempt leaves neither a part of a file nor two.
    A name must be relative and must not lead out of ``root``; it should be there once.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = set()
        for batch in batches:
            done = []
            for own, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if own is None or own.startswith("/") or not own or ".." in own.split("/"):
                    raise ValueError(f"not a name below the root: {own!r}")
                path = f"{root.rstrip('/')}/{own}"
                store, inner = _store(path)
                folder, _, last = inner.rpartition("/")
                if folder not in made:
                    store.create_dir(folder, recursive=True)
                    if len(made) < FOLDERS:
                        made.add(folder)
                attempt = f"{folder}/.{last}.{uuid.uuid4().hex}"
                try:
                    with store.open_output_stream(attempt, compression=None) as out:
                        out.write(data or b"")
                    store.move(attempt, inner)
                except BaseException:
                    if store.get_file_info(attempt).is_file:
                        store.delete_file(attempt)
                    raise
                done.append((own, path, len(data or b"")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done)] or [pa.array([], t) for t in (pa.string(), pa.string(), pa.int64())],
                names=["name", "path", "length"],
            )

    held = rows.select(F.col(f"`{name}`").alias("name"), F.col(f"`{content}`").cast("binary").alias("content"))
    return materialize(held.mapInArrow(write, "name string, path string, length long"), "written-files")
