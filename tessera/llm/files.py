"""Files in the shared folder, opened from tasks by its URI."""

from __future__ import annotations

import re
import uuid
from typing import Any


def filesystem(path: str) -> tuple[Any, str]:
    """The file system of a path or URI and the path in it."""
    from pyarrow import fs

    if re.match(r"[a-z][a-z0-9+.-]+:", path):
        return fs.FileSystem.from_uri(re.sub(r"^([a-z0-9+.-]+):/(?!/)", r"\1:///", path))
    return fs.LocalFileSystem(), path


def new_file(folder: str, suffix: str) -> str:
    """A name no other attempt of a task uses; folders are made as needed."""
    fs, path = filesystem(folder)
    fs.create_dir(path, recursive=True)
    return f"{folder}/{uuid.uuid4().hex}{suffix}"


def open_output(path: str) -> Any:
    fs, inner = filesystem(path)
    return fs.open_output_stream(inner, compression=None)


def open_input(path: str) -> Any:
    fs, inner = filesystem(path)
    return fs.open_input_file(inner)
