"""Expressions on paths, URIs and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the scheme that marks an object-store URI.
OBJECT_SCHEME = "s3://"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def path_segments(path: Column | str) -> Column:
    return F.split(_col(path), "/")


def path_label(path: Column | str) -> Column:
    """Name of the parent folder; null for a path of one segment."""
    return F.try_element_at(path_segments(path), F.lit(-2))


def normalize_path(path: Column | str) -> Column:
    """Backslashes become slashes."""
    return F.replace(_col(path), F.lit("\\"), F.lit("/"))


def flat_name(path: Column | str) -> Column:
    """A path as one file name: slashes and spaces become underscores."""
    return F.translate(_col(path), "/ ", "__")


def object_key(label: Column | str, name: Column | str, ext: str | None = None) -> Column:
    """``label/name`` or ``label/name.ext``."""
    if ext is None:
        return F.concat_ws("/", _col(label), _col(name))
    return F.format_string(f"%s/%s.{ext}", _col(label), _col(name).cast("string"))


def is_object_uri(uri: Column | str) -> Column:
    return F.startswith(_col(uri), F.lit(OBJECT_SCHEME))


def uri_bucket(uri: Column | str) -> Column:
    """What stands between the scheme and the first slash after it."""
    return F.regexp_extract(_col(uri), "^[a-z0-9]+://([^/]*)/?(.*)$", 1)


def uri_key(uri: Column | str) -> Column:
    """What follows the first slash after the scheme."""
    return F.regexp_extract(_col(uri), "^[a-z0-9]+://([^/]*)/?(.*)$", 2)


def byte_size(value: Column | str) -> Column:
    return F.octet_length(_col(value))
