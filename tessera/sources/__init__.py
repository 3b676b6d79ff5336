from tessera.sources.files import (
    decode_images,
    image_files,
    labelled_images,
    list_files,
    read_text_files,
    read_text_lines,
    with_contents,
)
from tessera.sources.folders import listed_files, listed_images, read_files
from tessera.sources.tables import (
    read_csv,
    read_json,
    read_parquet,
    rename_dotted,
)

__all__ = [
    "decode_images",
    "image_files",
    "labelled_images",
    "list_files",
    "listed_files",
    "listed_images",
    "read_csv",
    "read_files",
    "read_json",
    "read_parquet",
    "read_text_files",
    "read_text_lines",
    "rename_dotted",
    "with_contents",
]
