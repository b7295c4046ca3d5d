"""File handles inside tasks, for reading parts of files that Spark's readers take whole."""

from __future__ import annotations

import re
from typing import BinaryIO

from pyarrow import fs


def location(path: str) -> str:
    """A path as Spark or Hadoop writes it, as a URI that pyarrow opens: local files, HDFS, S3, GCS, Azure."""
    path = re.sub(r"^s3[an]:", "s3:", path)
    return re.sub(r"^file:/(?!/)", "file:///", path) if path.startswith("file:") else path


def _found(path: str) -> tuple[fs.FileSystem, str]:
    uri = location(path)
    if uri.startswith(("file://", "/")):  # without percent-decoding
        return fs.LocalFileSystem(), uri.removeprefix("file://")
    return fs.FileSystem.from_uri(uri)


def open_file(path: str) -> BinaryIO:
    """Opens a file for reading at any place; only what is read is fetched."""
    system, name = _found(path)
    return system.open_input_file(name)


def create_file(path: str) -> BinaryIO:
    system, name = _found(path)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    return system.open_output_stream(name, compression=None)


def size_of(path: str | None) -> int | None:
    """A file's bytes, or None where there is none."""
    if path is None:
        return None
    system, name = _found(path)
    info = system.get_file_info(name)
    return info.size if info.type == fs.FileType.File else None
