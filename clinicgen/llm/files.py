"""Files that Python tasks write next to Spark's: any store that pyarrow reaches by its URI.

A task names its files with a fresh UUID and reports them as rows; only the rows of committed tasks
are kept (a manifest), so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import re
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs


_SAME = {"s3a": "s3", "s3n": "s3", "gcs": "gs"}  # Hadoop's names of stores that pyarrow knows under another


def uri(path: str) -> str:
    """The path as pyarrow spells it."""
    scheme, mark, rest = path.partition("://")
    if mark:
        return f"{_SAME.get(scheme, scheme)}://{rest}"
    return re.sub(r"^file:/+", "file:///", path)


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(uri(path))


def create(path: str) -> Any:
    fs, p = _place(path)
    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
    return fs.open_output_stream(p, compression=None)  # the name decides nothing


def open_random(path: str) -> Any:
    """Memory-mapped where the file is local, so that Arrow reads it without copies."""
    fs, p = _place(path)
    return pa.memory_map(p) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(p)


def open_stream(path: str) -> Any:
    fs, p = _place(path)
    return fs.open_input_stream(p, compression=None)
