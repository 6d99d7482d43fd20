"""Small files, renames and deletions on any Hadoop file system."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import SparkSession


class Store:
    """The file system that holds ``root``; paths are full paths on it."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str) -> Any:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names in a folder; none if it doesn't exist."""
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path))) if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def delete_if_empty(self, path: str) -> None:
        if self.exists(path) and not self.names(path):
            self.delete(path)

    def move(self, src: str, dst: str) -> None:
        """Renames a file or folder; ``dst`` must not exist, its parent is made."""
        target = self._path(dst)
        if self._fs.exists(target):
            raise FileExistsError(dst)
        self._fs.mkdirs(target.getParent())
        if not self._fs.rename(self._path(src), target):
            raise OSError(f"cannot rename {src} to {dst}")

    def read_json(self, path: str) -> Any:
        stream = self._fs.open(self._path(path))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_json(self, path: str, value: Any) -> None:
        """Replaces the file in one step: readers see the old text or the new one."""
        draft = self._path(f"{path}.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(value, ensure_ascii=False, indent=1).encode()))
        finally:
            stream.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf).rename(draft, self._path(path), how)
