"""Publishing a build as one unit.

The tables of a build refer to each other, so a crash between two overwrites must not leave tables of two builds side by side.

* A table is written to ``{base}/.staging/{build}/{table}/data`` and recorded beside it once it is
  complete (rows, format, schema). ``build`` is a hash of all that decides the rows, so running the same build again
  after a crash skips the tables that are recorded, and reads those that others depend on.
* When all tables are there, ``publish`` swaps them into ``{base}/{table}/data``. While it does, ``{base}/_publishing.json`` names the
  build; the last steps are ``{base}/_manifest.json`` (replaced in one step) and the removal of that marker. A swap that was interrupted is
  completed by the next run under ``base`` (or ``recover``), whatever it builds: all its tables are complete.
* ``read_build`` reads tables through the manifest. It refuses while a swap is under way, and looks again after the files are listed, so that all
  its tables belong to one build; a table that is not part of the published build is refused too.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Collection
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinicgen.session import cut_lineage
from clinicgen.sources import sinks as SK
from clinicgen.sources.store import Store


class Unpublished(RuntimeError):
    """There is no complete build to read."""


def build_id(settings: dict[str, Any]) -> str:
    return hashlib.sha256(json.dumps(settings, sort_keys=True, default=str).encode()).hexdigest()[:16]


def _marker(base: str) -> str:
    return f"{base}/_publishing.json"


def _manifest(base: str) -> str:
    return f"{base}/_manifest.json"


class Staging:
    """The tables of one build on their way to ``base``."""

    def __init__(self, spark: SparkSession, base: str, settings: dict[str, Any], formats: dict[str, str]) -> None:
        self.spark, self.base, self.settings, self.formats = spark, base.rstrip("/"), settings, formats
        self.build = build_id({**settings, "formats": formats})
        self.store = Store(spark, self.base)
        self.root = f"{self.base}/.staging/{self.build}"

    def _record(self, table: str) -> str:
        return f"{self.root}/{table}.json"

    def finished(self) -> list[str]:
        return [t for t in self.formats if self.store.exists(self._record(t))]

    def table(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The staged table, for the tables that build on it; built and written unless an earlier run did."""
        path, fmt = SK.table_path(self.root, name), self.formats[name]
        if self.store.exists(self._record(name)):
            schema = T.StructType.fromJson(self.store.read_json(self._record(name))["schema"])
            return SK.read_table(self.spark, path, fmt, schema)
        df = build()
        if fmt != "parquet":  # others read a columnar copy
            df = cut_lineage(df, name)
        seen = Observation(f"rows of {name}")
        SK.write_table(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, fmt)
        self.store.write_json(self._record(name), {"rows": seen.get["rows"], "format": fmt, "schema": df.schema.jsonValue()})
        return df if fmt != "parquet" else SK.read_table(self.spark, path, fmt, df.schema)

    def publish(self) -> dict[str, str]:
        """Swaps all tables in; returns table -> path."""
        missing = [t for t in self.formats if t not in self.finished()]
        if missing:
            raise Unpublished(f"not built yet: {missing}")
        records = {t: self.store.read_json(self._record(t)) for t in self.formats}
        self.store.write_json(f"{self.root}/manifest.json", {"build": self.build, "settings": self.settings, "tables": records})
        self.store.write_json(_marker(self.base), {"build": self.build})
        _swap(self.store, self.base, self.build)
        return {t: SK.table_path(self.base, t) for t in self.formats}

    def discard(self) -> None:
        """Removes what was staged, and folders that only this build made."""
        self.store.delete(self.root)
        self.store.delete_if_empty(f"{self.base}/.staging")
        self.store.delete_if_empty(self.base)


def _swap(store: Store, base: str, build: str) -> None:
    """Every step may have been done by an interrupted run before; a staged folder that is gone has been swapped in."""
    root = f"{base}/.staging/{build}"
    if store.exists(f"{root}/manifest.json"):
        manifest = store.read_json(f"{root}/manifest.json")
        for table in manifest["tables"]:
            staged, final = SK.table_path(root, table), SK.table_path(base, table)
            if store.exists(staged):
                if store.exists(final):
                    store.move(final, f"{root}/replaced/{table}")
                store.move(staged, final)
        store.write_json(_manifest(base), manifest)
    store.delete(_marker(base))
    store.delete(root)
    store.delete_if_empty(f"{base}/.staging")


def recover(spark: SparkSession, base: str) -> str | None:
    """Completes an interrupted swap under ``base``; returns its build."""
    base = base.rstrip("/")
    store = Store(spark, base)
    if not store.exists(_marker(base)):
        return None
    build = store.read_json(_marker(base))["build"]
    _swap(store, base, build)
    return build


def manifest(spark: SparkSession, base: str) -> dict[str, Any]:
    """Build, settings and tables (rows, format, schema) of what is published under ``base``."""
    base = base.rstrip("/")
    store = Store(spark, base)
    if store.exists(_marker(base)):
        raise Unpublished(f"a build is being published under {base}; if no run is under way, recover() completes it")
    if not store.exists(_manifest(base)):
        raise Unpublished(f"no build is published under {base}")
    return store.read_json(_manifest(base))


def read_build(spark: SparkSession, base: str, tables: Collection[str] | None = None) -> dict[str, DataFrame]:
    """Tables of the published build (all of them), which all belong to it."""
    base = base.rstrip("/")
    listed = manifest(spark, base)
    wanted = list(tables) if tables is not None else list(listed["tables"])
    strange = [t for t in wanted if t not in listed["tables"]]
    if strange:
        raise Unpublished(f"not part of build {listed['build']} under {base}: {strange}")
    out = {}
    for t in wanted:
        record = listed["tables"][t]
        out[t] = SK.read_table(spark, SK.table_path(base, t), record["format"], T.StructType.fromJson(record["schema"]))
    if manifest(spark, base)["build"] != listed["build"]:
        raise Unpublished(f"another build was published under {base} meanwhile; read again")
    return out
