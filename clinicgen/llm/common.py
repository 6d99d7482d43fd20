"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicgen.session import cut_lineage, ensure_checkpoint_dir, scratch_path, unique_path

__all__ = ["ARROW_ROWS", "TOKEN", "cut", "prepare", "read", "release", "scratch_path", "unique_path", "write", "unit", "without", "spread_files"]

# a token: a run of anything but ASCII white space
TOKEN = r"[^\x20\x09-\x0D]+"

# rows of an Arrow batch handed to Python: texts may be long, so batches stay short
ARROW_ROWS = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Shared folder, package on the workers' path, short Arrow batches."""
    ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if not getattr(sc, "_clinicgen_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        path = os.path.join(tempfile.mkdtemp(prefix="clinicgen-py-"), "clinicgen_src.zip")
        with zipfile.ZipFile(path, "w") as z:
            for d, _, names in os.walk(os.path.join(root, "clinicgen")):
                for n in sorted(names):
                    if n.endswith(".py"):
                        full = os.path.join(d, n)
                        z.write(full, os.path.relpath(full, root))
        sc.addPyFile(path)
        sc._clinicgen_shipped = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lost executors cost no recomputation beyond it."""
    return cut_lineage(df, name)


def write(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``cut``, with the table's place, for one that is released later."""
    spark, path = df.sparkSession, unique_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.parquet(path), path


def release(spark: SparkSession, *paths: str) -> None:
    """Deletes written tables that nothing reads any more, and lets Spark clear the exchanges of plans that are gone.

    Spark keeps an exchange until the driver's garbage collection finds that no plan holds it; on a driver with little to collect that takes half an hour.
    """
    sc = spark.sparkContext
    for path in paths:
        hp = sc._jvm.org.apache.hadoop.fs.Path(path)
        hp.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hp, True)
    gc.collect()
    sc._jvm.System.gc()


def unit(*parts: Column | str) -> Column:
    """Uniform double in [0, 1) from the MD5 of the parts (52 bits; the same in any engine)."""
    text = F.concat_ws("|", *[(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("\u0000"))) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def without(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` but those that an output column of the same name replaces."""
    low = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in low]


def spread_files(manifest: DataFrame, col: str) -> DataFrame:
    """A manifest's rows over many tasks: they are tiny, the files they name are not, so the number is set, not left to row sizes."""
    spark = manifest.sparkSession
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return manifest.repartition(max(slots, manifest.count() // 8), F.col(col))
