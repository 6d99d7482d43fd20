"""Table sinks: parquet, avro, csv (no header), overwrite.

Formats follow the job's choice per table size (csv few rows, avro medium,
parquet large). Avro needs the external ``spark-avro`` module; when it is not
on the classpath writing avro fails loudly -- there is no silent fallback to
another format. Callers may pass an explicit ``formats`` override.

Files are sized by the data, not by the number of tasks that made it: before a write Spark merges and splits partitions by
their measured size (an adaptive rebalance), so that a file holds the rows of about ``FILE_BYTES`` of shuffled data. A parquet file then has a quarter
of that to twice as much, and a table below it is one file.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# fixed per-table formats of the job
TABLE_FORMATS = {
    "pac_registro": "parquet",
    "med_planta": "avro",
    "red_sedes": "csv",
    "hce_encuentros": "parquet",
    "gcm_camas": "avro",
    "far_dispensacion": "avro",
    "age_citas": "parquet",
}


FILE_BYTES = 256 << 20


class AvroUnavailable(RuntimeError):
    pass


def avro_available(spark: SparkSession) -> bool:
    """True when the ``avro`` data source resolves (the same lookup a write does)."""
    try:
        jvm = spark.sparkContext._jvm
        jvm.org.apache.spark.sql.execution.datasources.DataSource.lookupDataSource(
            "avro", spark._jsparkSession.sessionState().conf())
        return True
    except Exception:
        return False


def table_path(base: str, table: str) -> str:
    """``{base}/{table}/data`` (2.2.5)."""
    return f"{base.rstrip('/')}/{table}/data"


def check_formats(spark: SparkSession, formats: set[str]) -> None:
    """Refuse what cannot be written, before anything is overwritten."""
    unknown = formats - {"parquet", "avro", "csv"}
    if unknown:
        raise ValueError(f"unknown table formats: {sorted(unknown)}")
    if "avro" in formats and not avro_available(spark):
        raise AvroUnavailable("avro sink needs the spark-avro module on the classpath (--packages org.apache.spark:spark-avro_2.13)")


@contextmanager
def _sized_files(spark: SparkSession, file_bytes: int) -> Iterator[None]:
    """Partitions are merged and split toward ``file_bytes``, also where that leaves slots without work."""
    wanted = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(file_bytes), "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_table(df: DataFrame, path: str, fmt: str, file_bytes: int = FILE_BYTES) -> None:
    """Overwrite ``path`` with ``df`` in ``fmt`` (parquet | avro | csv), in files of about ``file_bytes`` of shuffled data."""
    check_formats(df.sparkSession, {fmt})
    with _sized_files(df.sparkSession, file_bytes):
        w = df.hint("rebalance").write.mode("overwrite")
        if fmt == "csv":
            w.option("header", "false").csv(path)
        else:
            w.format(fmt).save(path)


def read_table(spark: SparkSession, path: str, fmt: str, schema: T.StructType) -> DataFrame:
    """Read a written table back with its explicit schema.

    csv keeps NULL (unquoted empty field) apart from the empty string (written
    as a quoted ``""``): the NULL marker is set to a character that never
    occurs, so only truly empty fields read as NULL.
    """
    if fmt == "csv":
        return spark.read.schema(schema).option("header", "false").option("nullValue", "\u0000").csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def write_all(tables: dict[str, DataFrame], base: str, formats: dict[str, str] | None = None) -> dict[str, str]:
    """Write every table to ``{base}/{table}/data``; returns table -> path."""
    fm = dict(TABLE_FORMATS)
    fm.update(formats or {})
    out = {}
    for df in list(tables.values())[:1]:
        check_formats(df.sparkSession, {fm[name] for name in tables})
    for name, df in tables.items():
        path = table_path(base, name)
        write_table(df, path, fm[name])
        out[name] = path
    return out
