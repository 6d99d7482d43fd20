"""Spark session and lineage helpers.

The library never reads the wall clock and never writes to a machine-local
folder on a cluster: lineage is cut by tables written into the folder the
cluster names in ``spark.checkpoint.dir``. Only a local-mode session (tests,
bench) without that setting gets a scratch folder under ``/tmp``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "clinicgen") -> SparkSession:
    """A local-mode session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting a scratch one only in local mode.

    On a cluster the folder must come from ``spark.checkpoint.dir`` (a shared
    file system); a missing setting there is an error, not a silent fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.fullmatch(r"local(\[.*\])?", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (e.g. HDFS / object store)")
    scratch = tempfile.mkdtemp(prefix="clinicgen-ckpt-", dir=os.environ.get("CLINICGEN_SCRATCH", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


# tables written by a run lie in that run's own folder; outside a run, in the session's
_RUN: ContextVar[str] = ContextVar("clinicgen_run", default="session")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the current run's folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{_RUN.get()}/{name}"


def unique_path(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame, name: str = "cut") -> DataFrame:
    """Materialise ``df`` as parquet in the shared checkpoint folder and read it back.

    One job writes the rows once (an eager ``checkpoint()`` computes its input
    twice: once to count, once to save); the files survive executor loss and
    the returned plan is a plain columnar scan with pruning and pushdown.
    """
    path = unique_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """A run whose tables lie in a folder of its own, deleted at the end, also after an error."""
    token = _RUN.set(f"run-{uuid.uuid4().hex}")
    path = scratch_path(spark, "").rstrip("/")
    try:
        yield path
    finally:
        _RUN.reset(token)
        _delete(spark, path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the session's own tables (those of registered queries), once nothing reads them."""
    _delete(spark, scratch_path(spark, "").rstrip("/"))


def _delete(spark: SparkSession, path: str) -> None:
    hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)


def allow_group_limit(spark: SparkSession, rows: int) -> None:
    """Lets a rank filter of up to ``rows`` rows a group act within each task before the exchange (Spark's own bound on it is
    raised where it is lower; it decides on nothing else)."""
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    if rows > int(spark.conf.get(name, "1000")):
        spark.conf.set(name, str(rows))


def parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (local[8] -> 8)."""
    return max(1, spark.sparkContext.defaultParallelism)


def range_parts(spark: SparkSession, n: int, rows_per_part: int = 1_000_000) -> int:
    """Partitions for a ``spark.range`` spine of ``n`` rows that feeds heavy
    per-row expressions: at least one per task slot, at most ``rows_per_part`` rows each."""
    return max(1, min(max(n, 1), max(parallelism(spark), -(-n // rows_per_part))))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-repartition by a unique key, one partition per task slot: for a caller that knows its
    input to be narrow (an id file in one split, few stays about to become many hours)."""
    return df.repartition(parallelism(df.sparkSession), *keys)


def require_fixed_offset_zone(spark: SparkSession) -> str:
    """The session time zone, refused when its UTC offset changes during the year.

    Wall-clock (``timestamp_ntz``) arithmetic such as ``timestampdiff`` and
    ``date_trunc`` goes through the session zone; across a daylight-saving
    change an hour would be gained or lost and the generated times would
    depend on where the job runs. Set ``spark.sql.session.timeZone=UTC``.
    """
    import datetime as dt
    from zoneinfo import ZoneInfo

    name = spark.conf.get("spark.sql.session.timeZone")
    try:
        zone = ZoneInfo(name)
    except Exception:  # offsets such as "+05:00" are fixed by construction
        return name
    offsets = {dt.datetime(2021, m, 1, tzinfo=zone).utcoffset() for m in range(1, 13)}
    if len(offsets) > 1:
        raise ValueError(f"session time zone {name!r} changes its UTC offset during the year; "
                         "set spark.sql.session.timeZone=UTC for reproducible wall-clock times")
    return name
