"""Command line: build the tables of a JSON configuration document.

    spark-submit ... -m clinicgen  (or python -m clinicgen) \\
        --config hdfs:///conf/job.json --as-of 2026-01-01 --base s3a://bucket/base [--tables red_sedes,age_citas]
"""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from clinicgen.config import Config, load_config
from clinicgen.plans.pipeline import ORDER, run
from clinicgen.plans.tables import EMPTY_POOL_POLICIES


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    p = argparse.ArgumentParser(prog="clinicgen", description="Build the tables of a configuration document.")
    p.add_argument("--config", required=True, help="JSON document, on any path that Spark reads")
    p.add_argument("--as-of", required=True, type=dt.date.fromisoformat, help="reference date, YYYY-MM-DD")
    p.add_argument("--base", required=True, help="output folder that all executors share")
    p.add_argument("--tables", default=",".join(ORDER), help="comma-separated subset")
    p.add_argument("--format", action="append", default=[], metavar="TABLE=FORMAT", help="parquet, avro or csv instead of the table's own")
    p.add_argument("--max-rejects", type=int, help="stop appointments after so many rejects (default: build all)")
    p.add_argument("--empty-pool", choices=EMPTY_POOL_POLICIES, default="raise", help="patients whom no physician can see first")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("clinicgen").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    cfg = Config(load_config(spark, a.config), a.as_of)
    formats = dict(f.split("=", 1) for f in a.format)
    paths = run(spark, cfg, a.base, formats, a.max_rejects, a.empty_pool, [t for t in a.tables.split(",") if t])
    for table, path in paths.items():
        print(f"{table}\t{path}")
    return paths


if __name__ == "__main__":
    main()
