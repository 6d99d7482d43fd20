"""Harness stand-ins: the given tables play the generator's entities.

customer -> patients (pac_id = c_custkey + 1), part -> physicians
(med_id = p_partkey + 1), nation -> sites, orders -> encounters / attempts,
lineitem -> dispensing lines, events -> stays and appointments
(site = user_id, start = ts, end = ts + int(value % 5) h + (event_id % 60) min).
Lengths come from the tables a query uses, counted anew each time. ``orders`` (encounters) and
``events`` (appointments, bed rows) give target counts to builders whose feature is
to draw up to a target; patients, physicians, sites and dispensing lines are one per row.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicgen.config import Config
from clinicgen.session import spread

AS_OF = dt.date(2026, 1, 1)
# appointments rules are exercised with a reference date inside the events' month
EVENTS_AS_OF = dt.date(2024, 1, 15)

def scale_counts(counts: list[tuple[str, int]], n: int) -> dict[str, int]:
    """Scale integer counts to sum to ``n`` (largest remainder, ties in list order)."""
    total = sum(c for _, c in counts)
    raw = [(k, c * n / total) for k, c in counts]
    out = {k: int(math.floor(x)) for k, x in raw}
    short = n - sum(out.values())
    order = sorted(range(len(raw)), key=lambda i: (-(raw[i][1] - math.floor(raw[i][1])), i))
    for i in order[:short]:
        out[raw[i][0]] += 1
    return out


# table of the generator -> harness table whose rows it has
LENGTHS = {"pac_registro": "customer", "med_planta": "part", "hce_encuentros": "orders",
           "gcm_camas": "events", "far_dispensacion": "lineitem", "age_citas": "events"}


@dataclass
class Harness:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    def count(self, name: str) -> int:
        return self.table(name).count()

    def config(self, *tables: str) -> Config:
        """The configuration with the lengths of ``tables`` (and, for ``red_sedes``, the sites) taken from the harness tables."""
        cfg = Config(as_of=AS_OF)
        sizes = {name: self.count(name) for name in {LENGTHS[t] for t in tables if t in LENGTHS}}
        cfg = cfg.with_lengths(**{t: sizes[LENGTHS[t]] for t in tables if t in LENGTHS})
        if "red_sedes" in tables:
            n = self.count("nation")
            cfg = cfg.with_sites(n, scale_counts(cfg.site_types, n), int(cfg.bed_limit * n / cfg.length("red_sedes")))
        return cfg

    # -- stand-in spines ---------------------------------------------------
    def patient_ids(self) -> DataFrame:
        return spread(self.table("customer").select((F.col("c_custkey") + 1).alias("pac_id")), "pac_id")

    def physician_ids(self) -> DataFrame:
        return spread(self.table("part").select((F.col("p_partkey") + 1).alias("med_id")), "med_id")

    def site_ids(self) -> DataFrame:
        return self.table("nation").select((F.col("n_nationkey") + 1).alias("id_sede"))

    def dispensing_ids(self) -> DataFrame:
        ids = self.table("lineitem").select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id_dispensacion"))
        return spread(ids, "id_dispensacion")

    def stays(self) -> DataFrame:
        """events as hospital stays."""
        ev = self.table("events")
        end = F.timestamp_add("MINUTE", F.col("event_id") % 60,
                              F.timestamp_add("HOUR", (F.floor(F.col("value")) % 5).cast("bigint"), F.col("ts")))
        return ev.select("event_id", F.col("user_id").alias("site"), F.col("ts").alias("start"), end.alias("end"))


def events_grid_bounds(stays: DataFrame) -> tuple[Column, Column]:
    """Whole-hour grid covering all stays (derived from the data)."""
    b = stays.agg(F.min("start").alias("lo"), F.max("end").alias("hi")).collect()[0]
    lo = F.lit(b["lo"].isoformat(sep=" ")).cast("timestamp_ntz")
    hi = F.lit(b["hi"].isoformat(sep=" ")).cast("timestamp_ntz")
    return F.date_trunc("hour", lo).cast("timestamp_ntz"), F.date_trunc("hour", hi).cast("timestamp_ntz")
