"""A small configuration for builder tests: every rule is exercised in seconds."""

from __future__ import annotations

import datetime as dt

from clinicgen.config import Config
from clinicgen.harness.context import scale_counts


def small_config(as_of: dt.date = dt.date(2026, 1, 1), sites: int = 10, bed_limit: int = 120, hours: int = 48) -> Config:
    base = Config(as_of=as_of)
    cfg = base.with_lengths(pac_registro=2000, med_planta=1000, hce_encuentros=3000, gcm_camas=sites * 4 * hours,
                            far_dispensacion=3000, age_citas=2500)
    return cfg.with_sites(sites, scale_counts(base.site_types, sites), bed_limit)
