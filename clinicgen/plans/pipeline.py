"""Full build and write of the seven tables.

``build_all`` returns one DataFrame per table. Tables that feed several later
plans (patients, physicians, sites, encounters, and the ranked pools that visits pick from) are
written once as parquet in the shared checkpoint folder, so the later builders read files
instead of re-running the earlier plans, and a lost executor costs only its
own tasks. ``run`` builds, writes every table to ``{base}/{table}/data`` in
its format (parquet / avro / csv without header), publishes them as one unit (see ``publish``), and removes what it wrote on the way.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from clinicgen import __version__
from clinicgen import config as C
from clinicgen.plans import publish as P
from clinicgen.plans import tables as TB
from clinicgen.session import cut_lineage, require_fixed_offset_zone, scratch_run
from clinicgen.sources import sinks as SK
from clinicgen.validate import require_valid

ORDER = ("pac_registro", "med_planta", "red_sedes", "hce_encuentros", "gcm_camas", "far_dispensacion", "age_citas")


def build_all(spark: SparkSession, cfg: C.Config, materialize: bool = True, max_rejects: int | None = None,
              empty_pool: str = "raise", only: Collection[str] = ORDER, staging: P.Staging | None = None) -> dict[str, DataFrame]:
    """The tables named in ``only`` (all seven) for ``cfg`` (its seed and ``as_of``), keyed by table name.

    ``max_rejects`` = ``cfg.max_rejects`` reproduces the job's early stop of
    the appointment loop; the default None builds the full requested count. ``empty_pool``: see ``tables.check_pools``.
    With ``staging``, the tables of ``only`` are written there one by one, and those that it has already are not built again.
    """
    require_fixed_offset_zone(spark)
    cut = cut_lineage if materialize else (lambda df, name="": df)
    wants = lambda *names: bool(set(names) & set(only))
    out: dict[str, DataFrame] = {}

    def add(name: str, build: Callable[[], DataFrame], shared: bool = True) -> DataFrame:
        if staging is not None and name in only:
            out[name] = staging.table(name, build)
        else:
            out[name] = cut(build(), name) if shared else build()
        return out[name]

    visits = wants("hce_encuentros", "gcm_camas", "far_dispensacion", "age_citas")
    if visits or wants("pac_registro"):
        pac = add("pac_registro", lambda: TB.build_pac_registro(spark, cfg))
    if visits or wants("med_planta"):
        med = add("med_planta", lambda: TB.build_med_planta(spark, cfg))
    if wants("red_sedes", "gcm_camas"):
        sites = add("red_sedes", lambda: TB.build_red_sedes(spark, cfg))
    if visits:
        pools = cache(lambda: TB.rank_pools(cfg, pac, med, keep=materialize, empty_pool=empty_pool))
        enc = add("hce_encuentros", lambda: TB.build_hce_encuentros(spark, cfg, pac, med, empty_pool=empty_pool, pools=pools()))
        if wants("gcm_camas"):
            add("gcm_camas", lambda: TB.build_gcm_camas(spark, cfg, sites, enc), shared=False)
        if wants("far_dispensacion"):
            add("far_dispensacion", lambda: TB.build_far_dispensacion(spark, cfg, enc), shared=False)
        if wants("age_citas"):
            add("age_citas", lambda: TB.build_age_citas(spark, cfg, pac, med, enc, max_rejects=max_rejects, empty_pool=empty_pool, pools=pools()), shared=False)
    return {t: out[t] for t in ORDER if t in only}


def write_all(tables: dict[str, DataFrame], base: str, formats: dict[str, str] | None = None) -> dict[str, str]:
    """Write every table to ``{base}/{table}/data`` (2.2); returns table -> path."""
    return SK.write_all(tables, base, formats)


def run(spark: SparkSession, cfg: C.Config, base: str, formats: dict[str, str] | None = None, max_rejects: int | None = None,
        empty_pool: str = "raise", only: Collection[str] = ORDER, resume: bool = True) -> dict[str, str]:
    """Build and publish under ``base``, a folder that all executors share; returns table -> path.

    Configuration and formats are checked first. A run that ended early is taken up by the next one with the same settings, which builds only what is missing
    (``resume=False``: starts over). A build that is refused (ValueError) leaves nothing behind.
    Intermediate tables lie in a folder of this run, which is deleted at the end, also after an error.
    """
    if not base:
        raise ValueError("base is required: a folder that all executors share")
    require_valid(cfg.doc, cfg.as_of)
    unknown = set(only) - set(ORDER)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    chosen = {t: {**SK.TABLE_FORMATS, **(formats or {})}[t] for t in ORDER if t in only}
    SK.check_formats(spark, set(chosen.values()))
    P.recover(spark, base)
    settings = {"config": cfg.doc, "as_of": cfg.as_of.isoformat(), "max_rejects": max_rejects, "empty_pool": empty_pool, "version": __version__}
    staging = P.Staging(spark, base, settings, chosen)
    if not resume:
        staging.store.delete(staging.root)
    with scratch_run(spark):
        try:
            build_all(spark, cfg, max_rejects=max_rejects, empty_pool=empty_pool, only=only, staging=staging)
        except ValueError:
            staging.discard()
            raise
        return staging.publish()
