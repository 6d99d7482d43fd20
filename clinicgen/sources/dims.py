"""Configuration maps as dimension tables.

Dimensions are built JVM-side from ``VALUES`` lists (a local relation: no
Python workers, no file), with explicit column types. Their size is fixed by
the configuration document (tens of rows) -- the proven bound that makes
``F.broadcast`` on them safe. Builders mostly use the equivalent constant
lookups (``element_at`` on a literal array or map), which need no join at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicgen import config as C
from clinicgen.functions.draws import lit_str, str_array
from clinicgen.functions.rules import country_band


def _check_keys(cfg: C.Config) -> None:
    for esp, _ in cfg.specialties:
        if esp not in cfg.doc["cie10"] or esp not in cfg.doc["procedimientos"]:
            raise ValueError(f"specialty {esp!r} lacks ICD-10 or procedure entries")
        if cfg.doc["procedimientos"][esp] not in cfg.doc["vrs"]:
            raise ValueError(f"procedure of {esp!r} has no price")


def values(spark: SparkSession, rows: list[list[str]], cols: list[str]) -> DataFrame:
    """A local relation from rows of SQL literal snippets."""
    body = ", ".join("(" + ", ".join(r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(cols)})")


def dims(spark: SparkSession, cfg: C.Config) -> dict[str, DataFrame]:
    """city, insurer, specialty: the dimensions that are joined; the others are constants of the plans."""
    _check_keys(cfg)
    city = values(spark, [[f"CAST({i} AS BIGINT)", lit_str(n)] for i, n in enumerate(cfg.cities, 1)], ["id_ciudad", "ciudad"])
    city = city.selectExpr("*", f"{country_band('id_ciudad')} AS id_pais")
    insurer = values(spark, [[f"CAST({i} AS BIGINT)", lit_str(n)] for i, n in enumerate(cfg.insurers, 1)], ["id_eps", "eps"])
    spec = values(spark, [
        [f"CAST({i} AS BIGINT)", lit_str(esp), str_array(subs), str_array(cfg.doc["cie10"][esp]),
         lit_str(cfg.doc["procedimientos"][esp]), f"CAST({int(cfg.doc['vrs'][cfg.doc['procedimientos'][esp]])} AS BIGINT)"]
        for i, (esp, subs) in enumerate(cfg.specialties, 1)],
        ["n_esp", "especialidad", "subespecialidades", "cie10", "cod_procedimientos", "vr_facturado"])
    return {"city": city, "insurer": insurer, "specialty": spec}


DIM_ROWS = 100_000  # a configuration document's maps are far smaller; anything larger is joined without a hint


def lookup(df: DataFrame, dim: DataFrame, on: str | list[str], how: str = "left") -> DataFrame:
    """Map lookup against a dimension (2.5.10): broadcast once its rows are counted to be few."""
    few = dim.limit(DIM_ROWS + 1).count() <= DIM_ROWS
    return df.join(F.broadcast(dim) if few else dim, on=on, how=how)


# ---- constant lookups (no join): dense int keys -> literal array, text keys -> literal map
def by_index(values_: list[str | None], idx: str) -> str:
    """``values_[idx]`` for a 1-based dense key; NULL key gives NULL.

    The explicit NULL branch matters: Spark 4.1.2's generated code for
    ``element_at`` on a literal array can return the last element for a NULL
    index coming from a CASE without ELSE.
    """
    return f"CASE WHEN {idx} IS NULL THEN NULL ELSE element_at({str_array(values_)}, CAST({idx} AS INT)) END"


def by_key(mapping: dict[str, str], key: str) -> str:
    """``mapping[key]`` for text keys (NULL when absent)."""
    pairs = ", ".join(f"{lit_str(k)}, {v}" for k, v in mapping.items())
    return f"CASE WHEN {key} IS NULL THEN NULL ELSE element_at(map({pairs}), {key}) END"


def spec_lookups(cfg: C.Config, name: str) -> dict[str, str]:
    """Specialty name -> ICD-10 list, procedure code and price, as SQL."""
    esp = [e for e, _ in cfg.specialties]
    proc = {e: lit_str(cfg.doc["procedimientos"][e]) for e in esp}
    price = {e: f"CAST({int(cfg.doc['vrs'][cfg.doc['procedimientos'][e]])} AS BIGINT)" for e in esp}
    icd = {e: str_array(cfg.doc["cie10"][e]) for e in esp}
    return {"cie10": by_key(icd, name), "cod_procedimientos": by_key(proc, name), "vr_facturado": by_key(price, name)}
