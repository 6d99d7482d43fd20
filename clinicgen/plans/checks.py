"""Invariants of the generated tables, as Spark queries.

Each check is a DataFrame of violating rows (an empty result means the rule
holds); ``check_all`` counts them. Every check is a scan, an aggregate or an
equi-join on a key, so it runs at full table size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicgen import config as C
from clinicgen.functions import draws as D
from clinicgen.functions import rules as R
from clinicgen.operators import temporal as T
from clinicgen.plans import tables as TB
from clinicgen.sources.dims import spec_lookups


def _ids_dense(df: DataFrame, id_col: str, n: int | None) -> DataFrame:
    """One row when ids are not exactly 1..count (or count != n)."""
    agg = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(id_col).alias("nd"), F.min(id_col).alias("lo"), F.max(id_col).alias("hi"))
    bad = (F.col("n") != F.col("nd")) | (F.col("lo") != 1) | (F.col("hi") != F.col("n"))
    if n is not None:
        bad = bad | (F.col("n") != F.lit(n))
    return agg.filter(bad | F.col("lo").isNull() & F.lit(n is not None and n > 0))


def checks(cfg: C.Config, t: dict[str, DataFrame], appointment_target_exact: bool = True) -> dict[str, DataFrame]:
    as_of, founding = F.expr(R.lit_date(cfg.as_of)), F.expr(R.lit_date(cfg.founding))
    pac, med, sedes, enc = t["pac_registro"], t["med_planta"], t["red_sedes"], t["hce_encuentros"]
    gcm, far, cit = t["gcm_camas"], t["far_dispensacion"], t["age_citas"]
    first_kind, control_kind = C.VISIT_KINDS
    out: dict[str, DataFrame] = {}

    # V0 keys are not null and exist: NULL passes every comparison below unseen
    keys = {"hce_encuentros": ("pac_id", "med_id", "id_sede"), "age_citas": ("pac_id", "med_id", "id_sede"),
            "med_planta": ("id_sede",), "far_dispensacion": ("id_encuentro", "pac_id", "id_sede"), "gcm_camas": ("id_sede",)}
    owner = {"pac_id": pac, "med_id": med, "id_sede": sedes, "id_encuentro": enc}
    for name, cols in keys.items():
        out[f"V0_keys_not_null_{name}"] = t[name].filter(" OR ".join(f"{c} IS NULL" for c in cols))
        for c in cols:
            out[f"V0_{c}_exists_{name}"] = t[name].filter(F.col(c).isNotNull()).join(owner[c].select(c), c, "left_anti")

    # V1 row counts and dense ids
    out["V1_pac_ids"] = _ids_dense(pac, "pac_id", cfg.length("pac_registro"))
    out["V1_med_ids"] = _ids_dense(med, "med_id", cfg.length("med_planta"))
    out["V1_sedes_ids"] = _ids_dense(sedes, "id_sede", cfg.length("red_sedes"))
    n_first = int(cfg.length("pac_registro") * C.FIRST_ADMISSION_SHARE)
    out["V1_enc_ids"] = _ids_dense(enc, "id_encuentro", max(n_first, cfg.length("hce_encuentros")))  # all first admissions are kept
    out["V1_far_ids"] = _ids_dense(far, "id_dispensacion", cfg.length("far_dispensacion"))
    out["V1_cit_ids"] = _ids_dense(cit, "id_cita", cfg.length("age_citas") if appointment_target_exact else None)
    hours = TB.grid_hours(cfg)
    out["V1_gcm_ids"] = _ids_dense(gcm, "id_registro_cama", hours * cfg.length("red_sedes") * len(cfg.units))

    # V2-V4 dates
    out["V2_birth"] = pac.filter((F.col("fec_nac") > as_of) | (F.col("fec_nac") < F.add_months(as_of, -12 * (int(cfg.pac["max_age"]) + 1))))
    out["V3_first_visit"] = pac.filter((F.col("fec_primer_atencion") < F.greatest("fec_nac", founding)) | (F.col("fec_primer_atencion") > as_of))
    # a physician's age is a draw of its id: in range, and of age on the hire date
    lo_age, hi_age = int(cfg.med["min_age_med"]), int(cfg.med["max_age_med"])
    aged = med.withColumn("_age", D.col(D.trunc_normal_int(cfg.seed, "med.age", "med_id", C.AGE_MEAN, C.AGE_SD, lo_age, hi_age)))
    out["V2_physician_age"] = aged.filter((F.col("_age") < lo_age) | (F.col("_age") > hi_age))
    out["V4_hire"] = aged.filter((F.col("fec_ingreso") < founding) | (F.col("fec_ingreso") > as_of)
                                 | (F.col("fec_ingreso") < F.expr(R.earliest_hire(R.lit_date(cfg.as_of), "_age", lo_age))))

    # V5 document type from the country's list; V6 insurer nulls
    p = cfg.pac
    allowed = F.when(F.col("id_ciudad_res") <= C.COUNTRY_BANDS[0][0], F.array(*[F.lit(x) for x in p["docs_col"]])) \
               .when(F.col("id_ciudad_res") <= C.COUNTRY_BANDS[1][0], F.array(*[F.lit(x) for x in p["docs_ecu"]])) \
               .otherwise(F.array(*[F.lit(x) for x in p["docs_peru"]]))
    young = F.months_between(as_of, F.col("fec_nac")) < F.lit(12 * C.MINOR_AGE - 12)
    out["V5_doc_type"] = pac.filter(~F.array_contains(allowed, F.col("tip_doc")) | (young & (F.col("tip_doc") != C.MINOR_DOC)))
    out["V6_insurer"] = pac.filter((F.col("id_eps").isNull() != F.col("tip_aseguradora").isNull()) | (F.col("eps").isNull() != F.col("id_eps").isNull()))

    # V7 sites: distinct cities, exact type counts, country band
    out["V7_cities"] = sedes.groupBy("id_ciudad").count().filter("count > 1")
    types = sedes.groupBy("tip_sede").agg(F.count(F.lit(1)).alias("n"))
    want = sedes.sparkSession.createDataFrame([(k, int(v)) for k, v in cfg.site_types if v > 0], "tip_sede string, want long")
    out["V7_types"] = types.join(want, "tip_sede", "full").filter(F.coalesce("n", F.lit(0)) != F.coalesce("want", F.lit(0)))
    out["V7_country"] = sedes.filter(F.col("id_pais") != F.expr(R.country_band("id_ciudad")))

    # V8 beds: every cell >= 1, total = budget
    caps = TB.CAP_COLS[: len(cfg.units)]
    out["V8_cells"] = sedes.filter(F.least(*[F.col(c) for c in caps]) < 1) if len(caps) > 1 else sedes.filter(F.col(caps[0]) < 1)
    total = sedes.agg(sum(F.sum(c) for c in caps).alias("total"))
    out["V8_total"] = total.filter(F.col("total") != cfg.bed_limit)

    # V9-V12 encounters
    e = enc.join(pac.select("pac_id", "fec_primer_atencion"), "pac_id", "left").join(med.select("med_id", "fec_ingreso"), "med_id", "left")
    first = e.filter(F.col("tip_consulta") == first_kind)
    out["V9_first"] = first.filter((F.to_date("fec_inicio_atencion") != F.col("fec_primer_atencion")) | (F.col("fec_ingreso") > F.col("fec_primer_atencion")))
    out["V9_first_count"] = first.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("pac_id").alias("nd")).filter(
        (F.col("n") != n_first) | (F.col("nd") != F.col("n")))
    ctrl = e.filter(F.col("tip_consulta") == control_kind)
    out["V10_control"] = ctrl.filter((F.to_date("fec_inicio_atencion") < F.date_add("fec_primer_atencion", cfg.max_stay_days + 1))
                                     | (F.col("fec_ingreso") > F.to_date("fec_inicio_atencion")) | (F.col("fec_ingreso") > F.col("fec_primer_atencion")))
    wait_s = F.timestamp_diff("SECOND", F.col("fec_registro"), F.col("fec_inicio_atencion"))
    stay_s = F.timestamp_diff("SECOND", F.col("fec_inicio_atencion"), F.col("fec_egreso"))
    out["V11_times"] = enc.filter((wait_s < 0) | (wait_s > int(cfg.wait[1] * 60)) | (stay_s < 0) | (stay_s > cfg.max_stay_days * 86400))
    look = {k: F.expr(v) for k, v in spec_lookups(cfg, "esp_atendida").items()}
    known = enc.filter(F.col("esp_atendida").isNotNull())
    out["V12_diag"] = known.filter((F.col("diag_sec1_cie10") == F.col("diag_principal_cie10"))
                                   | ~F.coalesce(F.array_contains(look["cie10"], F.col("diag_principal_cie10")), F.lit(False))
                                   | (F.col("diag_sec1_cie10").isNotNull() & ~F.coalesce(F.array_contains(look["cie10"], F.col("diag_sec1_cie10")), F.lit(False))))
    out["V12_price"] = known.filter(~F.col("cod_procedimientos").eqNullSafe(look["cod_procedimientos"]) | ~F.col("vr_facturado").eqNullSafe(look["vr_facturado"]))

    # V13 beds per hour
    cap = F.element_at(F.array(*[F.col(c) for c in caps]), F.array_position(F.array(*[F.lit(u) for u in cfg.units]), F.col("tip_unidad")).cast("int"))
    g = gcm.join(sedes.select("id_sede", *caps), "id_sede", "left")
    out["V13_cells"] = g.filter((F.col("num_camas_ocupadas") < 0) | (F.col("num_camas_ocupadas") > cap)
                                | (F.col("num_camas_disp") != cap - F.col("num_camas_ocupadas"))
                                | (F.col("num_camas_mant") < 0) | (F.col("num_camas_mant") > F.floor(F.col("num_camas_disp") * C.PCT_MAINTENANCE))
                                | ((F.col("num_camas_mant") > 0) != (F.col("motivo_indisponibilidad") == C.MAINTENANCE_REASON)))

    # per hour and site: every stay finds a bed until all are taken
    last = F.expr(TB.last_grid_hour(cfg))
    first_hour = F.expr(f"timestampadd(HOUR, {-(hours - 1)}, {TB.last_grid_hour(cfg)})")
    active = T.hourly_occupancy(enc.where("id_sede IS NOT NULL"), "id_sede", "fec_inicio_atencion", "fec_egreso", first_hour, last, out="n")
    per = g.groupBy("id_sede", F.col("fec_hora_registro").alias("hour")).agg(F.sum("num_camas_ocupadas").alias("taken"), F.sum(cap).alias("beds"))
    out["V13_sums"] = per.join(active, ["id_sede", "hour"], "left").filter(F.col("taken") != F.least("beds", F.coalesce("n", F.lit(0))))

    # V14 dispensing inside its stay, keys copied from the encounter
    fe = far.join(enc.select("id_encuentro", F.col("pac_id").alias("_p"), F.col("id_sede").alias("_s"), "fec_inicio_atencion", "fec_egreso"), "id_encuentro", "left")
    out["V14_dispensing"] = fe.filter(F.col("_p").isNull() | (F.col("pac_id") != F.col("_p")) | ~F.col("id_sede").eqNullSafe(F.col("_s"))
                                      | (F.col("fec_dispensacion") < F.col("fec_inicio_atencion")) | (F.col("fec_dispensacion") > F.col("fec_egreso"))
                                      | (F.col("cantidad") < 1) | (F.col("cantidad") > cfg.max_quantity))

    # V15 exactly one first visit per patient (encounter xor appointment)
    firsts = enc.filter(F.col("tip_consulta") == first_kind).select("pac_id").unionByName(
        cit.filter(F.col("tip_cita") == first_kind).select("pac_id"))
    per = pac.select("pac_id").join(firsts.groupBy("pac_id").agg(F.count(F.lit(1)).alias("n")), "pac_id", "left")
    out["V15_one_first"] = per.filter(F.coalesce("n", F.lit(0)) != 1)

    # V16 status and start time rule
    status = F.expr(R.visit_status("fec_cita_programada", "hra_inicio_atencion", R.lit_date(cfg.as_of)))
    out["V16_status"] = cit.filter((F.col("estado_cita") != status)
                                   | (F.col("hra_inicio_atencion") != F.greatest("hra_cita_programada", "hra_llegada_paciente"))
                                   | (F.col("fec_agendamiento") > F.col("fec_cita_programada")))
    return out


def check_all(cfg: C.Config, tables: dict[str, DataFrame], appointment_target_exact: bool = True) -> dict[str, int]:
    """Violation count per invariant (all zero when the tables are consistent)."""
    return {name: df.count() for name, df in checks(cfg, tables, appointment_target_exact).items()}
