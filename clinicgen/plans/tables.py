"""The seven table builders, each one lazy DataFrame plan.

Every builder takes an optional *spine* (a DataFrame of ids): by default a
``spark.range`` of the configured length; the harness passes ids derived from
its tables instead (spread over the task slots, if they come from a narrow file). Draws are keyed on the output row id, so a row's values
do not depend on partitioning, retries or the order rows are produced in.
Column expressions are assembled as SQL text and applied with one
``selectExpr`` per step; configuration lookups are constant arrays / maps.
"""

from __future__ import annotations

import logging
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinicgen import config as C
from clinicgen.functions import draws as D
from clinicgen.functions import rules as R
from clinicgen.operators import allocate as A
from clinicgen.operators import eligibility as E
from clinicgen.operators import ordinals as O
from clinicgen.operators import temporal as T
from clinicgen.session import range_parts
from clinicgen.sources.dims import by_index, spec_lookups, values

CAP_COLS = ["cap_camas_gen", "cap_camas_uci", "cap_camas_cirugia", "cap_camas_urg"]


def spine(spark: SparkSession, n: int, id_col: str, rows_per_part: int = 1_000_000) -> DataFrame:
    """Ids 1..n from ``spark.range`` (2.1.4), partitions sized by ``n`` and the cluster."""
    return spark.range(1, n + 1, 1, range_parts(spark, n, rows_per_part)).select(F.col("id").alias(id_col))


class Pools(NamedTuple):
    """Physicians and patients ranked for picks; encounters and appointments share them."""
    med: E.RankedPool
    pac: E.RankedPool


def rank_pools(cfg: C.Config, pac: DataFrame, med: DataFrame, keep: bool = True, empty_pool: str = "null") -> Pools:
    """Generated dates lie in [founding, as_of]: the calendars' proven range. ``empty_pool``: see ``check_pools``."""
    check_pools(pac, med, empty_pool)
    span = (cfg.founding, cfg.as_of)
    physicians = med.select("med_id", "fec_ingreso", "id_sede", "esp_principal")
    patients = pac.select("pac_id", "fec_primer_atencion")
    return Pools(E.rank_pool(physicians, "fec_ingreso", "med_id", cfg.seed, "elig.med", "le", span, keep=keep),
                 E.rank_pool(patients, "fec_primer_atencion", "pac_id", cfg.seed, "elig.pac", "ge", span, keep=keep))


# ------------------------------------------------------------------ patients
def build_pac_registro(spark: SparkSession, cfg: C.Config, ids: DataFrame | None = None) -> DataFrame:
    """Patients (2.9.1)."""
    s = cfg.seed
    ids = ids if ids is not None else spine(spark, cfg.length("pac_registro"), "pac_id")
    k = "pac_id"
    as_of, founding = R.lit_date(cfg.as_of), R.lit_date(cfg.founding)
    p = cfg.pac
    step1 = ids.selectExpr(
        k,
        f"{D.trunc_normal_int(s, 'pac.age', k, C.AGE_MEAN, C.AGE_SD, int(p['min_age']), int(p['max_age']))} AS _age",
        f"{D.draw_int(D.u(s, 'pac.a', k, slot=0), 1, len(cfg.cities))} AS id_ciudad_res")
    step2 = step1.selectExpr(
        "*",
        f"{R.birth_date(as_of, '_age', D.u(s, 'pac.a', k, slot=1))} AS fec_nac",
        f"{R.doc_type('_age', 'id_ciudad_res', D.u(s, 'pac.a', k, slot=2), cfg)} AS tip_doc",
        f"{D.draw_element(D.u(s, 'pac.b', k, slot=3), p['tips_aseguradoras'])} AS tip_aseguradora")
    num = R.doc_number("tip_doc", "id_ciudad_res", D.u(s, "pac.a", k, slot=3), D.u(s, "pac.b", k, slot=0), D.u(s, "pac.b", k, slot=1), cfg)
    _, id_eps = R.insurer(D.u(s, "pac.b", k, slot=3), D.u(s, "pac.c", k, slot=0), cfg)
    step3 = step2.selectExpr(
        k, "tip_doc", f"{R.pseudonymize(num)} AS num_doc_hash", "fec_nac",
        f"{D.weighted_choice(D.u(s, 'pac.b', k, slot=2), cfg.genders)} AS genero",
        "id_ciudad_res", f"{by_index(cfg.cities, 'id_ciudad_res')} AS ciudad_res",
        "tip_aseguradora", f"{id_eps} AS id_eps",
        f"{D.weighted_choice(D.u(s, 'pac.c', k, slot=1), cfg.strata)} AS estrato_socioec",
        f"{D.draw_date(D.u(s, 'pac.c', k, slot=2), f'greatest(fec_nac, {founding})', as_of)} AS fec_primer_atencion",
        f"{D.bernoulli(D.u(s, 'pac.c', k, slot=3), C.PCT_ACTIVE_PATIENT)} AS activo")
    out = step3.selectExpr("*", f"{by_index(cfg.insurers, 'id_eps')} AS eps")
    return out.select(*cfg.columns("pac_registro"))


# ---------------------------------------------------------------- physicians
def build_med_planta(spark: SparkSession, cfg: C.Config, ids: DataFrame | None = None) -> DataFrame:
    """Physicians (2.9.2): specialty, then sub-specialty within it (2.4.14)."""
    s = cfg.seed
    ids = ids if ids is not None else spine(spark, cfg.length("med_planta"), "med_id")
    k = "med_id"
    as_of, founding = R.lit_date(cfg.as_of), R.lit_date(cfg.founding)
    lo_age, hi_age = int(cfg.med["min_age_med"]), int(cfg.med["max_age_med"])
    names = [e for e, _ in cfg.specialties]
    subs = "array(" + ", ".join(D.str_array(x) for _, x in cfg.specialties) + ")"
    step1 = ids.selectExpr(
        k,
        f"{D.draw_int(D.u(s, 'med.a', k, slot=0), 1, len(cfg.specialties))} AS _n_esp",
        f"{D.draw_int(D.u(s, 'med.a', k, slot=2), 1, cfg.length('red_sedes'))} AS id_sede",
        f"{D.trunc_normal_int(s, 'med.age', k, C.AGE_MEAN, C.AGE_SD, lo_age, hi_age)} AS _age")
    lo = f"greatest({R.earliest_hire(as_of, '_age', lo_age)}, {founding})"
    out = step1.selectExpr(
        k,
        f"{by_index(names, '_n_esp')} AS esp_principal",
        f"{D.draw_element(D.u(s, 'med.a', k, slot=1), f'element_at({subs}, CAST(_n_esp AS INT))')} AS esp_secundaria",
        "id_sede",
        f"{D.draw_date(D.u(s, 'med.a', k, slot=3), lo, as_of)} AS fec_ingreso",
        f"{D.weighted_choice(D.u(s, 'med.b', k, slot=0), cfg.contracts)} AS tip_contrato",
        f"{D.weighted_choice(D.u(s, 'med.b', k, slot=1), cfg.shifts)} AS jornada",
        f"{D.bernoulli(D.u(s, 'med.b', k, slot=2), C.PCT_ACTIVE_PHYSICIAN)} AS estado_activo")
    return out.select(*cfg.columns("med_planta"))


# --------------------------------------------------------------------- sites
def bed_matrix(cfg: C.Config, ids: DataFrame) -> DataFrame:
    """Beds per (site, unit) from the budget split (2.7.1), one row per site of ``ids``."""
    n, units = cfg.length("red_sedes"), cfg.units
    cells = n * len(units)
    mean = int(cfg.bed_limit / cells)
    grid = ids.select(F.explode(F.expr(f"sequence((id_sede - 1) * {len(units)}, id_sede * {len(units)} - 1)")).alias("cell"))
    grid = grid.withColumn("_draw", A.bed_draw(cfg.seed, "site.beds", "cell", mean))
    alloc = A.budget_alloc(grid, "cell", F.col("_draw"), cfg.bed_limit)
    alloc = alloc.withColumn("id_sede", (F.floor(F.col("cell") / len(units)) + 1).cast("bigint")).withColumn("pos", F.col("cell") % len(units))
    return alloc.groupBy("id_sede").agg(*[F.max(F.when(F.col("pos") == j, F.col("alloc"))).alias(c) for j, c in enumerate(CAP_COLS[: len(units)])])


def build_red_sedes(spark: SparkSession, cfg: C.Config, ids: DataFrame | None = None) -> DataFrame:
    """Sites (2.9.3): distinct cities, shuffled site types, bed budget. ``ids``: site numbers 1..n, at most one per city."""
    s, n = cfg.seed, cfg.length("red_sedes")
    if n > len(cfg.cities):
        raise ValueError(f"{n} sites need {n} distinct cities; only {len(cfg.cities)} configured")
    city_ids = spark.range(1, len(cfg.cities) + 1, 1, 1).select(F.col("id").alias("id_ciudad"))
    cities = O.sample_without_replacement(city_ids, "id_ciudad", n, s, "site.city", out="id_sede", expected_rows=len(cfg.cities))
    ids = ids if ids is not None else spine(spark, n, "id_sede")
    counts = values(spark, [[str(i), D.lit_str(t), f"CAST({c} AS BIGINT)"] for i, (t, c) in enumerate(cfg.site_types)], ["i", "value", "n"])
    types = O.shuffle_multiset(counts, n, s, "site.type", pos_col="id_sede", value_col="tip_sede", order_col="i")
    df = ids.join(cities, "id_sede").join(types, "id_sede").join(bed_matrix(cfg, ids), "id_sede")
    df = df.selectExpr("*", f"{by_index(cfg.cities, 'id_ciudad')} AS nom_sede", f"{R.country_band('id_ciudad')} AS id_pais",
                       f"{R.complexity('tip_sede')} AS nivel_complejidad")
    return df.select(*cfg.columns("red_sedes"))


# ---------------------------------------------------------------- encounters
def _attempts(spark: SparkSession, lo: int, hi: int, med: DataFrame, n_med: int, seed: int, label: str) -> DataFrame:
    """Attempts lo..hi-1, each with a uniformly drawn physician; only the hire date is needed to accept."""
    att = spark.range(lo, hi, 1, range_parts(spark, hi - lo)).selectExpr("id AS t", f"{D.draw_int(D.u(seed, label, 'id', slot=0), 1, n_med)} AS med_id")
    return att.join(med.select("med_id", "fec_ingreso"), "med_id")


EMPTY_POOL_POLICIES = ("raise", "null")
_LOG = logging.getLogger("clinicgen")


def check_pools(pac: DataFrame, med: DataFrame, policy: str) -> int:
    """How many patients come before every hire date, so that no physician can take their first visit.

    The job would crash there (a random pick from an empty list). ``"raise"`` fails the build and names the count;
    ``"null"`` logs it and keeps their first visits with NULL physician, site and specialty, which
    ``checks`` reports under V0.
    """
    if policy not in EMPTY_POOL_POLICIES:
        raise ValueError(f"empty_pool must be one of {EMPTY_POOL_POLICIES}")
    first_hire = med.agg(F.min("fec_ingreso")).first()[0]
    early = pac if first_hire is None else pac.filter(F.col("fec_primer_atencion") < F.lit(first_hire))
    n = early.count()
    if n and policy == "raise":
        raise ValueError(f"{n} patients without an eligible physician: their first visit precedes every hire date")
    if n:
        _LOG.warning("%d patients without an eligible physician: first visits keep NULL physician, site and specialty", n)
    return n


def _clinical(df: DataFrame, cfg: C.Config) -> DataFrame:
    """Times, diagnoses, procedure, price and invoice state, keyed on id_encuentro."""
    s = cfg.seed
    k = "id_encuentro"
    wait_mean, wait_cap = cfg.wait
    look = spec_lookups(cfg, "esp_atendida")
    df = df.selectExpr("*", f"{D.draw_timestamp(D.u(s, 'enc.c', k, slot=0), '_lo', '_hi')} AS fec_inicio_atencion",
                       f"{look['cie10']} AS _cie10")
    d1, d2 = D.draw_two_distinct(D.u(s, "enc.d", k, slot=0), D.u(s, "enc.d", k, slot=1), D.u(s, "enc.d", k, slot=2), "_cie10", C.PCT_SECOND_DIAGNOSIS)
    paid, unpaid = C.INVOICE_STATES
    return df.selectExpr(
        "*",
        f"timestampadd(MILLISECOND, -{D.exp_clipped_ms(D.u(s, 'enc.c', k, slot=1), wait_mean, wait_cap, 60_000)}, fec_inicio_atencion) AS fec_registro",
        f"{D.draw_timestamp(D.u(s, 'enc.c', k, slot=2), 'fec_inicio_atencion', f'timestampadd(DAY, {cfg.max_stay_days}, fec_inicio_atencion)')} AS fec_egreso",
        f"{d1} AS diag_principal_cie10", f"{d2} AS diag_sec1_cie10",
        f"{look['cod_procedimientos']} AS cod_procedimientos", f"{look['vr_facturado']} AS vr_facturado",
        f"CASE WHEN {D.bernoulli(D.u(s, 'enc.d', k, slot=3), C.PCT_PAID)} THEN {D.lit_str(paid)} ELSE {D.lit_str(unpaid)} END AS estado_factura")


def build_hce_encuentros(spark: SparkSession, cfg: C.Config, pac: DataFrame, med: DataFrame,
                         n_pac: int | None = None, n_med: int | None = None, empty_pool: str = "raise", pools: Pools | None = None) -> DataFrame:
    """Inpatient encounters (2.9.4): first admissions then follow-ups.

    Phase A: 27% of patients, drawn without replacement; each gets a
    physician hired on or before the first visit (rank sampling). All of them are kept, also beyond the asked count.
    Phase B: attempts draw a physician, then a patient first seen on or
    after the hire date; a follow-up 15 days after the first visit (and not
    before the hire) must fit before ``as_of``. Ids are dense (A, then B by
    attempt number).
    """
    s = cfg.seed
    n_pac = n_pac if n_pac is not None else cfg.length("pac_registro")
    n_med = n_med if n_med is not None else cfg.length("med_planta")
    target = cfg.length("hce_encuentros")
    n_a = int(n_pac * C.FIRST_ADMISSION_SHARE)
    as_of = R.lit_date(cfg.as_of)
    first_kind, control_kind = C.VISIT_KINDS
    pools = pools or rank_pools(cfg, pac, med, empty_pool=empty_pool)
    pac_d = pac.select("pac_id", "fec_primer_atencion")
    med_d = med.select("med_id", "fec_ingreso", "id_sede", "esp_principal")

    a = O.sample_without_replacement(pac_d, "pac_id", n_a, s, "enc.a.pick", out="id_encuentro", expected_rows=n_pac)
    a = E.eligible_pick(a, "fec_primer_atencion", D.u(s, "enc.a", "id_encuentro"), pools.med, ["id_sede", "esp_principal"])
    a = a.selectExpr("id_encuentro", "pac_id", "med_id", "id_sede", "esp_principal AS esp_atendida", f"{R.day_start('fec_primer_atencion')} AS _lo",
                     f"{R.day_end('fec_primer_atencion')} AS _hi", f"{D.lit_str(first_kind)} AS tip_consulta")

    target_b = max(0, target - n_a)
    gap = cfg.max_stay_days + 1
    if target_b > 0:
        p = E.acceptance_rate(med_d, "fec_ingreso", pac_d, "fec_primer_atencion", F.date_sub(F.expr(as_of), gap))

        def attempts(lo: int, hi: int) -> DataFrame:
            att = _attempts(spark, lo, hi, med_d, n_med, s, "enc.b")
            att = E.eligible_pick(att, "fec_ingreso", D.u(s, "enc.b", "t", slot=1), pools.pac, ["fec_primer_atencion"])
            floor = R.control_floor("fec_primer_atencion", "fec_ingreso", gap)
            return att.selectExpr("t", "med_id", "pac_id", "pool_size", f"{floor} AS _floor").selectExpr(
                "t", "med_id", "pac_id", "_floor", f"coalesce(pool_size > 0 AND _floor <= {as_of}, false) AS accepted")

        b = E.accept_stream(attempts, target_b, p, "id_encuentro", n_a + 1).join(med_d.drop("fec_ingreso"), "med_id")
        b = b.selectExpr("id_encuentro", "pac_id", "med_id", "id_sede", "esp_principal AS esp_atendida",
                         f"{R.day_start('_floor')} AS _lo", f"{R.day_end(as_of)} AS _hi", f"{D.lit_str(control_kind)} AS tip_consulta")
        a = a.unionByName(b)
    return _clinical(a, cfg).select(*cfg.columns("hce_encuentros"))


# ----------------------------------------------------------------- hourly beds
def grid_hours(cfg: C.Config) -> int:
    return int(cfg.length("gcm_camas") / (cfg.length("red_sedes") * len(cfg.units)) + 1)


def last_grid_hour(cfg: C.Config) -> str:
    """Last hour of the grid: 23:00 of ``as_of`` (the job used the current hour)."""
    return R.at_hour(R.lit_date(cfg.as_of), 23)


def build_gcm_camas(spark: SparkSession, cfg: C.Config, sedes: DataFrame, enc: DataFrame) -> DataFrame:
    """Hourly bed occupancy per site and unit (2.9.5).

    Stays without a site take no bed. Stays are exchanged as blocks of hours and become hours after that.
    """
    s, units = cfg.seed, cfg.units
    hours, n_sites = grid_hours(cfg), cfg.length("red_sedes")
    last = F.expr(last_grid_hour(cfg))
    first = F.expr(f"timestampadd(HOUR, {-(hours - 1)}, {last_grid_hour(cfg)})")
    caps_cols = CAP_COLS[: len(units)]
    caps = sedes.select("id_sede", *caps_cols)
    # groups are keyed by the hour's index in the grid (0 = first hour): an integer, cheap to hash
    active = T.hours_by_block(enc.where("id_sede IS NOT NULL"), "id_sede", "id_encuentro", "fec_inicio_atencion", "fec_egreso", first, last, out="hour_idx")
    occ = A.capacity_fill(active(None), ["hour_idx", "id_sede"], "id_encuentro", caps, ["id_sede"], caps_cols, s, "bed",
                          unit_col="unit_pos", out="num_camas_ocupadas", within=["block"], again=active)
    grid = T.dense_grid(spark, hours, n_sites, units, last, id_col="id_registro_cama", hour_col="fec_hora_registro",
                        hour_idx_col="hour_idx")
    cells = grid.join(occ, ["hour_idx", "id_sede", "unit_pos"], "left")
    cells = cells.join(caps, "id_sede")
    cap = F.element_at(F.array(*[F.col(c) for c in caps_cols]), (F.col("unit_pos") + 1).cast("int"))
    cells = cells.withColumn("num_camas_ocupadas", F.coalesce(F.col("num_camas_ocupadas"), F.lit(0)).cast("bigint"))
    cells = A.bed_availability(cells, cap, F.col("num_camas_ocupadas"), D.u(s, "bed.maint", "id_registro_cama"))
    return cells.select(*cfg.columns("gcm_camas"))


# ------------------------------------------------------------------ dispensing
def build_far_dispensacion(spark: SparkSession, cfg: C.Config, enc: DataFrame, n_enc: int | None = None,
                           ids: DataFrame | None = None) -> DataFrame:
    """Drug dispensing lines (2.9.6), each tied to a uniformly drawn encounter of those that exist (dense ids)."""
    s = cfg.seed
    n_enc = n_enc if n_enc is not None else enc.count()
    if n_enc == 0:
        raise ValueError("no encounter to dispense to")
    ids = ids if ids is not None else spine(spark, cfg.length("far_dispensacion"), "id_dispensacion")
    k = "id_dispensacion"
    codes = [c for c, _, _ in cfg.drugs]
    names = [n for _, n, _ in cfg.drugs]
    prices = "array(" + ", ".join(f"CAST({p} AS BIGINT)" for _, _, p in cfg.drugs) + ")"
    df = ids.selectExpr(k, f"{D.draw_int(D.u(s, 'far.a', k, slot=0), 1, n_enc)} AS id_encuentro",
                        f"{D.draw_int(D.u(s, 'far.a', k, slot=2), 1, len(cfg.drugs))} AS _n_med",
                        f"{D.draw_int(D.u(s, 'far.a', k, slot=3), 1, cfg.max_quantity)} AS cantidad")
    df = df.join(enc.select("id_encuentro", "pac_id", "id_sede", "fec_inicio_atencion", "fec_egreso"), "id_encuentro")
    magistral, official = cfg.prescription_types[0], cfg.prescription_types[1]
    df = df.selectExpr(
        "*",
        f"{D.draw_timestamp(D.u(s, 'far.a', k, slot=1), 'fec_inicio_atencion', 'fec_egreso')} AS fec_dispensacion",
        f"{by_index(codes, '_n_med')} AS cod_medicamento", f"{by_index(names, '_n_med')} AS nombre_medicamento",
        f"element_at({prices}, CAST(_n_med AS INT)) AS vr_unitario",
        f"CASE WHEN {D.bernoulli(D.u(s, 'far.b', k, slot=0), C.PCT_OFFICIAL_PRESCRIPTION)} THEN {D.lit_str(official)} ELSE {D.lit_str(magistral)} END AS tip_prescripcion")
    return df.select(*cfg.columns("far_dispensacion"))


# ---------------------------------------------------------------- appointments
def _schedule(df: DataFrame, cfg: C.Config) -> DataFrame:
    """Booking, times of day and status, keyed on id_cita (2.8.9-14)."""
    s = cfg.seed
    k = "id_cita"
    as_of = R.lit_date(cfg.as_of)
    lead_mean, lead_cap = cfg.booking_lead
    df = df.selectExpr("*", f"{D.draw_timestamp(D.u(s, 'cit.c', k, slot=0), '_lo', '_hi')} AS fec_cita_programada")
    sched_t, arr_t, start_t = R.visit_times("fec_cita_programada", as_of, D.u(s, "cit.c", k, slot=2), D.u(s, "cit.c", k, slot=3), cfg)
    df = df.selectExpr(
        "*",
        f"timestampadd(MILLISECOND, -{D.exp_clipped_ms(D.u(s, 'cit.c', k, slot=1), lead_mean, lead_cap, 3_600_000)}, fec_cita_programada) AS fec_agendamiento",
        f"{sched_t} AS hra_cita_programada", f"{arr_t} AS hra_llegada_paciente")
    df = df.selectExpr("*", "greatest(hra_cita_programada, hra_llegada_paciente) AS hra_inicio_atencion")
    return df.selectExpr("*", f"{R.visit_status('fec_cita_programada', 'hra_inicio_atencion', as_of)} AS estado_cita")


def build_age_citas(spark: SparkSession, cfg: C.Config, pac: DataFrame, med: DataFrame, enc: DataFrame,
                    n_pac: int | None = None, n_med: int | None = None, max_rejects: int | None = None,
                    empty_pool: str = "raise", pools: Pools | None = None) -> DataFrame:
    """Outpatient appointments (2.9.7).

    Phase A: every patient without a first inpatient encounter, in id order.
    Phase B: follow-ups by accept/reject like encounters (first visit + 1 day);
    ``max_rejects`` reproduces the job's stop after that many rejects.
    """
    s = cfg.seed
    n_pac = n_pac if n_pac is not None else cfg.length("pac_registro")
    n_med = n_med if n_med is not None else cfg.length("med_planta")
    target = cfg.length("age_citas")
    as_of = R.lit_date(cfg.as_of)
    lo_h, hi_h = cfg.clinic_hours
    first_kind, control_kind = C.VISIT_KINDS
    pools = pools or rank_pools(cfg, pac, med, empty_pool=empty_pool)
    pac_d = pac.select("pac_id", "fec_primer_atencion")
    med_d = med.select("med_id", "fec_ingreso", "id_sede", "esp_principal")

    admitted = enc.filter(F.col("tip_consulta") == first_kind).select("pac_id")
    a = pac_d.join(admitted, "pac_id", "left_anti")
    a = O.dense_ids(a, "pac_id", "id_cita", bounds=(1, n_pac))
    n_a = n_pac - int(n_pac * C.FIRST_ADMISSION_SHARE)
    a = E.eligible_pick(a, "fec_primer_atencion", D.u(s, "cit.a", "id_cita"), pools.med, ["id_sede", "esp_principal"])
    a = a.selectExpr("id_cita", "pac_id", "med_id", "id_sede", "esp_principal AS esp_solicitada", f"{R.at_hour('fec_primer_atencion', lo_h)} AS _lo",
                     f"{R.at_hour('fec_primer_atencion', hi_h)} AS _hi", f"{D.lit_str(first_kind)} AS tip_cita")

    target_b = max(0, target - n_a)
    if target_b > 0:
        p = E.acceptance_rate(med_d, "fec_ingreso", pac_d, "fec_primer_atencion", F.date_sub(F.expr(as_of), 1))

        def attempts(lo: int, hi: int) -> DataFrame:
            att = _attempts(spark, lo, hi, med_d, n_med, s, "cit.b")
            att = E.eligible_pick(att, "fec_ingreso", D.u(s, "cit.b", "t", slot=1), pools.pac, ["fec_primer_atencion"])
            return att.selectExpr("t", "med_id", "pac_id", "pool_size", "date_add(fec_primer_atencion, 1) AS _floor").selectExpr(
                "t", "med_id", "pac_id", "_floor", f"coalesce(pool_size > 0 AND _floor <= {as_of}, false) AS accepted")

        b = E.accept_stream(attempts, target_b, p, "id_cita", n_a + 1, max_rejects).join(med_d.drop("fec_ingreso"), "med_id")
        b = b.selectExpr("id_cita", "pac_id", "med_id", "id_sede", "esp_principal AS esp_solicitada",
                         f"{R.at_hour('_floor', lo_h)} AS _lo", f"{R.day_end(as_of)} AS _hi", f"{D.lit_str(control_kind)} AS tip_cita")
        a = a.unionByName(b)
    return _schedule(a, cfg).select(*cfg.columns("age_citas"))
