"""One query per operator of SURVEY §2, run on the harness tables.

Each function takes a ``Harness`` and returns a DataFrame whose columns match
the oracle SQL in ``clinicgen.harness.oracle`` by name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinicgen import config as C
from clinicgen.functions import draws as D
from clinicgen.functions import rules as R
from clinicgen.harness.context import EVENTS_AS_OF, Harness, events_grid_bounds
from clinicgen.operators import allocate as A
from clinicgen.operators import eligibility as E
from clinicgen.operators import ordinals as O
from clinicgen.operators import temporal as TM
from clinicgen.plans import tables as TB
from clinicgen.session import cut_lineage, unique_path
from clinicgen.sources import sinks as SK
from clinicgen.sources.dims import dims, lookup

SEED = 82
QUERIES: dict[str, Callable[[Harness], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__[2:]] = fn
    return fn


def _cfg(h: Harness) -> C.Config:
    return h.config()  # constants only: no table is counted


def _day_draw(label: str, key: str, cfg: C.Config) -> str:
    return D.draw_date(D.u(SEED, label, key), R.lit_date(cfg.founding), R.lit_date(cfg.as_of))


# ----------------------------------------------------------------- sources
@query
def q_spine(h: Harness) -> DataFrame:
    ids = TB.spine(h.spark, h.count("customer"), "id")
    return O.dense_ids(h.table("customer").select("c_custkey"), "c_custkey", "id").join(ids, "id").select("id", "c_custkey")


@query
def q_dim_lookup(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    d = dims(h.spark, cfg)
    c = h.table("customer").selectExpr("c_custkey", f"{D.draw_int(D.u(SEED, 'q.city', 'c_custkey'), 1, len(cfg.cities))} AS id_ciudad")
    return lookup(c, d["city"], "id_ciudad").select("c_custkey", "id_ciudad", "ciudad", "id_pais")


# ----------------------------------------------------------------- sinks
def _encounter_projection(h: Harness) -> DataFrame:
    o = h.table("orders")
    return o.select((F.col("o_orderkey") + 1).alias("id_encuentro"), (F.col("o_custkey") + 1).alias("pac_id"),
                    F.col("o_orderdate").alias("fec_inicio_atencion"), F.col("o_orderpriority").alias("tip_consulta"),
                    F.col("o_totalprice").alias("vr_facturado"))


@query
def q_project_reorder(h: Harness) -> DataFrame:
    return _encounter_projection(h)


@query
def q_sink_parquet_roundtrip(h: Harness) -> DataFrame:
    df = _encounter_projection(h)
    path = unique_path(h.spark, "sink_parquet_roundtrip")
    SK.write_table(df, path, "parquet")
    return SK.read_table(h.spark, path, "parquet", df.schema)


def _site_rows(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    s = h.table("supplier").select("s_suppkey", "s_name", "s_nationkey")
    types = [t for t, _ in cfg.site_types]
    s = s.selectExpr("*", f"{D.draw_element(D.u(SEED, 'q.site', 's_suppkey'), types)} AS tip_sede")
    return s.selectExpr("*", f"{R.complexity('tip_sede')} AS nivel_complejidad")


@query
def q_complexity(h: Harness) -> DataFrame:
    return _site_rows(h).select("s_suppkey", "tip_sede", "nivel_complejidad")


@query
def q_sink_csv_roundtrip(h: Harness) -> DataFrame:
    df = _site_rows(h).select(
        "s_suppkey", "s_name", "tip_sede",
        F.when(F.col("nivel_complejidad") == "Baja", F.lit(None)).otherwise(F.col("nivel_complejidad")).alias("nivel"),
        F.when(F.col("s_nationkey") % 2 == 0, F.lit("")).otherwise(F.lit("Mantenimiento")).alias("motivo"))
    path = unique_path(h.spark, "sink_csv_roundtrip")
    SK.write_table(df, path, "csv")
    return SK.read_table(h.spark, path, "csv", df.schema)


# ---------------------------------------------------- projections / filters
@query
def q_capacity_unpivot(h: Harness) -> DataFrame:
    s = h.table("supplier").selectExpr("s_suppkey", *[f"{D.draw_int(D.u(SEED, 'q.cap', 's_suppkey', slot=j), 1, 50)} AS {c}"
                                                     for j, c in enumerate(TB.CAP_COLS)])
    cfg = _cfg(h)
    pairs = ", ".join(f"'{u}', {c}" for u, c in zip(cfg.units, TB.CAP_COLS))
    return s.selectExpr("s_suppkey", f"stack({len(cfg.units)}, {pairs}) as (tip_unidad, capacidad)")


@query
def q_filter_eq(h: Harness) -> DataFrame:
    o = h.table("orders").select("o_orderkey", "o_custkey")
    c = h.table("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return o.join(c, "o_custkey").select("o_orderkey", "o_custkey", "c_nationkey")


@query
def q_filter_range(h: Harness) -> DataFrame:
    o = h.table("orders")
    lo = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit("1999-12-31 00:00:00").cast("timestamp_ntz")
    return o.filter((F.col("o_orderdate") >= lo) & (F.col("o_orderdate") <= hi)).select("o_orderkey", "o_orderdate")


@query
def q_filter_stab(h: Harness) -> DataFrame:
    st = h.stays()
    lo, _ = events_grid_bounds(st)
    at = F.timestamp_add("HOUR", F.lit(24 * 10), lo)
    return st.filter((F.col("start") <= at) & (F.col("end") > at)).select("event_id", "site")


# ------------------------------------------------------------------ draws
@query
def q_draw_uniform(h: Harness) -> DataFrame:
    return h.table("orders").selectExpr("o_orderkey", f"{D.u(SEED, 'q.uniform', 'o_orderkey')} AS u_val")


@query
def q_draw_int(h: Harness) -> DataFrame:
    c = "c_custkey"
    return h.table("customer").selectExpr("c_custkey", f"{D.draw_int(D.u(SEED, 'q.int', c, slot=0), 1, 168)} AS city",
                                          f"{D.draw_int(D.u(SEED, 'q.int', c, slot=1), 0, 364)} AS days")


@query
def q_draw_element(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    return h.table("customer").selectExpr("c_custkey", f"{D.draw_element(D.u(SEED, 'q.elem', 'c_custkey'), cfg.pac['tips_aseguradoras'])} AS tip_aseguradora")


@query
def q_weighted_choice(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    c = "c_custkey"
    return h.table("customer").selectExpr("c_custkey", f"{D.weighted_choice(D.u(SEED, 'q.w', c, slot=0), cfg.genders)} AS genero",
                                          f"{D.weighted_choice(D.u(SEED, 'q.w', c, slot=1), cfg.strata)} AS estrato_socioec")


@query
def q_bernoulli(h: Harness) -> DataFrame:
    k = "o_orderkey"
    return h.table("orders").selectExpr("o_orderkey", f"{D.bernoulli(D.u(SEED, 'q.b', k, slot=0), 85)} AS activo",
                                        f"{D.bernoulli(D.u(SEED, 'q.b', k, slot=1), 95)} AS pagado",
                                        f"{D.bernoulli(D.u(SEED, 'q.b', k, slot=2), 20)} AS segundo")


@query
def q_draw_trunc_normal(h: Harness) -> DataFrame:
    c = "c_custkey"
    return h.table("customer").selectExpr("c_custkey", f"{D.trunc_normal_int(SEED, 'q.age', c, 45, 15, 0, 116)} AS age_pac",
                                          f"{D.trunc_normal_int(SEED, 'q.agemed', c, 45, 15, 23, 70)} AS age_med")


@query
def q_draw_exp_clipped(h: Harness) -> DataFrame:
    e = "event_id"
    return h.table("events").selectExpr("event_id", f"{D.exp_clipped_ms(D.u(SEED, 'q.exp', e, slot=0), 45, 180, 60_000)} AS wait_ms",
                                        f"{D.exp_clipped_ms(D.u(SEED, 'q.exp', e, slot=1), 1, 360, 3_600_000)} AS lead_ms")


@query
def q_draw_date(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    c = "c_custkey"
    d1 = D.draw_date(D.u(SEED, "q.date", c, slot=0), R.lit_date(cfg.founding), R.lit_date(cfg.as_of))
    df = h.table("customer").selectExpr("c_custkey", f"{d1} AS d1")
    return df.selectExpr("*", f"{D.draw_date(D.u(SEED, 'q.date', c, slot=1), 'd1', R.lit_date(cfg.as_of))} AS d2")


@query
def q_draw_timestamp(h: Harness) -> DataFrame:
    return h.table("orders").selectExpr("o_orderkey", f"{D.draw_timestamp(D.u(SEED, 'q.ts', 'o_orderkey'), 'o_orderdate', 'timestampadd(DAY, 14, o_orderdate)')} AS ts")


@query
def q_sample_wo_replacement(h: Harness) -> DataFrame:
    n = h.count("customer")
    k = int(n * C.FIRST_ADMISSION_SHARE)
    return O.sample_without_replacement(h.table("customer").select("c_custkey"), "c_custkey", k, SEED, "q.swr", out="draw_no", expected_rows=n)


@query
def q_shuffle_multiset(h: Harness) -> DataFrame:
    counts = h.table("customer").groupBy(F.col("c_mktsegment").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    sh = O.shuffle_multiset(counts, h.count("customer"), SEED, "q.multiset", pos_col="pos", value_col="segment")
    return sh.select((F.col("pos") - 1).alias("c_custkey"), "segment")


def _spec_pick(h: Harness, key: str, label: str) -> DataFrame:
    cfg = _cfg(h)
    d = dims(h.spark, cfg)
    df = h.table("orders").selectExpr(key, f"{D.draw_int(D.u(SEED, label, key), 1, len(cfg.specialties))} AS n_esp")
    return lookup(df, d["specialty"], "n_esp", "inner")  # chained map lookup as a broadcast join (2.5.9)


@query
def q_draw_two_distinct(h: Harness) -> DataFrame:
    df = _spec_pick(h, "o_orderkey", "q.spec")
    k = "o_orderkey"
    d1, d2 = D.draw_two_distinct(D.u(SEED, "q.diag", k, slot=0), D.u(SEED, "q.diag", k, slot=1), D.u(SEED, "q.diag", k, slot=2), "cie10", 20)
    return df.selectExpr("o_orderkey", "especialidad", f"{d1} AS diag1", f"{d2} AS diag2")


@query
def q_price_chain(h: Harness) -> DataFrame:
    return _spec_pick(h, "o_orderkey", "q.spec").select("o_orderkey", "especialidad", "cod_procedimientos", "vr_facturado")


@query
def q_nested_choice(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    d = dims(h.spark, cfg)
    k = "p_partkey"
    df = h.table("part").selectExpr("p_partkey", f"{D.draw_int(D.u(SEED, 'q.nest', k, slot=0), 1, len(cfg.specialties))} AS n_esp")
    df = lookup(df, d["specialty"], "n_esp", "inner")
    return df.selectExpr("p_partkey", "especialidad AS esp_principal",
                         f"{D.draw_element(D.u(SEED, 'q.nest', k, slot=1), 'subespecialidades')} AS esp_secundaria")


def _patient_rules(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    c = "c_custkey"
    df = h.table("customer").selectExpr("c_custkey", "c_name",
                                        f"{D.trunc_normal_int(SEED, 'q.age', c, 45, 15, 0, 116)} AS age",
                                        f"{D.draw_int(D.u(SEED, 'q.pr', c, slot=0), 1, len(cfg.cities))} AS id_ciudad")
    df = df.selectExpr("*", f"{R.doc_type('age', 'id_ciudad', D.u(SEED, 'q.pr', c, slot=1), cfg)} AS tip_doc")
    num = R.doc_number("tip_doc", "id_ciudad", D.u(SEED, "q.pr", c, slot=2), D.u(SEED, "q.pr", c, slot=3), D.u(SEED, "q.pr2", c, slot=0), cfg)
    return df.selectExpr("*", f"{num} AS num_doc")


@query
def q_doc_number(h: Harness) -> DataFrame:
    return _patient_rules(h).selectExpr("c_custkey", "tip_doc", "num_doc", f"{R.pseudonymize('num_doc')} AS num_doc_hash")


@query
def q_doc_type(h: Harness) -> DataFrame:
    return _patient_rules(h).select("c_custkey", "age", "id_ciudad", "tip_doc")


@query
def q_country_band(h: Harness) -> DataFrame:
    return _patient_rules(h).selectExpr("c_custkey", "id_ciudad", f"{R.country_band('id_ciudad')} AS id_pais")


@query
def q_pseudonymize(h: Harness) -> DataFrame:
    return h.table("customer").selectExpr("c_custkey", f"{R.pseudonymize('c_name')} AS name_hash")


@query
def q_birth_date(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    df = _patient_rules(h).select("c_custkey", "age")
    return df.selectExpr("*", f"{R.birth_date(R.lit_date(cfg.as_of), 'age', D.u(SEED, 'q.dob', 'c_custkey'))} AS fec_nac")


@query
def q_hire_date(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    k = "p_partkey"
    df = h.table("part").selectExpr("p_partkey", f"{D.trunc_normal_int(SEED, 'q.agemed', k, 45, 15, 23, 70)} AS age")
    df = df.selectExpr("*", f"{R.earliest_hire(R.lit_date(cfg.as_of), 'age', 23)} AS fec_min")
    lo = f"greatest(fec_min, {R.lit_date(cfg.founding)})"
    return df.selectExpr("*", f"{D.draw_date(D.u(SEED, 'q.hire', k), lo, R.lit_date(cfg.as_of))} AS fec_ingreso")


@query
def q_insurer(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    d = dims(h.spark, cfg)
    c = "c_custkey"
    tip, id_eps = R.insurer(D.u(SEED, "q.ins", c, slot=0), D.u(SEED, "q.ins", c, slot=1), cfg)
    df = h.table("customer").selectExpr("c_custkey", f"{tip} AS tip_aseguradora").selectExpr("*", f"{id_eps} AS id_eps")
    return lookup(df, d["insurer"], "id_eps").select("c_custkey", "tip_aseguradora", "id_eps", "eps")


# ----------------------------------------------------- accept / reject, ids
def _attempt_rows(h: Harness) -> DataFrame:
    o = h.table("orders").select(F.col("o_orderkey").alias("t"), "o_orderstatus")
    return o.selectExpr("*", f"o_orderstatus <> 'P' AND {D.u(SEED, 'q.acc', 't')} < 0.9D AS accepted")


def _attempt_bounds(h: Harness) -> tuple[int, int]:
    """First and last order key: the attempts' spine."""
    row = h.table("orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return (row[0] or 0, row[1] or 0)


@query
def q_accept_reject(h: Harness) -> DataFrame:
    target = h.count("orders") // 2
    return E.accept_first(_attempt_rows(h), "accepted", "t", target, "id", bounds=_attempt_bounds(h)).select("id", "t")


@query
def q_reject_cap(h: Harness) -> DataFrame:
    target = h.count("orders") // 2
    return E.accept_first(_attempt_rows(h), "accepted", "t", target, "id", max_rejects=10, bounds=_attempt_bounds(h)).select("id", "t")


@query
def q_dense_ids(h: Harness) -> DataFrame:
    acc = _attempt_rows(h).filter("accepted").select("t")
    return O.dense_ids(acc, "t", "id", bounds=_attempt_bounds(h))


@query
def q_phase_union(h: Harness) -> DataFrame:
    o = h.table("orders").select("o_orderkey", "o_orderpriority")
    a = o.filter(F.col("o_orderpriority") == "1-URGENT")
    a = O.dense_ids(a, "o_orderkey", "id")
    n_a = a.count()
    b = o.filter(F.expr(f"o_orderpriority <> '1-URGENT' AND {D.u(SEED, 'q.phase', 'o_orderkey')} < 0.9D"))
    b = O.dense_ids(b, "o_orderkey", "id", start=n_a + 1)
    return (a.select("id", "o_orderkey", F.lit(C.VISIT_KINDS[0]).alias("phase"))
            .unionByName(b.select("id", "o_orderkey", F.lit(C.VISIT_KINDS[1]).alias("phase"))))


@query
def q_row_count(h: Harness) -> DataFrame:
    return h.table("orders").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------- joins
def _patients_dates(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    return h.table("customer").selectExpr("c_custkey + 1 AS pac_id", f"{_day_draw('q.first', 'c_custkey', cfg)} AS fec_primer_atencion")


def _physicians_dates(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    return h.table("part").selectExpr("p_partkey + 1 AS med_id", f"{_day_draw('q.hire2', 'p_partkey', cfg)} AS fec_ingreso")


@query
def q_lookup_join(h: Harness) -> DataFrame:
    o = h.table("orders").select("o_orderkey", (F.col("o_custkey") + 1).alias("pac_id"))
    return o.join(_patients_dates(h), "pac_id").select("o_orderkey", "pac_id", "fec_primer_atencion")


@query
def q_dispense_join(h: Harness) -> DataFrame:
    li = h.table("lineitem").select("l_orderkey", "l_linenumber")
    o = h.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    df = li.join(o, "l_orderkey")
    k = "l_orderkey * 8 + l_linenumber"
    return df.selectExpr("l_orderkey", "l_linenumber", "o_custkey",
                         f"{D.draw_timestamp(D.u(SEED, 'q.disp', k), 'o_orderdate', 'timestampadd(DAY, 14, o_orderdate)')} AS fec_dispensacion")


@query
def q_eligible_pick_le(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    pool = E.rank_pool(_physicians_dates(h), "fec_ingreso", "med_id", SEED, "q.elig.med", "le", (cfg.founding, cfg.as_of))
    out = E.eligible_pick(_patients_dates(h), "fec_primer_atencion", D.u(SEED, "q.le", "pac_id"), pool)
    return out.select("pac_id", "pool_size", "med_id")


@query
def q_eligible_pick_ge(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    pool = E.rank_pool(_patients_dates(h), "fec_primer_atencion", "pac_id", SEED, "q.elig.pac", "ge", (cfg.founding, cfg.as_of))
    out = E.eligible_pick(_physicians_dates(h), "fec_ingreso", D.u(SEED, "q.ge", "med_id"), pool)
    return out.select("med_id", "pool_size", "pac_id")


@query
def q_hourly_occupancy(h: Harness) -> DataFrame:
    st = h.stays()
    lo, hi = events_grid_bounds(st)
    return TM.hourly_occupancy(st, "site", "start", "end", lo, hi, out="active", hour_col="hour")


@query
def q_anti_first_visit(h: Harness) -> DataFrame:
    urgent = h.table("orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return h.table("customer").select("c_custkey").join(urgent, "c_custkey", "left_anti")


def _events_grid(h: Harness):
    st = h.stays()
    lo, hi = events_grid_bounds(st)
    n_hours = h.spark.range(1).select(F.timestamp_diff("HOUR", lo, hi).alias("n")).collect()[0]["n"] + 1
    return st, lo, hi, int(n_hours)


@query
def q_hour_grid(h: Harness) -> DataFrame:
    # every hour from the first stay's start to the last stay's end
    _, _, hi, n_hours = _events_grid(h)
    return TM.hour_grid(h.spark, hi, n_hours, idx_col="hour_idx", ts_col="hour")


@query
def q_bed_grid(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    st, lo, hi, n = _events_grid(h)
    n_sites = h.count("nation")
    st = st.withColumn("id_sede", (F.col("site") % n_sites + 1).cast("bigint"))
    act = TM.explode_hours(st, "start", "end", lo, hi, out="hour", spread_by="event_id")
    act = act.selectExpr("*", f"CAST({D.draw_int(D.u(SEED, 'q.unit', 'event_id'), 0, len(cfg.units) - 1)} AS INT) AS unit_pos")
    counts = act.groupBy("hour", "id_sede", "unit_pos").agg(F.count(F.lit(1)).alias("n_active"))
    grid = TM.dense_grid(h.spark, n, n_sites, cfg.units, hi, id_col="cell_id")
    out = grid.join(counts, ["hour", "id_sede", "unit_pos"], "left")
    return out.select("cell_id", "hour", "id_sede", "tip_unidad", F.coalesce(F.col("n_active"), F.lit(0)).cast("bigint").alias("n_active"))


# ------------------------------------------------------------- allocation
def _supplier_cells(h: Harness) -> DataFrame:
    s = h.table("supplier").select("s_suppkey", "s_nationkey")
    cells = s.select("s_suppkey", "s_nationkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("unit_pos"))
    return cells.withColumn("cell", F.col("s_suppkey") * 4 + F.col("unit_pos"))


@query
def q_budget_alloc(h: Harness) -> DataFrame:
    cells = _supplier_cells(h)
    per = cells.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n_cells"))
    cells = cells.join(per, "s_nationkey")
    limit = F.col("n_cells") * 200
    cells = cells.withColumn("_draw", A.bed_draw(SEED, "q.beds", "cell", "CAST(floor(n_cells * 200 / n_cells) AS BIGINT)"))
    out = A.budget_alloc(cells, "cell", F.col("_draw"), limit, partition=["s_nationkey"])
    return out.select("s_suppkey", "unit_pos", "alloc")


@query
def q_bed_availability(h: Harness) -> DataFrame:
    cells = _supplier_cells(h)
    cells = cells.selectExpr("*", f"{D.draw_int(D.u(SEED, 'q.avail', 'cell', slot=0), 0, 60)} AS cap")
    cells = cells.selectExpr("*", f"{D.draw_int(D.u(SEED, 'q.avail', 'cell', slot=1), 0, 'cap')} AS occ")
    out = A.bed_availability(cells, F.col("cap"), F.col("occ"), D.u(SEED, "q.avail", "cell", slot=2))
    return out.select("s_suppkey", "unit_pos", "num_camas_disp", "num_camas_mant", "motivo_indisponibilidad")


@query
def q_capacity_fill(h: Harness) -> DataFrame:
    st = h.stays()
    lo, hi = events_grid_bounds(st)
    act = TM.explode_hours(st, "start", "end", lo, hi, out="hour", spread_by="event_id")
    caps = st.select("site").distinct().selectExpr("site", *[f"{D.draw_int(D.u(SEED, 'q.caps', 'site', slot=j), 0, 3)} AS {c}" for j, c in enumerate(TB.CAP_COLS)])
    act = act.withColumn("hour_no", F.timestamp_diff("HOUR", lo, F.col("hour")))
    occ = A.capacity_fill(act, ["site", "hour_no"], "event_id", caps, ["site"], TB.CAP_COLS, SEED, "q.fill", unit_col="unit_pos", out="occupied")
    return occ.select("site", "hour_no", "unit_pos", "occupied")


# ----------------------------------------------------------------- visits
def _visits(h: Harness) -> DataFrame:
    cfg = _cfg(h)
    ev = h.table("events").select("event_id", "ts")
    e = "event_id"
    day = "to_date(ts)"
    lo_h, hi_h = cfg.clinic_hours
    df = ev.selectExpr("event_id", f"{D.draw_timestamp(D.u(SEED, 'q.visit', e, slot=0), R.at_hour(day, lo_h), R.at_hour(day, hi_h))} AS prog")
    sched, arr, start = R.visit_times("prog", R.lit_date(EVENTS_AS_OF), D.u(SEED, "q.visit", e, slot=1), D.u(SEED, "q.visit", e, slot=2), cfg)
    return df.selectExpr("event_id", "prog", f"{sched} AS hra_cita_programada", f"{arr} AS hra_llegada_paciente", f"{start} AS hra_inicio_atencion")


@query
def q_visit_times(h: Harness) -> DataFrame:
    return _visits(h).select("event_id", "prog", "hra_cita_programada", "hra_llegada_paciente", "hra_inicio_atencion")


@query
def q_visit_status(h: Harness) -> DataFrame:
    v = _visits(h)
    return v.selectExpr("event_id", "hra_inicio_atencion", f"{R.visit_status('prog', 'hra_inicio_atencion', R.lit_date(EVENTS_AS_OF))} AS estado_cita")


# ----------------------------------------------------------------- tables
# The harness has few physicians, so some patients precede every hire date: the "null" policy keeps
# them, and checks V0 would report them.
def _patients(h: Harness, cfg: C.Config) -> DataFrame:
    return TB.build_pac_registro(h.spark, cfg, h.patient_ids())


def _physicians(h: Harness, cfg: C.Config) -> DataFrame:
    return TB.build_med_planta(h.spark, cfg, h.physician_ids())


def _visit_inputs(h: Harness, *tables: str) -> tuple[C.Config, DataFrame, DataFrame, TB.Pools]:
    """Patients, physicians and their ranked pools, each written once, as ``build_all`` does."""
    cfg = h.config("pac_registro", "med_planta", "red_sedes", "hce_encuentros", *tables)
    pac, med = cut_lineage(_patients(h, cfg), "pac_registro"), cut_lineage(_physicians(h, cfg), "med_planta")
    return cfg, pac, med, TB.rank_pools(cfg, pac, med)


def _encounters(h: Harness, *tables: str):
    cfg, pac, med, pools = _visit_inputs(h, *tables)
    enc = cut_lineage(TB.build_hce_encuentros(h.spark, cfg, pac, med, empty_pool="null", pools=pools), "hce_encuentros")
    return cfg, pac, med, enc, pools


@query
def q_table_pac_registro(h: Harness) -> DataFrame:
    return _patients(h, h.config())


@query
def q_table_med_planta(h: Harness) -> DataFrame:
    return _physicians(h, h.config("red_sedes"))


@query
def q_table_red_sedes(h: Harness) -> DataFrame:
    return TB.build_red_sedes(h.spark, h.config("red_sedes"), h.site_ids())


@query
def q_table_hce_encuentros(h: Harness) -> DataFrame:
    cfg, pac, med, pools = _visit_inputs(h)
    return TB.build_hce_encuentros(h.spark, cfg, pac, med, empty_pool="null", pools=pools)


@query
def q_table_far_dispensacion(h: Harness) -> DataFrame:
    cfg, _, _, enc, _ = _encounters(h)
    return TB.build_far_dispensacion(h.spark, cfg, enc, ids=h.dispensing_ids())


@query
def q_table_age_citas(h: Harness) -> DataFrame:
    cfg, pac, med, enc, pools = _encounters(h, "age_citas")
    return TB.build_age_citas(h.spark, cfg, pac, med, enc, empty_pool="null", pools=pools)


@query
def q_table_gcm_camas(h: Harness) -> DataFrame:
    cfg, _, _, enc, _ = _encounters(h, "gcm_camas")
    return TB.build_gcm_camas(h.spark, cfg, TB.build_red_sedes(h.spark, cfg, h.site_ids()), enc)
