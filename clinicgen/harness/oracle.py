"""Independent DuckDB SQL for every harness query (the correctness oracle).

Written in the *naive* form -- theta joins and correlated counts instead of
rank sampling, recursive CTEs instead of closed forms and phases, global
``row_number()`` instead of block-wise ranks -- so that only the seeded draw
``u(label, key)`` and the constants of the configuration are shared with the Spark implementation.
"""

from __future__ import annotations

import math

from clinicgen import config as C
from clinicgen.harness.context import AS_OF, EVENTS_AS_OF

SEED = 82
TWO_PI = 2 * math.pi
CAPS = ["cap_camas_gen", "cap_camas_uci", "cap_camas_cirugia", "cap_camas_urg"]


# ------------------------------------------------------------------ helpers
def q(s: str | None) -> str:
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def arr(values) -> str:
    return "CAST([" + ", ".join(q(v) for v in values) + "] AS VARCHAR[])"


def U(label: str, *keys, slot: int = 0) -> str:
    ks = ", ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    h = f"sha256(concat_ws('|', '{SEED}', '{label}', {ks}))"
    return f"(CAST(CAST('0x' || substr({h}, {1 + 13 * slot}, 13) AS BIGINT) AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))"


def DINT(u: str, lo, hi) -> str:
    return f"CAST(({lo}) + floor(({u}) * (({hi}) - ({lo}) + 1)) AS BIGINT)"


def ELEM(u: str, a: str) -> str:
    return f"({a})[CAST(floor(({u}) * len({a})) AS BIGINT) + 1]"


def WEIGHTED(u: str, weights) -> str:
    total = float(sum(w for _, w in weights))
    parts, upto = [], 0.0
    for v, w in weights[:-1]:
        upto += float(w)
        parts.append(f"WHEN ({u}) < {dbl(upto / total)} THEN {q(v)}")
    return f"CAST(CASE {' '.join(parts)} ELSE {q(weights[-1][0])} END AS VARCHAR)"


def BERN(u: str, pct: float) -> str:
    return f"(({u}) < {dbl(pct / 100.0)})"


def NORMAL(u1: str, u2: str) -> str:
    return f"(sqrt({dbl(-2.0)} * ln({dbl(1.0)} - {u1})) * cos({dbl(TWO_PI)} * {u2}))"


def TRUNC_NORMAL(label: str, key: str, mean, sd, lo, hi) -> str:
    """Smallest v in [lo, hi] whose cumulative probability exceeds the uniform.

    Truncation toward zero gives v > 0 the interval [v, v + 1), 0 the interval (-1, 1) and v < 0 the
    interval (v - 1, v]; the cumulative is that of the normal between the ends of the allowed values.
    """
    phi = lambda x: 0.5 * (1 + math.erf((x - mean) / (sd * math.sqrt(2))))
    upper = lambda v: v + 1 if v >= 0 else v
    base = phi(lo if lo > 0 else lo - 1)
    span = phi(upper(hi)) - base
    cuts = "[" + ", ".join(dbl((phi(upper(v)) - base) / span) for v in range(lo, hi)) + "]"
    return f"CAST({lo} + len(list_filter({cuts}, lambda c: c <= {U(label, key)})) AS BIGINT)"


def EXP_MS(u: str, mean, cap, unit_ms) -> str:
    return f"CAST(floor(least({dbl(-mean)} * ln({dbl(1.0)} - ({u})), {dbl(cap)}) * {dbl(unit_ms)}) AS BIGINT)"


def DDATE(u: str, lo: str, hi: str) -> str:
    return f"(({lo}) + CAST(floor(({u}) * (date_diff('day', {lo}, {hi}) + 1)) AS INTEGER))"


def DTS(u: str, lo: str, hi: str) -> str:
    return f"(({lo}) + to_seconds(CAST(floor(({u}) * (date_sub('second', {lo}, {hi}) + 1)) AS BIGINT)))"


def DATE(d) -> str:
    return f"DATE '{d.isoformat()}'"


def COUNTRY(x: str) -> str:
    (b1, c1), (b2, c2), (_, c3) = C.COUNTRY_BANDS
    return f"CASE WHEN {x} <= {b1} THEN '{c1}' WHEN {x} <= {b2} THEN '{c2}' ELSE '{c3}' END"


def COMPLEXITY(x: str) -> str:
    whens = " ".join(f"WHEN {x} = {q(t)} THEN {q(v)}" for t, v in C.COMPLEXITY.items())
    return f"CASE {whens} ELSE {q(C.COMPLEXITY_DEFAULT)} END"


CFG = C.Config()
FOUND = DATE(CFG.founding)
ASOF = DATE(AS_OF)
CITIES = arr(CFG.cities)
INSURERS = arr(CFG.insurers)


def n_of(table: str) -> str:
    return f"(SELECT count(*) FROM {table})"


def DOC_TYPE(age: str, city: str, u: str) -> str:
    p = CFG.pac
    return (f"CASE WHEN {age} < {C.MINOR_AGE} THEN {q(C.MINOR_DOC)} WHEN {city} <= 96 THEN {ELEM(u, arr(p['docs_col']))} "
            f"WHEN {city} <= 116 THEN {ELEM(u, arr(p['docs_ecu']))} ELSE {ELEM(u, arr(p['docs_peru']))} END")


def DOC_NUM(tip: str, city: str, un: str, up1: str, up2: str) -> str:
    digits = f"CASE WHEN {city} <= 116 THEN {dbl(CFG.pac['ext_gral'])} ELSE {dbl(CFG.pac['ext_peru'])} END"
    passport = f"(chr(CAST(65 + floor({up1} * 26) AS INTEGER)) || lpad(CAST(CAST(floor({up2} * {dbl(1e8)}) AS BIGINT) AS VARCHAR), 8, '0'))"
    num = f"CAST(CAST(floor({un} * pow({dbl(10.0)}, {digits})) AS BIGINT) AS VARCHAR)"
    return f"CASE WHEN {tip} = 'Pasaporte' THEN {passport} ELSE {num} END"


def SPEC_VALUES() -> str:
    rows = []
    for i, (esp, subs) in enumerate(CFG.specialties, start=1):
        code = CFG.doc["procedimientos"][esp]
        rows.append(f"({i}, {q(esp)}, {arr(subs)}, {arr(CFG.doc['cie10'][esp])}, {q(code)}, CAST({int(CFG.doc['vrs'][code])} AS BIGINT))")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(n_esp, especialidad, subespecialidades, cie10, cod_procedimientos, vr_facturado)"


def STAYS() -> str:
    return ("SELECT event_id, user_id AS site, ts AS start, "
            "ts + to_hours(CAST(trunc(value) AS BIGINT) % 5) + to_minutes(event_id % 60) AS \"end\" FROM events")


GRID_LO = "(SELECT date_trunc('hour', min(start)) FROM stays)"
GRID_HI = "(SELECT date_trunc('hour', max(\"end\")) FROM stays)"


# ------------------------------------------------------------------- oracles
O: dict[str, str] = {}


def oracle(name: str):
    def deco(fn):
        O[name] = fn()
        return fn
    return deco


@oracle("spine")
def _():
    return "SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS id, c_custkey FROM customer"


@oracle("dim_lookup")
def _():
    city = DINT(U("q.city", "c_custkey"), 1, len(CFG.cities))
    return (f"SELECT c_custkey, id_ciudad, {CITIES}[id_ciudad] AS ciudad, {COUNTRY('id_ciudad')} AS id_pais "
            f"FROM (SELECT c_custkey, {city} AS id_ciudad FROM customer)")


ENC_PROJ = ("SELECT o_orderkey + 1 AS id_encuentro, o_custkey + 1 AS pac_id, o_orderdate AS fec_inicio_atencion, "
            "o_orderpriority AS tip_consulta, o_totalprice AS vr_facturado FROM orders")
O["project_reorder"] = ENC_PROJ
O["sink_parquet_roundtrip"] = ENC_PROJ


def _site_rows() -> str:
    types = arr([t for t, _ in CFG.site_types])
    return f"SELECT s_suppkey, s_name, s_nationkey, {ELEM(U('q.site', 's_suppkey'), types)} AS tip_sede FROM supplier"


@oracle("complexity")
def _():
    return f"SELECT s_suppkey, tip_sede, {COMPLEXITY('tip_sede')} AS nivel_complejidad FROM ({_site_rows()})"


@oracle("sink_csv_roundtrip")
def _():
    return (f"SELECT s_suppkey, s_name, tip_sede, CASE WHEN {COMPLEXITY('tip_sede')} = 'Baja' THEN NULL ELSE {COMPLEXITY('tip_sede')} END AS nivel, "
            f"CASE WHEN s_nationkey % 2 = 0 THEN '' ELSE 'Mantenimiento' END AS motivo FROM ({_site_rows()})")


@oracle("capacity_unpivot")
def _():
    parts = []
    for j, (unit, c) in enumerate(zip(CFG.units, CAPS)):
        parts.append(f"SELECT s_suppkey, {q(unit)} AS tip_unidad, {DINT(U('q.cap', 's_suppkey', slot=j), 1, 50)} AS capacidad FROM supplier")
    return " UNION ALL ".join(parts)


O["filter_eq"] = "SELECT o_orderkey, o_custkey, c_nationkey FROM orders JOIN customer ON c_custkey = o_custkey"
O["filter_range"] = ("SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00' "
                     "AND o_orderdate <= TIMESTAMP '1999-12-31 00:00:00'")
O["filter_stab"] = (f"WITH stays AS ({STAYS()}) SELECT event_id, site FROM stays, "
                    f"(SELECT {GRID_LO} + INTERVAL 240 HOUR AS at_ts) WHERE start <= at_ts AND \"end\" > at_ts")
O["draw_uniform"] = f"SELECT o_orderkey, {U('q.uniform', 'o_orderkey')} AS u_val FROM orders"
O["draw_int"] = (f"SELECT c_custkey, {DINT(U('q.int', 'c_custkey', slot=0), 1, 168)} AS city, "
                 f"{DINT(U('q.int', 'c_custkey', slot=1), 0, 364)} AS days FROM customer")
O["draw_element"] = f"SELECT c_custkey, {ELEM(U('q.elem', 'c_custkey'), arr(CFG.pac['tips_aseguradoras']))} AS tip_aseguradora FROM customer"
O["weighted_choice"] = (f"SELECT c_custkey, {WEIGHTED(U('q.w', 'c_custkey', slot=0), CFG.genders)} AS genero, "
                        f"{WEIGHTED(U('q.w', 'c_custkey', slot=1), CFG.strata)} AS estrato_socioec FROM customer")
O["bernoulli"] = (f"SELECT o_orderkey, {BERN(U('q.b', 'o_orderkey', slot=0), 85)} AS activo, {BERN(U('q.b', 'o_orderkey', slot=1), 95)} AS pagado, "
                  f"{BERN(U('q.b', 'o_orderkey', slot=2), 20)} AS segundo FROM orders")
O["draw_trunc_normal"] = (f"SELECT c_custkey, {TRUNC_NORMAL('q.age', 'c_custkey', 45, 15, 0, 116)} AS age_pac, "
                          f"{TRUNC_NORMAL('q.agemed', 'c_custkey', 45, 15, 23, 70)} AS age_med FROM customer")
O["draw_exp_clipped"] = (f"SELECT event_id, {EXP_MS(U('q.exp', 'event_id', slot=0), 45, 180, 60000)} AS wait_ms, "
                         f"{EXP_MS(U('q.exp', 'event_id', slot=1), 1, 360, 3600000)} AS lead_ms FROM events")
O["draw_date"] = (f"SELECT c_custkey, d1, {DDATE(U('q.date', 'c_custkey', slot=1), 'd1', ASOF)} AS d2 FROM "
                  f"(SELECT c_custkey, {DDATE(U('q.date', 'c_custkey', slot=0), FOUND, ASOF)} AS d1 FROM customer)")
O["draw_timestamp"] = f"SELECT o_orderkey, {DTS(U('q.ts', 'o_orderkey'), 'o_orderdate', 'o_orderdate + INTERVAL 14 DAY')} AS ts FROM orders"
O["sample_wo_replacement"] = (f"SELECT c_custkey, draw_no FROM (SELECT c_custkey, row_number() OVER (ORDER BY {U('q.swr', 'c_custkey')}, c_custkey) AS draw_no "
                              f"FROM customer) WHERE draw_no <= floor({n_of('customer')} * {dbl(C.FIRST_ADMISSION_SHARE)})")


@oracle("shuffle_multiset")
def _():
    return ("WITH seg AS (SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1), "
            "bounds AS (SELECT segment, n, sum(n) OVER (ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS lo FROM seg), "
            "elems AS (SELECT segment, lo + k AS e FROM bounds, range(0, n) r(k)) "
            f"SELECT CAST(row_number() OVER (ORDER BY {U('q.multiset', 'e')}, e) - 1 AS BIGINT) AS c_custkey, segment FROM elems")


SPEC_PICK = (f"SELECT o.o_orderkey, s.* FROM (SELECT o_orderkey, {DINT(U('q.spec', 'o_orderkey'), 1, 20)} AS n_esp FROM orders) o "
             f"JOIN ({SPEC_VALUES()}) s USING (n_esp)")


@oracle("draw_two_distinct")
def _():
    k = "o_orderkey"
    d1 = ELEM(U("q.diag", k, slot=0), "cie10")
    return (f"SELECT o_orderkey, especialidad, diag1, CASE WHEN len(rest) > 0 AND {BERN(U('q.diag', k, slot=1), 20)} "
            f"THEN {ELEM(U('q.diag', k, slot=2), 'rest')} END AS diag2 FROM ("
            f"SELECT o_orderkey, especialidad, {d1} AS diag1, list_filter(cie10, lambda x: x <> {d1}) AS rest FROM ({SPEC_PICK}))")


O["price_chain"] = f"SELECT o_orderkey, especialidad, cod_procedimientos, vr_facturado FROM ({SPEC_PICK})"
O["nested_choice"] = (f"SELECT p_partkey, especialidad AS esp_principal, {ELEM(U('q.nest', 'p_partkey', slot=1), 'subespecialidades')} AS esp_secundaria "
                      f"FROM (SELECT p_partkey, {DINT(U('q.nest', 'p_partkey', slot=0), 1, 20)} AS n_esp FROM part) JOIN ({SPEC_VALUES()}) USING (n_esp)")


def _patient_rules() -> str:
    c = "c_custkey"
    inner = (f"SELECT c_custkey, c_name, {TRUNC_NORMAL('q.age', c, 45, 15, 0, 116)} AS age, "
             f"{DINT(U('q.pr', c, slot=0), 1, len(CFG.cities))} AS id_ciudad FROM customer")
    mid = f"SELECT *, {DOC_TYPE('age', 'id_ciudad', U('q.pr', c, slot=1))} AS tip_doc FROM ({inner})"
    return f"SELECT *, {DOC_NUM('tip_doc', 'id_ciudad', U('q.pr', c, slot=2), U('q.pr', c, slot=3), U('q.pr2', c, slot=0))} AS num_doc FROM ({mid})"


O["doc_number"] = f"SELECT c_custkey, tip_doc, num_doc, sha256(num_doc) AS num_doc_hash FROM ({_patient_rules()})"
O["doc_type"] = f"SELECT c_custkey, age, id_ciudad, tip_doc FROM ({_patient_rules()})"
O["country_band"] = f"SELECT c_custkey, id_ciudad, {COUNTRY('id_ciudad')} AS id_pais FROM ({_patient_rules()})"
O["pseudonymize"] = "SELECT c_custkey, sha256(c_name) AS name_hash FROM customer"


def BIRTH(age: str, u: str) -> str:
    return f"CAST(CAST({ASOF} - to_months(CAST(12 * {age} AS INTEGER)) AS DATE) - CAST(floor({u} * 365) AS INTEGER) AS DATE)"


def EARLIEST(age: str, min_age: int) -> str:
    return f"CAST({ASOF} - to_months(CAST(12 * ({age} - {min_age}) AS INTEGER)) AS DATE)"


O["birth_date"] = f"SELECT c_custkey, age, {BIRTH('age', U('q.dob', 'c_custkey'))} AS fec_nac FROM ({_patient_rules()})"
O["hire_date"] = (f"SELECT p_partkey, age, fec_min, {DDATE(U('q.hire', 'p_partkey'), f'greatest(fec_min, {FOUND})', ASOF)} AS fec_ingreso FROM "
                  f"(SELECT p_partkey, age, {EARLIEST('age', 23)} AS fec_min FROM "
                  f"(SELECT p_partkey, {TRUNC_NORMAL('q.agemed', 'p_partkey', 45, 15, 23, 70)} AS age FROM part))")
O["insurer"] = (f"SELECT c_custkey, tip_aseguradora, id_eps, {INSURERS}[id_eps] AS eps FROM ("
                f"SELECT c_custkey, tip_aseguradora, CASE WHEN tip_aseguradora IS NOT NULL THEN {DINT(U('q.ins', 'c_custkey', slot=1), 1, len(CFG.insurers))} END AS id_eps "
                f"FROM (SELECT c_custkey, {ELEM(U('q.ins', 'c_custkey', slot=0), arr(CFG.pac['tips_aseguradoras']))} AS tip_aseguradora FROM customer))")

ATTEMPTS = f"SELECT o_orderkey AS t, o_orderstatus <> 'P' AND {U('q.acc', 'o_orderkey')} < {dbl(0.9)} AS accepted FROM orders"
O["accept_reject"] = (f"SELECT id, t FROM (SELECT t, CAST(row_number() OVER (ORDER BY t) AS BIGINT) AS id FROM ({ATTEMPTS}) WHERE accepted) "
                      f"WHERE id <= {n_of('orders')} // 2")
O["reject_cap"] = (f"WITH a AS ({ATTEMPTS}), cut AS (SELECT coalesce((SELECT t FROM a WHERE NOT accepted ORDER BY t LIMIT 1 OFFSET 9), 9223372036854775807) AS c) "
                   f"SELECT id, t FROM (SELECT t, CAST(row_number() OVER (ORDER BY t) AS BIGINT) AS id FROM a, cut WHERE accepted AND t < c) "
                   f"WHERE id <= {n_of('orders')} // 2")
O["dense_ids"] = f"SELECT t, CAST(row_number() OVER (ORDER BY t) AS BIGINT) AS id FROM ({ATTEMPTS}) WHERE accepted"
O["phase_union"] = ("WITH a AS (SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id, o_orderkey, 'Primera vez' AS phase "
                    "FROM orders WHERE o_orderpriority = '1-URGENT'), "
                    f"b AS (SELECT (SELECT count(*) FROM a) + CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id, o_orderkey, 'Control' AS phase "
                    f"FROM orders WHERE o_orderpriority <> '1-URGENT' AND {U('q.phase', 'o_orderkey')} < {dbl(0.9)}) "
                    "SELECT * FROM a UNION ALL SELECT * FROM b")
O["row_count"] = "SELECT count(*) AS n_rows FROM orders"

PATS = f"SELECT c_custkey + 1 AS pac_id, {DDATE(U('q.first', 'c_custkey'), FOUND, ASOF)} AS fec_primer_atencion FROM customer"
MEDS = f"SELECT p_partkey + 1 AS med_id, {DDATE(U('q.hire2', 'p_partkey'), FOUND, ASOF)} AS fec_ingreso FROM part"
O["lookup_join"] = f"SELECT o_orderkey, o_custkey + 1 AS pac_id, p.fec_primer_atencion FROM orders JOIN ({PATS}) p ON p.pac_id = o_custkey + 1"
O["dispense_join"] = (f"SELECT l_orderkey, l_linenumber, o_custkey, {DTS(U('q.disp', 'l_orderkey * 8 + l_linenumber'), 'o_orderdate', 'o_orderdate + INTERVAL 14 DAY')} AS fec_dispensacion "
                      "FROM lineitem JOIN orders ON o_orderkey = l_orderkey")


def PICK(left: str, lkey: str, ldate: str, ulabel: str, pool: str, pid: str, pdate: str, tblabel: str, direction: str, cols: str = "") -> str:
    """Naive eligible pick: theta-join count + global rank of the pool."""
    op = "<=" if direction == "le" else ">="
    order = f"{pdate}{'' if direction == 'le' else ' DESC'}, {U(tblabel + '.tb', pid)}, {pid}"
    extra = (", " + cols) if cols else ""
    return (f"WITH l AS ({left}), p AS ({pool}), "
            f"ranked AS (SELECT {pid}{extra}, row_number() OVER (ORDER BY {order}) AS rk FROM p), "
            f"k AS (SELECT l.*, (SELECT count(*) FROM p WHERE p.{pdate} {op} l.{ldate}) AS pool_size FROM l), "
            f"r AS (SELECT k.*, CASE WHEN pool_size > 0 THEN CAST(floor({U(ulabel, lkey)} * pool_size) AS BIGINT) + 1 END AS rr FROM k) "
            f"SELECT r.* EXCLUDE (rr), ranked.* EXCLUDE (rk) FROM r LEFT JOIN ranked ON ranked.rk = r.rr")


O["eligible_pick_le"] = (f"SELECT pac_id, pool_size, med_id FROM ("
                         f"{PICK(PATS, 'pac_id', 'fec_primer_atencion', 'q.le', MEDS, 'med_id', 'fec_ingreso', 'q.elig.med', 'le')})")
O["eligible_pick_ge"] = (f"SELECT med_id, pool_size, pac_id FROM ("
                         f"{PICK(MEDS, 'med_id', 'fec_ingreso', 'q.ge', PATS, 'pac_id', 'fec_primer_atencion', 'q.elig.pac', 'ge')})")
O["hourly_occupancy"] = (f"WITH stays AS ({STAYS()}), hours AS (SELECT unnest(generate_series({GRID_LO}, {GRID_HI}, INTERVAL 1 HOUR)) AS hour) "
                         "SELECT site, hour, count(*) AS active FROM stays JOIN hours ON start <= hour AND \"end\" > hour GROUP BY site, hour")
O["anti_first_visit"] = "SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderpriority = '1-URGENT')"
O["hour_grid"] = (f"WITH stays AS ({STAYS()}) SELECT CAST(row_number() OVER (ORDER BY hour) - 1 AS BIGINT) AS hour_idx, hour FROM "
                  f"(SELECT unnest(generate_series({GRID_LO}, {GRID_HI}, INTERVAL 1 HOUR)) AS hour)")


@oracle("bed_grid")
def _():
    units = arr(CFG.units)
    return (f"WITH stays AS ({STAYS()}), ns AS (SELECT count(*) AS n FROM nation), "
            f"hours AS (SELECT row_number() OVER (ORDER BY hour) - 1 AS hi, hour FROM (SELECT unnest(generate_series({GRID_LO}, {GRID_HI}, INTERVAL 1 HOUR)) AS hour)), "
            "sites AS (SELECT CAST(i AS BIGINT) AS id_sede FROM ns, range(1, ns.n + 1) t(i)), "
            "units AS (SELECT i AS unit_pos FROM range(0, 4) t(i)), "
            "grid AS (SELECT hours.hi * ns.n * 4 + (id_sede - 1) * 4 + unit_pos + 1 AS cell_id, hour, id_sede, unit_pos FROM hours, sites, units, ns), "
            f"act AS (SELECT hour, site % (SELECT n FROM ns) + 1 AS id_sede, {DINT(U('q.unit', 'event_id'), 0, 3)} AS unit_pos, count(*) AS n "
            "FROM stays JOIN hours ON start <= hour AND \"end\" > hour GROUP BY ALL) "
            f"SELECT CAST(cell_id AS BIGINT) AS cell_id, grid.hour, grid.id_sede, {units}[grid.unit_pos + 1] AS tip_unidad, CAST(coalesce(act.n, 0) AS BIGINT) AS n_active "
            "FROM grid LEFT JOIN act USING (hour, id_sede, unit_pos)")


SUPPLIER_CELLS = "SELECT s_suppkey, s_nationkey, u AS unit_pos, s_suppkey * 4 + u AS cell FROM supplier, range(0, 4) t(u)"


@oracle("budget_alloc")
def _():
    draw = f"abs(CAST(trunc(CAST(mean AS DOUBLE) + {dbl(C.BED_SD)} * {NORMAL(U('q.beds', 'cell', slot=0), U('q.beds', 'cell', slot=1))}) AS BIGINT))"
    return (f"WITH RECURSIVE c0 AS ({SUPPLIER_CELLS}), "
            "c1 AS (SELECT *, count(*) OVER (PARTITION BY s_nationkey) AS n, row_number() OVER (PARTITION BY s_nationkey ORDER BY cell) AS i FROM c0), "
            f"c2 AS (SELECT *, n * 200 AS lim, CAST(floor(n * 200 / n) AS BIGINT) AS mean FROM c1), "
            f"cells AS (SELECT *, {draw} AS draw FROM c2), "
            "rec(s_nationkey, i, given, s_suppkey, unit_pos, alloc) AS ("
            "SELECT DISTINCT s_nationkey, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM cells "
            "UNION ALL SELECT c.s_nationkey, c.i, r.given + a.v, c.s_suppkey, c.unit_pos, a.v FROM rec r "
            "JOIN cells c ON c.s_nationkey = r.s_nationkey AND c.i = r.i + 1, "
            "LATERAL (SELECT CASE WHEN c.i = c.n THEN c.lim - r.given ELSE greatest(1, least(c.draw, c.lim - r.given - (c.n - c.i + 1) + 1)) END AS v) a) "
            "SELECT s_suppkey, unit_pos, CAST(alloc AS BIGINT) AS alloc FROM rec WHERE alloc IS NOT NULL")


@oracle("bed_availability")
def _():
    cap = DINT(U('q.avail', 'cell', slot=0), 0, 60)
    return (f"SELECT s_suppkey, unit_pos, disp AS num_camas_disp, mant AS num_camas_mant, CASE WHEN mant > 0 THEN 'Mantenimiento' ELSE '' END AS motivo_indisponibilidad FROM ("
            f"SELECT *, {DINT(U('q.avail', 'cell', slot=2), 0, f'floor(disp * {dbl(C.PCT_MAINTENANCE)})')} AS mant FROM ("
            f"SELECT *, CAST(cap - occ AS BIGINT) AS disp FROM ("
            f"SELECT *, {DINT(U('q.avail', 'cell', slot=1), 0, 'cap')} AS occ FROM (SELECT *, {cap} AS cap FROM ({SUPPLIER_CELLS})))))")


def FILL(stays_sql: str, g1: str, g2: str, sid: str, caps_sql: str, label: str) -> str:
    """Sequential capacity fill as a recursive CTE over stay positions.

    ``stays_sql`` has (g1, g2, sid); ``caps_sql`` has (g1, g2, c0..c3).
    Returns (g1, g2, unit_pos, occupied).
    """
    rem = "[f.r0, f.r1, f.r2, f.r3]"
    av = f"list_filter([0, 1, 2, 3], lambda x: {rem}[x + 1] > 0)"
    pick = f"CASE WHEN len({av}) = 0 THEN NULL ELSE {av}[CAST(floor(s.v * len({av})) AS BIGINT) + 1] END"
    dec = lambda j: f"f.r{j} - CASE WHEN ({pick}) = {j} THEN 1 ELSE 0 END"
    return (f"WITH RECURSIVE st AS (SELECT {g1}, {g2}, {sid}, {U(label, sid, g1, g2, slot=1)} AS v, "
            f"row_number() OVER (PARTITION BY {g1}, {g2} ORDER BY {U(label, sid, g1, g2, slot=0)}, {sid}) AS pos FROM ({stays_sql})), "
            f"caps AS ({caps_sql}), "
            f"fill(g1, g2, pos, r0, r1, r2, r3, pick) AS ("
            f"SELECT DISTINCT st.{g1}, st.{g2}, CAST(0 AS BIGINT), greatest(c0, 0), greatest(c1, 0), greatest(c2, 0), greatest(c3, 0), CAST(NULL AS INTEGER) "
            f"FROM st JOIN caps USING ({g1}, {g2}) "
            f"UNION ALL SELECT f.g1, f.g2, s.pos, {dec(0)}, {dec(1)}, {dec(2)}, {dec(3)}, {pick} FROM fill f "
            f"JOIN st s ON s.{g1} = f.g1 AND s.{g2} = f.g2 AND s.pos = f.pos + 1) "
            f"SELECT g1 AS {g1}, g2 AS {g2}, pick AS unit_pos, CAST(count(*) AS BIGINT) AS occupied FROM fill WHERE pick IS NOT NULL GROUP BY ALL")


@oracle("capacity_fill")
def _():
    stays = (f"WITH stays AS ({STAYS()}), hours AS (SELECT unnest(generate_series({GRID_LO}, {GRID_HI}, INTERVAL 1 HOUR)) AS hour) "
             f"SELECT site, date_sub('hour', {GRID_LO}, hour) AS hour_no, event_id FROM stays JOIN hours ON start <= hour AND \"end\" > hour")
    caps = ("SELECT DISTINCT site, hour_no, " + ", ".join(f"{DINT(U('q.caps', 'site', slot=j), 0, 3)} AS c{j}" for j in range(4))
            + f" FROM ({stays})")
    return FILL(stays, "site", "hour_no", "event_id", caps, "q.fill")


def _visits() -> str:
    lo_h, hi_h = CFG.clinic_hours
    day = "CAST(CAST(ts AS DATE) AS TIMESTAMP)"
    prog = DTS(U("q.visit", "event_id", slot=0), f"{day} + INTERVAL {lo_h} HOUR", f"{day} + INTERVAL {hi_h} HOUR")
    return f"SELECT event_id, {prog} AS prog FROM events"


def VISIT_TIMES(prog: str, u_wait: str, u_shift: str, as_of: str) -> tuple[str, str, str]:
    mean, cap = CFG.wait
    t = f"CAST(least(floor({dbl(-mean)} * ln({dbl(1.0)} - {u_wait})), {dbl(cap)}) AS BIGINT)"
    w = DINT(u_shift, f"-({t})", t)
    sched = f"strftime({prog}, '%H:%M:%S')"
    arr_t = f"CASE WHEN CAST({prog} AS DATE) > {as_of} THEN {sched} ELSE strftime({prog} - to_minutes({w}), '%H:%M:%S') END"
    return sched, arr_t, f"greatest({sched}, {arr_t})"


def STATUS(prog: str, start: str, as_of: str) -> str:
    return (f"CASE WHEN CAST({prog} AS DATE) > {as_of} THEN 'Agendada' WHEN CAST(substr({start}, 1, 2) AS INTEGER) >= 22 THEN 'Cancelada' "
            "ELSE 'Atendida' END")


@oracle("visit_times")
def _():
    s, a, st = VISIT_TIMES("prog", U("q.visit", "event_id", slot=1), U("q.visit", "event_id", slot=2), DATE(EVENTS_AS_OF))
    return f"SELECT event_id, prog, {s} AS hra_cita_programada, {a} AS hra_llegada_paciente, {st} AS hra_inicio_atencion FROM ({_visits()})"


@oracle("visit_status")
def _():
    s, a, st = VISIT_TIMES("prog", U("q.visit", "event_id", slot=1), U("q.visit", "event_id", slot=2), DATE(EVENTS_AS_OF))
    return (f"SELECT event_id, hra_inicio_atencion, {STATUS('prog', 'hra_inicio_atencion', DATE(EVENTS_AS_OF))} AS estado_cita FROM "
            f"(SELECT event_id, prog, {st} AS hra_inicio_atencion FROM ({_visits()}))")


# ----------------------------------------------------------------- tables
def PAC_SQL() -> str:
    k = "pac_id"
    p = CFG.pac
    s1 = (f"SELECT pac_id, {TRUNC_NORMAL('pac.age', k, 45, 15, p['min_age'], p['max_age'])} AS age, "
          f"{DINT(U('pac.a', k, slot=0), 1, len(CFG.cities))} AS id_ciudad_res FROM (SELECT c_custkey + 1 AS pac_id FROM customer)")
    s2 = f"SELECT *, {BIRTH('age', U('pac.a', k, slot=1))} AS fec_nac, {DOC_TYPE('age', 'id_ciudad_res', U('pac.a', k, slot=2))} AS tip_doc FROM ({s1})"
    tip_ins = ELEM(U("pac.b", k, slot=3), arr(p["tips_aseguradoras"]))
    s3 = (f"SELECT *, {DOC_NUM('tip_doc', 'id_ciudad_res', U('pac.a', k, slot=3), U('pac.b', k, slot=0), U('pac.b', k, slot=1))} AS num_doc, "
          f"{WEIGHTED(U('pac.b', k, slot=2), CFG.genders)} AS genero, {tip_ins} AS tip_aseguradora, "
          f"{WEIGHTED(U('pac.c', k, slot=1), CFG.strata)} AS estrato_socioec, "
          f"{DDATE(U('pac.c', k, slot=2), 'greatest(fec_nac, ' + FOUND + ')', ASOF)} AS fec_primer_atencion, "
          f"{BERN(U('pac.c', k, slot=3), C.PCT_ACTIVE_PATIENT)} AS activo FROM ({s2})")
    s4 = f"SELECT *, CASE WHEN tip_aseguradora IS NOT NULL THEN {DINT(U('pac.c', k, slot=0), 1, len(CFG.insurers))} END AS id_eps FROM ({s3})"
    return (f"SELECT pac_id, tip_doc, sha256(num_doc) AS num_doc_hash, fec_nac, genero, id_ciudad_res, {CITIES}[id_ciudad_res] AS ciudad_res, "
            f"tip_aseguradora, id_eps, {INSURERS}[id_eps] AS eps, estrato_socioec, fec_primer_atencion, activo FROM ({s4})")


def MED_SQL(n_sites: str) -> str:
    k = "med_id"
    m = CFG.med
    s1 = (f"SELECT med_id, {DINT(U('med.a', k, slot=0), 1, 20)} AS n_esp, {DINT(U('med.a', k, slot=2), 1, n_sites)} AS id_sede, "
          f"{TRUNC_NORMAL('med.age', k, 45, 15, m['min_age_med'], m['max_age_med'])} AS age FROM (SELECT p_partkey + 1 AS med_id FROM part)")
    s2 = (f"SELECT med_id, especialidad AS esp_principal, {ELEM(U('med.a', k, slot=1), 'subespecialidades')} AS esp_secundaria, id_sede, "
          f"{DDATE(U('med.a', k, slot=3), 'greatest(' + EARLIEST('age', m['min_age_med']) + ', ' + FOUND + ')', ASOF)} AS fec_ingreso, "
          f"{WEIGHTED(U('med.b', k, slot=0), CFG.contracts)} AS tip_contrato, {WEIGHTED(U('med.b', k, slot=1), CFG.shifts)} AS jornada, "
          f"{BERN(U('med.b', k, slot=2), C.PCT_ACTIVE_PHYSICIAN)} AS estado_activo FROM ({s1}) JOIN ({SPEC_VALUES()}) USING (n_esp)")
    return s2


O["table_pac_registro"] = PAC_SQL()
O["table_med_planta"] = MED_SQL(n_of("nation"))


def SEDES_SQL() -> str:
    """Sites for the harness: one per nation; type counts and bed budget scaled to them (largest remainder)."""
    full = CFG.length("red_sedes")
    kinds = ", ".join(f"({i}, {q(t)}, {c})" for i, (t, c) in enumerate(CFG.site_types))
    total = sum(c for _, c in CFG.site_types)
    draw = f"abs(CAST(trunc(CAST(mean AS DOUBLE) + {dbl(C.BED_SD)} * {NORMAL(U('site.beds', 'cell', slot=0), U('site.beds', 'cell', slot=1))}) AS BIGINT))"
    return (
        "WITH RECURSIVE "
        f"sz AS (SELECT n, CAST(floor({CFG.bed_limit} * n / {dbl(full)}) AS BIGINT) AS lim, n * {len(CFG.units)} AS cells FROM (SELECT count(*) AS n FROM nation)), "
        f"cities AS (SELECT * FROM (SELECT id_ciudad, {CITIES}[id_ciudad] AS nom_sede, row_number() OVER (ORDER BY {U('site.city', 'id_ciudad')}, id_ciudad) AS id_sede "
        f"FROM (SELECT CAST(i AS BIGINT) AS id_ciudad FROM range(1, {len(CFG.cities) + 1}) t(i))) WHERE id_sede <= (SELECT n FROM sz)), "
        f"raw AS (SELECT i, tip_sede, c * n / {dbl(total)} AS x FROM (VALUES {kinds}) t(i, tip_sede, c), sz), "
        "part AS (SELECT i, tip_sede, CAST(floor(x) AS BIGINT) AS k, row_number() OVER (ORDER BY x - floor(x) DESC, i) AS r FROM raw), "
        "tc AS (SELECT i, tip_sede, k + CASE WHEN r <= (SELECT n FROM sz) - (SELECT sum(k) FROM part) THEN 1 ELSE 0 END AS n FROM part), "
        "tb AS (SELECT tip_sede, n, sum(n) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS lo FROM tc), "
        "el AS (SELECT tip_sede, CAST(lo + k AS BIGINT) AS e FROM tb, range(0, n) r(k)), "
        f"types AS (SELECT tip_sede, row_number() OVER (ORDER BY {U('site.type', 'e')}, e) AS id_sede FROM el), "
        f"cells AS (SELECT cell, cell + 1 AS ci, cells AS n, lim, {draw} AS draw FROM (SELECT i AS cell, cells, lim, lim // cells AS mean FROM sz, range(0, sz.cells) t(i))), "
        "rec(ci, given, cell, alloc) AS (SELECT CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) "
        "UNION ALL SELECT c.ci, r.given + a.v, c.cell, a.v FROM rec r JOIN cells c ON c.ci = r.ci + 1, "
        "LATERAL (SELECT CASE WHEN c.ci = c.n THEN c.lim - r.given ELSE greatest(1, least(c.draw, c.lim - r.given - (c.n - c.ci + 1) + 1)) END AS v) a), "
        "beds AS (SELECT cell // 4 + 1 AS id_sede, " + ", ".join(f"max(CASE WHEN cell % 4 = {j} THEN alloc END) AS {c}" for j, c in enumerate(CAPS))
        + " FROM rec WHERE alloc IS NOT NULL GROUP BY 1) "
        f"SELECT CAST(id_sede AS BIGINT) AS id_sede, nom_sede, tip_sede, id_ciudad, {COUNTRY('id_ciudad')} AS id_pais, "
        + ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in CAPS)
        + f", {COMPLEXITY('tip_sede')} AS nivel_complejidad FROM cities JOIN types USING (id_sede) JOIN beds USING (id_sede)")


O["table_red_sedes"] = SEDES_SQL()


def ENC_SQL() -> str:
    """Encounters: phase A (27% sample + le pick) and phase B (attempts, ge pick, accept)."""
    n_pac, n_enc = n_of("customer"), n_of("orders")
    n_a = f"CAST(floor({n_pac} * {dbl(C.FIRST_ADMISSION_SHARE)}) AS BIGINT)"
    gap = CFG.max_stay_days + 1
    mean, cap = CFG.wait
    pick_a = PICK(f"SELECT * FROM a0", "id_encuentro", "fec_primer_atencion", "enc.a", "SELECT med_id, fec_ingreso, id_sede, esp_principal FROM med",
                  "med_id", "fec_ingreso", "elig.med", "le", "id_sede, esp_principal")
    pick_b = PICK("SELECT * FROM att1", "t", "fec_ingreso", "enc.b", "SELECT pac_id, fec_primer_atencion FROM pac", "pac_id",
                  "fec_primer_atencion", "elig.pac", "ge", "fec_primer_atencion")
    # attempts until the target: three times the expected number, from the exact acceptance rate
    return (
        f"WITH pac AS ({PAC_SQL()}), med AS ({MED_SQL(n_of('nation'))}), "
        f"a0 AS (SELECT * FROM (SELECT pac_id, fec_primer_atencion, CAST(row_number() OVER (ORDER BY {U('enc.a.pick', 'pac_id')}, pac_id) AS BIGINT) AS id_encuentro FROM pac) "
        f"WHERE id_encuentro <= {n_a}), "
        f"a AS (SELECT id_encuentro, pac_id, med_id, id_sede, esp_principal AS esp_atendida, CAST(fec_primer_atencion AS TIMESTAMP) AS lo, "
        f"CAST(fec_primer_atencion AS TIMESTAMP) + INTERVAL 86399 SECOND AS hi, 'Primera vez' AS tip_consulta FROM ({pick_a})), "
        f"rate AS (SELECT avg((SELECT count(*) FILTER (WHERE p.fec_primer_atencion + {gap} <= {ASOF}) / CAST(greatest(count(*), 1) AS DOUBLE) "
        "FROM pac p WHERE p.fec_primer_atencion >= m.fec_ingreso)) AS p FROM med m), "
        f"att0 AS (SELECT CAST(i AS BIGINT) AS t FROM rate, range(0, CAST(3 * {n_enc} / rate.p AS BIGINT) + 1000) r(i)), "
        f"att1 AS (SELECT t, med_id, fec_ingreso, id_sede, esp_principal FROM (SELECT t, {DINT(U('enc.b', 't', slot=0), 1, n_of('part'))} AS med_id FROM att0) JOIN med USING (med_id)), "
        f"att2 AS (SELECT *, greatest(fec_primer_atencion + {gap}, fec_ingreso) AS fl FROM ({pick_b.replace(U('enc.b', 't'), U('enc.b', 't', slot=1))})), "
        f"b AS (SELECT * FROM (SELECT {n_a} + CAST(row_number() OVER (ORDER BY t) AS BIGINT) AS id_encuentro, pac_id, med_id, id_sede, esp_principal AS esp_atendida, "
        f"CAST(fl AS TIMESTAMP) AS lo, CAST({ASOF} AS TIMESTAMP) + INTERVAL 86399 SECOND AS hi, 'Control' AS tip_consulta FROM att2 "
        f"WHERE pool_size > 0 AND fl <= {ASOF}) WHERE id_encuentro <= {n_enc}), "
        "ab AS (SELECT * FROM a UNION ALL SELECT * FROM b), "
        f"t1 AS (SELECT ab.*, {DTS(U('enc.c', 'id_encuentro', slot=0), 'lo', 'hi')} AS fec_inicio_atencion FROM ab), "
        f"t2 AS (SELECT t1.*, fec_inicio_atencion - to_milliseconds({EXP_MS(U('enc.c', 'id_encuentro', slot=1), mean, cap, 60000)}) AS fec_registro, "
        f"{DTS(U('enc.c', 'id_encuentro', slot=2), 'fec_inicio_atencion', f'fec_inicio_atencion + INTERVAL {CFG.max_stay_days} DAY')} AS fec_egreso FROM t1), "
        f"t3 AS (SELECT t2.*, s.cie10, s.cod_procedimientos, s.vr_facturado FROM t2 LEFT JOIN ({SPEC_VALUES()}) s ON s.especialidad = t2.esp_atendida), "
        f"t4 AS (SELECT t3.*, {ELEM(U('enc.d', 'id_encuentro', slot=0), 'cie10')} AS diag_principal_cie10 FROM t3), "
        f"t5 AS (SELECT t4.*, list_filter(cie10, lambda x: x <> diag_principal_cie10) AS rest FROM t4) "
        "SELECT id_encuentro, pac_id, med_id, id_sede, fec_registro, fec_inicio_atencion, fec_egreso, tip_consulta, esp_atendida, diag_principal_cie10, "
        f"CASE WHEN len(rest) > 0 AND {BERN(U('enc.d', 'id_encuentro', slot=1), C.PCT_SECOND_DIAGNOSIS)} THEN {ELEM(U('enc.d', 'id_encuentro', slot=2), 'rest')} END AS diag_sec1_cie10, "
        f"cod_procedimientos, vr_facturado, CASE WHEN {BERN(U('enc.d', 'id_encuentro', slot=3), C.PCT_PAID)} THEN 'Pagado' ELSE 'No pagado' END AS estado_factura FROM t5")


O["table_hce_encuentros"] = ENC_SQL()


def FAR_SQL() -> str:
    k = "id_dispensacion"
    drugs = ", ".join(f"({i}, {q(c)}, {q(nm)}, CAST({p} AS BIGINT))" for i, (c, nm, p) in enumerate(CFG.drugs, start=1))
    mag, off = CFG.prescription_types[0], CFG.prescription_types[1]
    return (
        f"WITH enc AS ({ENC_SQL()}), ids AS (SELECT l_orderkey * 8 + l_linenumber AS id_dispensacion FROM lineitem), ne AS (SELECT count(*) AS n FROM enc), "
        f"d AS (SELECT id_dispensacion, {DINT(U('far.a', k, slot=0), 1, 'ne.n')} AS id_encuentro, {DINT(U('far.a', k, slot=2), 1, len(CFG.drugs))} AS n_med, "
        f"{DINT(U('far.a', k, slot=3), 1, CFG.max_quantity)} AS cantidad FROM ids, ne), "
        f"drug AS (SELECT * FROM (VALUES {drugs}) t(n_med, cod_medicamento, nombre_medicamento, vr_unitario)) "
        f"SELECT id_dispensacion, id_encuentro, pac_id, id_sede, {DTS(U('far.a', k, slot=1), 'fec_inicio_atencion', 'fec_egreso')} AS fec_dispensacion, "
        f"cod_medicamento, nombre_medicamento, cantidad, vr_unitario, CASE WHEN {BERN(U('far.b', k, slot=0), C.PCT_OFFICIAL_PRESCRIPTION)} THEN {q(off)} ELSE {q(mag)} END AS tip_prescripcion "
        "FROM d JOIN enc USING (id_encuentro) JOIN drug USING (n_med)")


O["table_far_dispensacion"] = FAR_SQL()


def CIT_SQL() -> str:
    n_pac, n_cit = n_of("customer"), n_of("events")
    n_a = f"({n_pac} - CAST(floor({n_pac} * {dbl(C.FIRST_ADMISSION_SHARE)}) AS BIGINT))"
    lo_h, hi_h = CFG.clinic_hours
    lead_mean, lead_cap = CFG.booking_lead
    pick_a = PICK("SELECT * FROM a0", "id_cita", "fec_primer_atencion", "cit.a", "SELECT med_id, fec_ingreso, id_sede, esp_principal FROM med",
                  "med_id", "fec_ingreso", "elig.med", "le", "id_sede, esp_principal")
    pick_b = PICK("SELECT * FROM att1", "t", "fec_ingreso", "cit.b", "SELECT pac_id, fec_primer_atencion FROM pac", "pac_id",
                  "fec_primer_atencion", "elig.pac", "ge", "fec_primer_atencion")
    s, a, st = VISIT_TIMES("fec_cita_programada", U("cit.c", "id_cita", slot=2), U("cit.c", "id_cita", slot=3), ASOF)
    return (
        f"WITH pac AS ({PAC_SQL()}), med AS ({MED_SQL(n_of('nation'))}), enc AS ({ENC_SQL()}), "
        "a0 AS (SELECT pac_id, fec_primer_atencion, CAST(row_number() OVER (ORDER BY pac_id) AS BIGINT) AS id_cita FROM pac "
        "WHERE pac_id NOT IN (SELECT pac_id FROM enc WHERE tip_consulta = 'Primera vez')), "
        f"a AS (SELECT id_cita, pac_id, med_id, id_sede, esp_principal AS esp_solicitada, CAST(fec_primer_atencion AS TIMESTAMP) + INTERVAL {lo_h} HOUR AS lo, "
        f"CAST(fec_primer_atencion AS TIMESTAMP) + INTERVAL {hi_h} HOUR AS hi, 'Primera vez' AS tip_cita FROM ({pick_a})), "
        f"rate AS (SELECT avg((SELECT count(*) FILTER (WHERE p.fec_primer_atencion + 1 <= {ASOF}) / CAST(greatest(count(*), 1) AS DOUBLE) "
        "FROM pac p WHERE p.fec_primer_atencion >= m.fec_ingreso)) AS p FROM med m), "
        f"att0 AS (SELECT CAST(i AS BIGINT) AS t FROM rate, range(0, CAST(3 * {n_cit} / rate.p AS BIGINT) + 1000) r(i)), "
        f"att1 AS (SELECT t, med_id, fec_ingreso, id_sede, esp_principal FROM (SELECT t, {DINT(U('cit.b', 't', slot=0), 1, n_of('part'))} AS med_id FROM att0) JOIN med USING (med_id)), "
        f"att2 AS (SELECT *, fec_primer_atencion + 1 AS fl FROM ({pick_b.replace(U('cit.b', 't'), U('cit.b', 't', slot=1))})), "
        f"b AS (SELECT * FROM (SELECT {n_a} + CAST(row_number() OVER (ORDER BY t) AS BIGINT) AS id_cita, pac_id, med_id, id_sede, esp_principal AS esp_solicitada, "
        f"CAST(fl AS TIMESTAMP) + INTERVAL {lo_h} HOUR AS lo, CAST({ASOF} AS TIMESTAMP) + INTERVAL 86399 SECOND AS hi, 'Control' AS tip_cita FROM att2 "
        f"WHERE pool_size > 0 AND fl <= {ASOF}) WHERE id_cita <= {n_cit}), "
        "ab AS (SELECT * FROM a UNION ALL SELECT * FROM b), "
        f"t1 AS (SELECT ab.*, {DTS(U('cit.c', 'id_cita', slot=0), 'lo', 'hi')} AS fec_cita_programada FROM ab), "
        f"t2 AS (SELECT t1.*, fec_cita_programada - to_milliseconds({EXP_MS(U('cit.c', 'id_cita', slot=1), lead_mean, lead_cap, 3600000)}) AS fec_agendamiento, "
        f"{s} AS hra_cita_programada, {a} AS hra_llegada_paciente, {st} AS hra_inicio_atencion FROM t1) "
        "SELECT id_cita, pac_id, med_id, id_sede, fec_agendamiento, fec_cita_programada, hra_cita_programada, hra_llegada_paciente, hra_inicio_atencion, "
        f"esp_solicitada, tip_cita, {STATUS('fec_cita_programada', 'hra_inicio_atencion', ASOF)} AS estado_cita FROM t2")


O["table_age_citas"] = CIT_SQL()


def GCM_SQL() -> str:
    units = CFG.units
    n = n_of("nation")
    hours = f"CAST(floor({n_of('events')} / ({n} * {len(units)})) + 1 AS BIGINT)"
    last = f"(CAST({ASOF} AS TIMESTAMP) + INTERVAL 23 HOUR)"
    stays = ("SELECT hour_idx, id_sede, id_encuentro FROM enc JOIN hours ON fec_inicio_atencion <= hour AND fec_egreso > hour")
    caps = "SELECT DISTINCT hour_idx, id_sede, " + ", ".join(f"{c} AS c{j}" for j, c in enumerate(CAPS)) + " FROM act JOIN sedes USING (id_sede)"
    fill = FILL("SELECT * FROM act", "hour_idx", "id_sede", "id_encuentro", caps, "bed")
    return (
        f"WITH RECURSIVE enc AS ({ENC_SQL()}), sedes AS ({SEDES_SQL()}), "
        f"hours AS (SELECT i AS hour_idx, {last} - to_hours(CAST({hours} - 1 - i AS BIGINT)) AS hour FROM range(0, {hours}) t(i)), "
        f"act AS ({stays}), occ AS ({fill}), "
        f"grid AS (SELECT hour_idx * {n} * {len(units)} + (s - 1) * {len(units)} + u + 1 AS id_registro_cama, hour_idx, hour, CAST(s AS BIGINT) AS id_sede, u AS unit_pos "
        f"FROM hours, range(1, {n} + 1) a(s), range(0, {len(units)}) b(u)), "
        f"cells AS (SELECT grid.*, CAST(coalesce(occ.occupied, 0) AS BIGINT) AS occ, "
        f"[{', '.join('sedes.' + c for c in CAPS)}][grid.unit_pos + 1] AS cap FROM grid LEFT JOIN occ USING (hour_idx, id_sede, unit_pos) JOIN sedes USING (id_sede)), "
        f"c2 AS (SELECT *, CAST(cap - occ AS BIGINT) AS disp FROM cells), "
        f"c3 AS (SELECT *, {DINT(U('bed.maint', 'id_registro_cama'), 0, f'floor(disp * {dbl(C.PCT_MAINTENANCE)})')} AS mant FROM c2) "
        f"SELECT CAST(id_registro_cama AS BIGINT) AS id_registro_cama, id_sede, {arr(units)}[unit_pos + 1] AS tip_unidad, hour AS fec_hora_registro, "
        "occ AS num_camas_ocupadas, disp AS num_camas_disp, mant AS num_camas_mant, CASE WHEN mant > 0 THEN 'Mantenimiento' ELSE '' END AS motivo_indisponibilidad FROM c3")


O["table_gcm_camas"] = GCM_SQL()


def oracle_sql() -> dict[str, str]:
    return dict(O)
