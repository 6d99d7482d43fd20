"""Rule columns of the generated tables, as Spark SQL expressions.

Arguments are SQL snippets (column names or expressions); results are SQL
text for ``selectExpr`` (see ``draws``).
"""

from __future__ import annotations

import datetime as dt

from clinicgen import config as C
from clinicgen.functions import draws as D
from clinicgen.functions.draws import lit_str, s


def lit_date(d: dt.date) -> str:
    return f"DATE'{d.isoformat()}'"


def day_start(d: str) -> str:
    """Midnight of a date as timestamp_ntz."""
    return f"CAST({d} AS TIMESTAMP_NTZ)"


def at_hour(d: str, hour: int) -> str:
    return f"timestampadd(HOUR, {hour}, {day_start(d)})"


def day_end(d: str) -> str:
    """23:59:59 of a date (whole seconds)."""
    return f"timestampadd(SECOND, 86399, {day_start(d)})"


def pseudonymize(x: str) -> str:
    """SHA-256 hex of the text form (UTF-8) (2.8.1)."""
    return f"sha2(CAST({x} AS STRING), 256)"


def birth_date(as_of: str, age: str, uc: str) -> str:
    """Same calendar day ``age`` years before ``as_of``, minus 0..364 days (2.8.2).

    ``add_months`` clamps Feb 29 to Feb 28 instead of failing.
    """
    return f"date_sub(add_months({as_of}, CAST(-12 * {s(age)} AS INT)), CAST(floor({uc} * 365) AS INT))"


def earliest_hire(as_of: str, age: str, min_age: int) -> str:
    """The day a physician of ``age`` turned ``min_age`` (2.8.3)."""
    return f"add_months({as_of}, CAST(-12 * ({s(age)} - {min_age}) AS INT))"


def country_band(city_id: str) -> str:
    """Country from the city id bands (2.8.5)."""
    (b1, c1), (b2, c2), (_, c3) = C.COUNTRY_BANDS
    return f"CASE WHEN {s(city_id)} <= {b1} THEN {lit_str(c1)} WHEN {s(city_id)} <= {b2} THEN {lit_str(c2)} ELSE {lit_str(c3)} END"


def complexity(site_type: str) -> str:
    """Complexity level from the site type (2.8.6)."""
    whens = " ".join(f"WHEN {s(site_type)} = {lit_str(t)} THEN {lit_str(v)}" for t, v in C.COMPLEXITY.items())
    return f"CASE {whens} ELSE {lit_str(C.COMPLEXITY_DEFAULT)} END"


def doc_type(age: str, city_id: str, u_doc: str, cfg: C.Config) -> str:
    """Minor's id below age 7, else a uniform pick from the country's list (2.8.4)."""
    (b1, _), (b2, _), _ = C.COUNTRY_BANDS
    p = cfg.pac
    return (f"CASE WHEN {s(age)} < {C.MINOR_AGE} THEN {lit_str(C.MINOR_DOC)} "
            f"WHEN {s(city_id)} <= {b1} THEN {D.draw_element(u_doc, p['docs_col'])} "
            f"WHEN {s(city_id)} <= {b2} THEN {D.draw_element(u_doc, p['docs_ecu'])} "
            f"ELSE {D.draw_element(u_doc, p['docs_peru'])} END")


def doc_number(tip_doc: str, city_id: str, u_num: str, u_p1: str, u_p2: str, cfg: C.Config) -> str:
    """Document number text: 10 digits up to the Ecuador band, else 8; passports override (2.4.15)."""
    (_, _), (b2, _), _ = C.COUNTRY_BANDS
    digits = f"CASE WHEN {s(city_id)} <= {b2} THEN {int(cfg.pac['ext_gral'])} ELSE {int(cfg.pac['ext_peru'])} END"
    return (f"CASE WHEN {s(tip_doc)} = {lit_str(C.PASSPORT_DOC)} THEN {D.passport_number(u_p1, u_p2)} "
            f"ELSE {D.random_digits(u_num, digits)} END")


def insurer(u_type: str, u_id: str, cfg: C.Config, type_col: str = "tip_aseguradora") -> tuple[str, str]:
    """Insurer type (nullable) and insurer id, NULL when there is no type (2.8.7).

    The id refers to ``type_col`` (the already projected type column).
    """
    tip = D.draw_element(u_type, cfg.pac["tips_aseguradoras"])
    id_eps = f"CASE WHEN {type_col} IS NOT NULL THEN {D.draw_int(u_id, 1, len(cfg.insurers))} END"
    return tip, id_eps


def control_floor(first_visit: str, hire: str, gap_days: int) -> str:
    """Earliest follow-up date: first visit + gap, not before the hire date (2.8.15)."""
    return f"greatest(date_add({s(first_visit)}, {gap_days}), {s(hire)})"


def time_of_day(ts: str) -> str:
    return f"date_format({ts}, 'HH:mm:ss')"


def visit_times(scheduled: str, as_of: str, u_wait: str, u_shift: str, cfg: C.Config) -> tuple[str, str, str]:
    """Scheduled / arrival / start times of day (2.8.10-13).

    Arrival is ``scheduled - w`` minutes with ``w`` uniform in [-t, t] and
    ``t = min(int(Exp(mean)), cap)``; an appointment after ``as_of`` is
    "arrived" on time. Start is the later of the two *times of day*
    (strings compare like times), so a late arrival past midnight wraps.
    """
    mean, cap = cfg.wait
    t = f"CAST(least(floor({s(-float(mean))} * ln({s(1.0)} - {u_wait})), {s(float(cap))}) AS BIGINT)"
    w = D.draw_int(u_shift, f"-{t}", t)
    sched_t = time_of_day(scheduled)
    arr_t = (f"CASE WHEN to_date({scheduled}) > {as_of} THEN {sched_t} "
             f"ELSE {time_of_day(f'timestampadd(MINUTE, -{w}, {scheduled})')} END")
    start_t = f"greatest({sched_t}, {arr_t})"
    return sched_t, arr_t, start_t


def visit_status(scheduled: str, start_t: str, as_of: str) -> str:
    """Booked if in the future, cancelled if starting at 22:00 or later, else attended (2.8.14)."""
    booked, cancelled, attended = C.APPOINTMENT_STATES
    return (f"CASE WHEN to_date({scheduled}) > {as_of} THEN {lit_str(booked)} "
            f"WHEN CAST(substring({start_t}, 1, 2) AS INT) >= {C.CANCEL_HOUR} THEN {lit_str(cancelled)} "
            f"ELSE {lit_str(attended)} END")
