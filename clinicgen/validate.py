"""Checks of a configuration document before the first job: all faults at once, each with its place.

The job reads every section at its start and fails at once; here sections are read where a table is built, so a fault would
show after hours of work on the tables before it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import Any

TABLES = ("pac_registro", "med_planta", "red_sedes", "hce_encuentros", "gcm_camas", "far_dispensacion", "age_citas")
MOST_UNITS = 4  # capacity columns of a site

Check = Callable[[Any], str | None]


def whole(least: int | None = None) -> Check:
    def check(v: Any) -> str | None:
        if isinstance(v, bool) or not isinstance(v, (int, str)) or (isinstance(v, str) and not v.lstrip("-").isdigit()):
            return f"must be a whole number, is {v!r}"
        return f"must be at least {least}, is {v}" if least is not None and int(v) < least else None
    return check


def positive(v: Any) -> str | None:
    return None if isinstance(v, (int, float)) and not isinstance(v, bool) and v > 0 else f"must be a number above 0, is {v!r}"


def texts(v: Any) -> str | None:
    return None if isinstance(v, list) and v and all(isinstance(x, str) for x in v) else "must be a list of one or more texts"


def texts_or_null(v: Any) -> str | None:
    return None if isinstance(v, list) and v and all(x is None or isinstance(x, str) for x in v) else "must be a list of one or more texts or nulls"


def distinct_texts(v: Any) -> str | None:
    return texts(v) or (None if len(set(v)) == len(v) else "names must differ")


def weights(v: Any) -> str | None:
    if not isinstance(v, dict) or not v:
        return "must map one or more categories to weights"
    bad = [k for k, w in v.items() if isinstance(w, bool) or not isinstance(w, (int, float)) or w < 0]
    if bad:
        return f"weights must be numbers from 0 on; not so for {bad}"
    return None if sum(v.values()) > 0 else "weights add up to 0"


def numbered(v: Any) -> str | None:
    if not isinstance(v, dict) or not v:
        return "must map 1, 2, ... to entries"
    missing = [str(i) for i in range(1, len(v) + 1) if str(i) not in v]
    return f"keys must be 1 to {len(v)}; missing {missing[:5]}" if missing else None


def date(v: Any) -> str | None:
    try:
        dt.date.fromisoformat(v)
        return None
    except (TypeError, ValueError):
        return f"must be a date YYYY-MM-DD, is {v!r}"


SECTIONS: dict[str, dict[str, Check]] = {
    "parametros": {"seed": whole(), "max_dias_atencion": whole(0), "hr_min_consultas": whole(0), "hr_max_consultas": whole(0), "t_reser_consulta_mean": positive,
                   "t_reser_consulta_limit": positive, "max_intentos": whole(1)},
    "info": {"t_consulta_externa_mean": positive, "t_consulta_externa_limit": positive, "fecha_fundacion": date},
    "tablas": {**{f"{t}_len": whole(1) for t in TABLES}, **{f"{t}_cols": distinct_texts for t in TABLES}},
    "pac_registro": {"docs_col": texts, "docs_ecu": texts, "docs_peru": texts, "ext_peru": whole(1), "ext_gral": whole(1), "generos": weights, "tips_aseguradoras": texts_or_null,
                     "estratos": weights, "min_age": whole(0), "max_age": whole(0), "ciudades": numbered, "eps_list": numbered},
    "med_planta": {"tips_contratos": weights, "tips_jornadas": weights, "min_age_med": whole(0), "max_age_med": whole(0)},
    "red_sedes": {"tips_sedes": weights, "tips_unidades": distinct_texts, "camas_limit": whole(1)},
    "otros": {"max_cant_med": whole(1), "tips_prescripcion": texts},
}


def problems(doc: Any, as_of: dt.date) -> list[str]:
    """What is wrong with a configuration document, one line per place; none: every builder finds what it reads."""
    if not isinstance(doc, dict):
        return ["the document must be an object"]
    out: list[str] = []
    good: set[str] = set()
    for section, entries in SECTIONS.items():
        if not isinstance(doc.get(section), dict):
            out.append(f"{section}: section is missing")
            continue
        for name, check in entries.items():
            place = f"{section}.{name}"
            fault = check(doc[section][name]) if name in doc[section] else "is missing"
            out += [f"{place}: {fault}"] if fault else []
            good |= set() if fault else {place}

    def both(*places: str) -> bool:
        return all(p in good for p in places)

    def value(place: str) -> Any:
        section, name = place.split(".")
        return doc[section][name]

    for low, high in (("parametros.hr_min_consultas", "parametros.hr_max_consultas"), ("pac_registro.min_age", "pac_registro.max_age"),
                      ("med_planta.min_age_med", "med_planta.max_age_med")):
        if both(low, high) and int(value(low)) > int(value(high)):
            out.append(f"{low}: {value(low)} is above {high} ({value(high)})")
    if both("parametros.hr_max_consultas") and int(value("parametros.hr_max_consultas")) > 23:
        out.append(f"parametros.hr_max_consultas: must be an hour up to 23, is {value('parametros.hr_max_consultas')}")
    if both("info.fecha_fundacion") and dt.date.fromisoformat(value("info.fecha_fundacion")) > as_of:
        out.append(f"info.fecha_fundacion: {value('info.fecha_fundacion')} is after the reference date {as_of}")
    sites, kinds, units, cities = "tablas.red_sedes_len", "red_sedes.tips_sedes", "red_sedes.tips_unidades", "pac_registro.ciudades"
    if both(sites, kinds):
        n = sum(value(kinds).values())
        if any(v != int(v) for v in value(kinds).values()) or n != int(value(sites)):
            out.append(f"{kinds}: must be whole numbers of sites that add up to {sites} ({value(sites)}), not {n}")
    if both(sites, cities) and int(value(sites)) > len(value(cities)):
        out.append(f"{sites}: {value(sites)} sites need as many cities; {cities} has {len(value(cities))}")
    if both(units) and len(value(units)) > MOST_UNITS:
        out.append(f"{units}: {len(value(units))} units, but a site has {MOST_UNITS} capacity columns")
    if both(sites, units, "red_sedes.camas_limit") and int(value("red_sedes.camas_limit")) < int(value(sites)) * len(value(units)):
        out.append(f"red_sedes.camas_limit: {value('red_sedes.camas_limit')} beds are fewer than one per site and unit")
    if both("otros.tips_prescripcion") and len(value("otros.tips_prescripcion")) < 2:
        out.append("otros.tips_prescripcion: two kinds of prescription are needed")
    return out + _specialties(doc) + _drugs(doc)


def _specialties(doc: dict) -> list[str]:
    """Every specialty needs sub-specialties, diagnoses, a procedure and its price."""
    fault = numbered(doc.get("especialidades"))
    if fault:
        return [f"especialidades: {fault}"]
    out, names = [], []
    for i, e in doc["especialidades"].items():
        name = e.get("especialidad") if isinstance(e, dict) else None
        if not isinstance(name, str):
            out.append(f"especialidades.{i}: especialidad is missing")
            continue
        names.append(name)
        subs = e.get("subespecialidades")
        if not isinstance(subs, list) or not subs:
            out.append(f"especialidades.{i}.subespecialidades: must be a list of one or more")
        codes = (doc.get("cie10") or {}).get(name)
        if texts(codes):
            out.append(f"cie10.{name}: {texts(codes)}")
        elif len(set(codes)) < 2:
            out.append(f"cie10.{name}: two different diagnoses are needed")
        procedure = (doc.get("procedimientos") or {}).get(name)
        if not isinstance(procedure, str):
            out.append(f"procedimientos.{name}: is missing")
        elif whole(0)((doc.get("vrs") or {}).get(procedure)):
            out.append(f"vrs.{procedure}: {whole(0)((doc.get('vrs') or {}).get(procedure))}")
    if len(set(names)) < len(names):
        out.append("especialidades: names must differ")
    return out


def _drugs(doc: dict) -> list[str]:
    drugs = doc.get("medicamentos")
    if not isinstance(drugs, dict) or not drugs:
        return ["medicamentos: must map one or more codes to drugs"]
    out = []
    for code, d in drugs.items():
        if not isinstance(d, dict) or not isinstance(d.get("nombre"), str):
            out.append(f"medicamentos.{code}.nombre: is missing")
        elif whole(0)(d.get("precio")):
            out.append(f"medicamentos.{code}.precio: {whole(0)(d.get('precio'))}")
    return out


class BadConfig(ValueError):
    """A configuration document with faults, all of which it lists."""

    def __init__(self, faults: list[str]) -> None:
        super().__init__("configuration: " + "; ".join(faults))
        self.faults = faults


def require_valid(doc: Any, as_of: dt.date) -> None:
    faults = problems(doc, as_of)
    if faults:
        raise BadConfig(faults)
