"""Configuration faults are found before the first job, all at once."""

import copy
import datetime as dt

import pytest
from small import small_config

from clinicgen.config import DEFAULT_CONFIG
from clinicgen.plans.pipeline import run
from clinicgen.validate import BadConfig, problems

AS_OF = dt.date(2026, 1, 1)


def _with(**changes):
    doc = copy.deepcopy(DEFAULT_CONFIG)
    for place, v in changes.items():
        *path, last = place.split("__")
        at = doc
        for p in path:
            at = at[p]
        if v is None:
            del at[last]
        else:
            at[last] = v
    return doc


def test_good_documents():
    assert problems(DEFAULT_CONFIG, AS_OF) == []
    assert problems(small_config().doc, AS_OF) == []


@pytest.mark.parametrize("changes,place", [
    ({"info": None}, "info: section is missing"),
    ({"parametros__seed": "x"}, "parametros.seed"),
    ({"parametros__hr_max_consultas": 24}, "parametros.hr_max_consultas"),
    ({"parametros__hr_min_consultas": 23}, "parametros.hr_min_consultas: 23 is above"),
    ({"info__fecha_fundacion": "1987-02-30"}, "info.fecha_fundacion"),
    ({"info__fecha_fundacion": "2026-01-02"}, "after the reference date"),
    ({"tablas__age_citas_len": 0}, "tablas.age_citas_len: must be at least 1"),
    ({"tablas__age_citas_cols": ["a", "a"]}, "names must differ"),
    ({"pac_registro__generos__null": -0.1}, "pac_registro.generos: weights"),
    ({"pac_registro__estratos": {"Bajo": 0}}, "add up to 0"),
    ({"pac_registro__ciudades": {"1": "a", "3": "b"}}, "missing ['2']"),
    ({"med_planta__min_age_med": 71}, "med_planta.min_age_med"),
    ({"red_sedes__tips_unidades": ["a", "b", "c", "d", "e"]}, "capacity columns"),
    ({"red_sedes__tips_sedes__Hospital de alta complejidad": 4}, "add up to tablas.red_sedes_len"),
    ({"tablas__red_sedes_len": 500}, "as many cities"),
    ({"red_sedes__camas_limit": 100}, "fewer than one per site"),
    ({"especialidades__2": {"especialidad": "New", "subespecialidades": []}}, "cie10.New"),
    ({"cie10__Alergologia": ["J30", "J30"]}, "two different diagnoses"),
    ({"procedimientos__Alergologia": None}, "procedimientos.Alergologia"),
    ({"vrs__2726": None}, "vrs.2726"),
    ({"medicamentos__MED001__precio": "dear"}, "medicamentos.MED001.precio"),
    ({"otros__tips_prescripcion": ["Magistral"]}, "two kinds"),
])
def test_each_fault_is_named(changes, place):
    found = problems(_with(**changes), AS_OF)
    assert any(place in f for f in found), found


def test_all_faults_at_once_and_before_any_file(spark, tmp_path):
    cfg = small_config()
    doc = copy.deepcopy(cfg.doc)
    doc["parametros"]["seed"] = "x"
    del doc["vrs"]
    doc["red_sedes"]["camas_limit"] = 1
    with pytest.raises(BadConfig) as e:
        run(spark, type(cfg)(doc, cfg.as_of), str(tmp_path / "out"), {"med_planta": "csv", "gcm_camas": "csv", "far_dispensacion": "csv"})
    assert len(e.value.faults) >= 3 and "parametros.seed" in str(e.value) and "vrs." in str(e.value) and "camas_limit" in str(e.value)
    assert not (tmp_path / "out").exists()
    assert problems([], AS_OF) == ["the document must be an object"]


def test_file_sizes_follow_the_data(spark, tmp_path):
    from clinicgen.sources import sinks as SK

    def sizes(name):
        return [p.stat().st_size for p in (tmp_path / name).glob("part-*")]

    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst")
    many = spark.range(0, 400_000, 1, 64).selectExpr("id", "sha2(cast(id AS string), 256) AS h")  # about 30 MB, from 64 tasks
    SK.write_table(many, str(tmp_path / "large"), "parquet", file_bytes=4 << 20)
    SK.write_table(many.limit(100).repartition(50), str(tmp_path / "small"), "csv")
    one, large = sizes("small"), sizes("large")
    assert len(one) == 1 and 3 <= len(large) <= 16
    assert all((4 << 20) / 4 <= n <= 2 * (4 << 20) for n in large)
    assert spark.read.parquet(str(tmp_path / "large")).count() == 400_000
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.parallelismFirst") == before
