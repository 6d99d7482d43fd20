"""Table builders: invariants, determinism (V17), policies, sinks."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from clinicgen.plans import tables as TB
from clinicgen.plans.checks import check_all
from clinicgen.plans.pipeline import build_all, write_all
from clinicgen.sources import sinks as SK
from small import small_config


@pytest.fixture(scope="module")
def built(spark):
    cfg = small_config()
    return cfg, build_all(spark, cfg, empty_pool="null")


def test_invariants_hold(built):
    cfg, tables = built
    pac, med = tables["pac_registro"], tables["med_planta"]
    early = pac.filter(F.col("fec_primer_atencion") < med.agg(F.min("fec_ingreso")).first()[0]).count()
    bad = {k: v for k, v in check_all(cfg, tables).items() if v}
    # nothing but the first visits that no physician could take, and those are all reported (in dispensing, once per line)
    assert set(bad) <= {"V0_keys_not_null_hce_encuentros", "V0_keys_not_null_age_citas", "V0_keys_not_null_far_dispensacion"}
    assert bad.get("V0_keys_not_null_hce_encuentros", 0) + bad.get("V0_keys_not_null_age_citas", 0) == early


def test_checks_see_bad_keys(built):
    cfg, tables = built
    cit = tables["age_citas"]
    broken = cit.withColumn("med_id", F.when(F.col("id_cita") == 5, None).when(F.col("id_cita") == 6, 10 ** 9).otherwise(F.col("med_id")))
    before, after = check_all(cfg, tables), check_all(cfg, {**tables, "age_citas": broken})
    assert after["V0_keys_not_null_age_citas"] == before["V0_keys_not_null_age_citas"] + 1
    assert after["V0_med_id_exists_age_citas"] == before["V0_med_id_exists_age_citas"] + 1


def test_schemas_follow_configured_columns(built):
    cfg, tables = built
    for name, df in tables.items():
        assert df.columns == cfg.columns(name), name
    types = dict(tables["hce_encuentros"].dtypes)
    assert types["fec_registro"] == "timestamp_ntz" and types["vr_facturado"] == "bigint"
    assert dict(tables["age_citas"].dtypes)["hra_inicio_atencion"] == "string"


def test_capacity_really_binds(built):
    # the small budget leaves most cells at one bed: the fill must drop stays
    _, tables = built
    full = tables["gcm_camas"].filter("num_camas_disp = 0").count()
    assert full > 0


def _digest(df):
    rows = sorted(repr(tuple(r)) for r in df.collect())
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


def test_same_seed_same_tables_whatever_the_partitioning(spark, built):
    cfg, tables = built
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = build_all(spark, cfg, empty_pool="null")
        assert {k: _digest(v) for k, v in again.items()} == {k: _digest(v) for k, v in tables.items()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_as_of_moves_the_data(spark):
    a = TB.build_pac_registro(spark, small_config(dt.date(2026, 1, 1)))
    b = TB.build_pac_registro(spark, small_config(dt.date(2025, 6, 30)))
    assert a.agg(F.max("fec_primer_atencion")).first()[0] <= dt.date(2026, 1, 1)
    assert b.agg(F.max("fec_primer_atencion")).first()[0] <= dt.date(2025, 6, 30)


def test_appointment_reject_cap(spark, built):
    cfg, tables = built
    cit = TB.build_age_citas(spark, cfg, tables["pac_registro"], tables["med_planta"], tables["hce_encuentros"], max_rejects=1, empty_pool="null")
    n = cit.count()
    n_a = cfg.length("pac_registro") - int(cfg.length("pac_registro") * 0.27)
    assert n_a <= n <= cfg.length("age_citas")
    agg = cit.agg(F.min("id_cita"), F.max("id_cita"), F.countDistinct("id_cita")).first()
    assert tuple(agg) == (1, n, n)


def test_empty_pool_policy(spark, caplog):
    cfg = small_config()
    pac = TB.build_pac_registro(spark, cfg)
    # every physician hired on as_of: no patient first seen earlier has an eligible one
    med = TB.build_med_planta(spark, cfg).withColumn("fec_ingreso", F.lit(cfg.as_of))
    few = cfg.with_lengths(hce_encuentros=540)
    enc = TB.build_hce_encuentros(spark, few, pac, med, empty_pool="null")
    n = pac.filter(F.col("fec_primer_atencion") < F.lit(cfg.as_of)).count()
    assert f"{n} patients" in caplog.text
    assert enc.count() == 540
    assert enc.filter("med_id IS NULL").count() == enc.filter(f"to_date(fec_inicio_atencion) < DATE'{cfg.as_of}'").count()
    with pytest.raises(ValueError, match=f"{n} patients without an eligible physician"):
        TB.build_hce_encuentros(spark, few, pac, med)
    with pytest.raises(ValueError, match="empty_pool"):
        TB.build_hce_encuentros(spark, few, pac, med, empty_pool="drop")


def test_dispensing_reaches_every_encounter(spark):
    """More first admissions than encounters asked for: all are kept, and any of them can be dispensed to."""
    cfg = small_config().with_lengths(hce_encuentros=100, far_dispensacion=20_000)
    pac, med = TB.build_pac_registro(spark, cfg), TB.build_med_planta(spark, cfg)
    enc = TB.build_hce_encuentros(spark, cfg, pac, med, empty_pool="null")
    far = TB.build_far_dispensacion(spark, cfg, enc)
    assert far.agg(F.min("id_encuentro"), F.max("id_encuentro"), F.countDistinct("id_encuentro")).first() == (1, 540, 540)
    assert far.count() == 20_000


def test_write_all_round_trip(spark, built, tmp_path):
    _, tables = built
    small = {k: tables[k] for k in ("pac_registro", "red_sedes")}
    paths = write_all(small, str(tmp_path), formats={"pac_registro": "parquet"})
    assert paths["red_sedes"].endswith("red_sedes/data")
    for name, df in small.items():
        back = SK.read_table(spark, paths[name], SK.TABLE_FORMATS[name], df.schema)
        assert _digest(back) == _digest(df), name
    # csv: NULL and "" stay apart, no header
    assert spark.read.text(paths["red_sedes"]).count() == small["red_sedes"].count()


def test_csv_null_vs_empty(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "ñandú"), (2, "", "x")], "i long, a string, b string")
    SK.write_table(df, str(tmp_path / "t"), "csv")
    SK.write_table(df, str(tmp_path / "t"), "csv")  # overwrite twice
    back = SK.read_table(spark, str(tmp_path / "t"), "csv", df.schema).orderBy("i").collect()
    assert [tuple(r) for r in back] == [(1, None, "ñandú"), (2, "", "x")]


def test_avro_sink(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "i long, s string")
    if not SK.avro_available(spark):
        with pytest.raises(SK.AvroUnavailable):
            SK.write_table(df, str(tmp_path / "a"), "avro")
        pytest.skip("spark-avro module not on the classpath: avro round trip not run")
    SK.write_table(df, str(tmp_path / "a"), "avro")
    assert SK.read_table(spark, str(tmp_path / "a"), "avro", df.schema).collect() == df.collect()


def test_load_config_through_spark(spark, tmp_path):
    import json

    from clinicgen.config import DEFAULT_CONFIG, Config, load_config
    path = tmp_path / "conf.json"
    path.write_text(json.dumps(DEFAULT_CONFIG, indent=2, ensure_ascii=False))
    doc = load_config(spark, str(path))
    cfg = Config(doc)
    assert doc == DEFAULT_CONFIG
    assert cfg.seed == 82 and len(cfg.cities) == 168 and len(cfg.insurers) == 18 and len(cfg.specialties) == 20
    assert (None, 0.05) in cfg.genders  # the "null" key is a NULL category
    assert sum(n for _, n in cfg.site_types) == cfg.length("red_sedes")


def test_table_paths_and_formats():
    assert SK.table_path("s3a://b/base/", "age_citas") == "s3a://b/base/age_citas/data"
    assert SK.TABLE_FORMATS == {"pac_registro": "parquet", "med_planta": "avro", "red_sedes": "csv", "hce_encuentros": "parquet",
                                "gcm_camas": "avro", "far_dispensacion": "avro", "age_citas": "parquet"}


def test_run_writes_all_and_releases_intermediates(spark, tmp_path):
    import os

    from clinicgen.plans.pipeline import run
    cfg = small_config().with_lengths(pac_registro=300, med_planta=200, hce_encuentros=400, far_dispensacion=300, age_citas=300)
    formats = {"med_planta": "parquet", "gcm_camas": "parquet", "far_dispensacion": "parquet"}  # no avro module here
    from clinicgen.session import ensure_checkpoint_dir, scratch_run
    tables = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    before = set(os.listdir(tables))
    with scratch_run(spark):  # another run in between: each deletes its own tables alone
        from clinicgen.session import cut_lineage
        other = cut_lineage(spark.range(5), "other")
        paths = run(spark, cfg, str(tmp_path), formats=formats, empty_pool="null")
        assert other.count() == 5
    assert sorted(paths) == sorted(SK.TABLE_FORMATS)
    with pytest.raises(ValueError, match="patients without"):
        run(spark, cfg.with_lengths(med_planta=3), str(tmp_path / "x"), formats=formats)
    assert set(os.listdir(tables)) == before and not os.path.exists(tmp_path / "x")
    with pytest.raises(ValueError, match="base"):
        run(spark, cfg, "")
    if not SK.avro_available(spark):
        with pytest.raises(SK.AvroUnavailable):
            run(spark, cfg, str(tmp_path / "y"))
        assert not os.path.exists(tmp_path / "y")  # refused before the first write
    for name, p in paths.items():
        assert os.path.isdir(p), name
    back = spark.read.parquet(paths["hce_encuentros"])
    assert back.count() == 400 and back.columns == cfg.columns("hce_encuentros")


def test_daylight_saving_zone_is_refused(spark):
    from clinicgen.session import require_fixed_offset_zone
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        with pytest.raises(ValueError, match="UTC offset"):
            require_fixed_offset_zone(spark)
        spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
        assert require_fixed_offset_zone(spark) == "America/Bogota"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_lazy_build_equals_materialized(spark, built):
    cfg, tables = built
    lazy = build_all(spark, cfg, materialize=False, empty_pool="null")
    for name in ("hce_encuentros", "gcm_camas", "age_citas"):
        assert _digest(lazy[name]) == _digest(tables[name]), name


def test_command_line(spark, tmp_path):
    import json

    from clinicgen.__main__ import main
    cfg = small_config().with_lengths(pac_registro=300, med_planta=200, hce_encuentros=400, far_dispensacion=300, age_citas=300)
    conf = tmp_path / "job.json"
    conf.write_text(json.dumps(cfg.doc, ensure_ascii=False), encoding="utf-8")
    paths = main(["--config", str(conf), "--as-of", "2026-01-01", "--base", str(tmp_path / "out"), "--tables", "red_sedes,age_citas",
                  "--max-rejects", "1000", "--empty-pool", "null"], spark)
    assert sorted(paths) == ["age_citas", "red_sedes"]
    assert spark.read.parquet(paths["age_citas"]).columns == cfg.columns("age_citas")
    assert spark.read.csv(paths["red_sedes"]).count() == cfg.length("red_sedes")
    with pytest.raises(ValueError, match="unknown tables"):
        main(["--config", str(conf), "--as-of", "2026-01-01", "--base", str(tmp_path / "out"), "--tables", "nope", "--format", "nope=csv"], spark)


def test_load_config_refuses_a_folder(spark, tmp_path):
    from clinicgen.config import load_config
    for i in range(2):
        (tmp_path / f"{i}.json").write_text("{}")
    with pytest.raises(ValueError, match="found 2 files"):
        load_config(spark, str(tmp_path))
