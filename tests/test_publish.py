"""A build is published as one unit and taken up where it ended."""

import os

import pytest
from pyspark.sql import functions as F
from small import small_config

from clinicgen.plans import publish as P
from clinicgen.plans import tables as TB
from clinicgen.plans.pipeline import ORDER, run
from clinicgen.sources import sinks as SK
from clinicgen.sources.store import Store

FORMATS = {"med_planta": "parquet", "gcm_camas": "csv", "far_dispensacion": "parquet"}  # no avro module here
TABLES = ["pac_registro", "med_planta", "red_sedes", "hce_encuentros", "gcm_camas", "far_dispensacion"]


@pytest.fixture(scope="module")
def cfg():
    return small_config().with_lengths(pac_registro=300, med_planta=200, hce_encuentros=400, far_dispensacion=300, gcm_camas=400)


def _sum(df):
    return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*[c for c in df.columns]).cast("decimal(38,0)"))).first()


class Killed(BaseException):
    pass


def _kill(monkeypatch, module, name, after=0, message=None):
    """Ends the process's work in the call of ``name`` after so many that go through; returns the calls' last arguments."""
    real, calls = getattr(module, name), []

    def stop(*a, **k):
        if len(calls) >= after:
            raise Killed(name)
        calls.append(a[-1])
        return real(*a, **k)

    monkeypatch.setattr(module, name, stop)
    return calls


def test_killed_build_is_resumed(spark, cfg, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    whole = run(spark, cfg, str(tmp_path / "whole"), FORMATS, empty_pool="null", only=TABLES)
    with monkeypatch.context() as m:
        _kill(m, TB, "build_hce_encuentros")
        with pytest.raises(Killed):
            run(spark, cfg, base, FORMATS, empty_pool="null", only=TABLES)
    with pytest.raises(P.Unpublished, match="no build"):
        P.read_build(spark, base)
    assert not any(os.path.exists(SK.table_path(base, t)) for t in TABLES)
    staged = os.listdir(f"{base}/.staging")
    assert len(staged) == 1 and {f for f in os.listdir(f"{base}/.staging/{staged[0]}") if f.endswith(".json")} == {f"{t}.json" for t in TABLES[:3]}
    with monkeypatch.context() as m:
        for name in ("build_pac_registro", "build_med_planta", "build_red_sedes"):
            _kill(m, TB, name)  # finished tables are not built again
        paths = run(spark, cfg, base, FORMATS, empty_pool="null", only=TABLES)
    assert paths == {t: SK.table_path(base, t) for t in TABLES} and not os.path.exists(f"{base}/.staging")
    again, first = P.read_build(spark, base), P.read_build(spark, str(tmp_path / "whole"))
    assert list(again) == TABLES == list(whole)
    for t in TABLES:
        assert _sum(again[t]) == _sum(first[t]), t
        assert P.manifest(spark, base)["tables"][t]["rows"] == again[t].count()
    assert P.manifest(spark, base)["build"] == staged[0] == P.manifest(spark, str(tmp_path / "whole"))["build"]


def test_readers_see_one_build(spark, cfg, tmp_path, monkeypatch):
    base, only = str(tmp_path / "out"), ["pac_registro", "med_planta", "red_sedes"]
    other = cfg.with_lengths(pac_registro=310, med_planta=210)
    run(spark, cfg, base, FORMATS, only=only)
    old = P.read_build(spark, base)
    before = {t: _sum(df) for t, df in old.items()}
    with monkeypatch.context() as m:  # ends between the swap of the second table's old and new folder
        _kill(m, Store, "move", after=3)
        with pytest.raises(Killed):
            run(spark, other, base, FORMATS, only=only)
    with pytest.raises(P.Unpublished, match="being published"):
        P.read_build(spark, base)
    # the next run completes the swap before it builds anything of its own
    with monkeypatch.context() as m:
        _kill(m, TB, "build_pac_registro")
        with pytest.raises(Killed):
            run(spark, cfg.with_lengths(pac_registro=320), base, FORMATS, only=only)
    new = P.read_build(spark, base)
    assert new["pac_registro"].count() == 310 and new["med_planta"].count() == 210
    assert P.recover(spark, base) is None
    # the same settings again: the same build, published anew
    run(spark, cfg, base, FORMATS, only=only)
    assert {t: _sum(df) for t, df in P.read_build(spark, base).items()} == before
    # a smaller build is published alone; tables of the one before are not offered beside it
    run(spark, cfg, base, FORMATS, only=["red_sedes"])
    assert list(P.read_build(spark, base)) == ["red_sedes"]
    with pytest.raises(P.Unpublished, match="not part of"):
        P.read_build(spark, base, ["pac_registro"])


def test_reader_notices_a_swap(spark, cfg, tmp_path, monkeypatch):
    base = str(tmp_path / "out")
    run(spark, cfg, base, FORMATS, only=["red_sedes"])
    real = SK.read_table

    def slow(*a):  # another build is published while the reader lists its files
        monkeypatch.setattr(SK, "read_table", real)
        run(spark, cfg.with_lengths(red_sedes=10, gcm_camas=80), base, FORMATS, only=["red_sedes"])
        return real(*a)

    monkeypatch.setattr(SK, "read_table", slow)
    with pytest.raises(P.Unpublished, match="meanwhile"):
        P.read_build(spark, base)
    assert P.read_build(spark, base)["red_sedes"].count() == 10


def test_interruption_at_every_step(spark, tmp_path, monkeypatch):
    """Wherever a swap ends, recover() completes it."""

    def stage(n):
        s = P.Staging(spark, str(tmp_path / "b"), {"n": n}, {"x": "parquet", "y": "csv"})
        for t in ("x", "y"):
            s.table(t, lambda: spark.range(n))
        return s

    stage(1).publish()
    for step in range(5):
        with monkeypatch.context() as m:
            _kill(m, Store, "move", after=step)
            try:
                stage(10 + step).publish()
                assert step == 4
            except Killed:
                pass
        assert (P.recover(spark, str(tmp_path / "b")) is None) == (step == 4)
        assert [df.count() for df in P.read_build(spark, str(tmp_path / "b")).values()] == [10 + step] * 2
    for name in ("write_json", "delete"):
        with monkeypatch.context() as m:
            s = stage(30)
            _kill(m, Store, name, after=2 if name == "write_json" else 0)
            with pytest.raises(Killed):
                s.publish()
        assert P.recover(spark, str(tmp_path / "b")) == s.build
        assert P.read_build(spark, str(tmp_path / "b"))["y"].dtypes == [("id", "bigint")]
    # nothing is published before every table is there
    s = P.Staging(spark, str(tmp_path / "b"), {"n": 99}, {"x": "parquet", "y": "csv"})
    s.table("x", lambda: spark.range(99))
    with pytest.raises(P.Unpublished, match="not built yet: \\['y'\\]"):
        s.publish()
    assert P.read_build(spark, str(tmp_path / "b"))["x"].count() == 30


def test_build_id_follows_all_settings():
    ids = {P.build_id({"a": 1, "b": [1, 2]}), P.build_id({"a": 2, "b": [1, 2]}), P.build_id({"a": 1, "b": [2, 1]})}
    assert len(ids) == 3 and P.build_id({"b": [1, 2], "a": 1}) in ids
    assert ORDER[0] == "pac_registro"
