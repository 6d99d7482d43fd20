import os

import pytest

import corpus_pipeline as CP
from clinicgen.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_stages_keep_the_columns_and_take_effect(lspark, tmp_path):
    docs = lspark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (name, stage) in enumerate(CP.STAGES):
        stage(lspark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = lspark.read.parquet(f"{tmp_path}/{i}")
        sizes.append(docs.count())
        assert i == len(CP.STAGES) - 1 or docs.columns == columns, name
    assert sizes[1] <= sizes[0] and sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[5] == sizes[4]
    run = CP.run(lspark, SF)
    assert sorted(map(str, run.select("doc_id", "shard").collect())) == sorted(map(str, docs.select("doc_id", "shard").collect()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_runs_and_agrees_with_its_sql(lspark, name):
    import duckdb

    rows = QUERIES[name](lspark, SF).collect()
    assert rows
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for t in ("documents", "pages", "conversations", "labels"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        rel = con.sql(ORACLE_SQL[name])
        cols = sorted(rel.columns)
        assert cols == sorted(rows[0].asDict())
        norm = lambda x: f"{x:.9g}" if isinstance(x, float) else str(x)
        at = [rel.columns.index(c) for c in cols]
        want = sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())
        assert sorted(tuple(norm(r[c]) for c in cols) for r in rows) == want
