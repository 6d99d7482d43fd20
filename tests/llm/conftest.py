import pytest


@pytest.fixture(scope="session")
def lspark(spark):
    from clinicgen.llm.common import prepare

    return prepare(spark)


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def make_docs(lspark):
    """documents from (doc_id, text[, source]) tuples, with extra columns whose names clash with outputs and helpers."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 7, "x", 5, 2.5, 1) for r in rows]
        return lspark.createDataFrame(full, DOCS + ", row string, shard int, score double, copies bigint")
    return make
