import random
import zlib

import numpy as np

from clinicgen.llm import quality as Q

GOOD = "the river runs past stone houses and quiet fields where people walk".split()


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        w = [rng.choice(GOOD) for _ in range(rng.randint(20, 120))]
        bad = rng.random() < 0.25
        if bad:
            w = [x.upper() + "!!" for x in w] if i % 2 else [x + " |" for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_held_out_accuracy_and_calibration(lspark, make_docs):
    rows, labels = corpus(900)
    lab = lspark.createDataFrame([*labels, (None, 1, 0), (5, None, 0), (10 ** 6, 1, 0)], "doc_id bigint, quality int, toxic int")
    docs = make_docs([*rows, (2000, None), (2001, ""), (None, "the river"), (2002, "stone " * 60000), (3, rows[3][1])])
    out = Q.score_quality(docs, lab).select("doc_id", "score").collect()
    assert len(out) == 905 and all(0 <= r.score <= 1 for r in out)
    want = {d: q for d, q, _ in labels}
    held = [r for r in out if r.doc_id in want and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert np.mean([(r.score >= 0.5) == want[r.doc_id] for r in held]) > 0.97
    loss = -np.mean([np.log(max(1e-9, r.score if want[r.doc_id] else 1 - r.score)) for r in held])
    assert loss < 0.2
    kept = Q.keep_quality(docs, lab)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out if r.score >= 0.3}


def test_context_table_is_the_sum_over_neighbours(lspark, make_docs):
    rows = [(1, "a b a"), (2, "b"), (3, None), (4, "C! 12 c")] * 3
    at, sign = Q.index_vectors()
    want = np.zeros((Q.BUCKETS, Q.DIM), np.int64)
    ids = Q._Ids()
    for _, t in rows:
        for row in ids.rows((t or "").split()):
            for i, j in zip(row, row[1:], strict=False):
                np.add.at(want[i], at[j], sign[j])
                np.add.at(want[j], at[i], sign[i])
    assert (Q.context_table(make_docs(rows).repartition(3)) == want).all()


def test_no_labels_and_empty_tables(lspark, make_docs):
    none = lspark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r.score for r in Q.score_quality(make_docs([(1, "a b")]), none).collect()] == [0.5]
    assert Q.score_quality(make_docs([]), none).count() == 0
    one = lspark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id bigint, quality int, toxic int")
    assert all(r.score > 0.9 for r in Q.score_quality(make_docs([(i, "a b c") for i in range(40)]), one).collect())


def test_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 5))
    y = (rng.random(2000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = Q.fit(x, y)
    assert abs(net.predict(x).mean() - y.mean()) < 0.05 and 0.25 <= net.temperature <= 8


def test_repeats_are_counted_on_words():
    words = [f"w{chr(97 + i // 676)}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(17_000)]
    vectors = np.zeros((Q.BUCKETS, Q.DIM), np.float32)
    assert Q.pooled(" ".join(words), vectors, Q._Ids())[-2:].tolist() == [0, 1]  # more words than rows, none repeated
    got = Q.pooled("Stone, stone! wall STONE", vectors, Q._Ids())[-2:]
    assert np.allclose(got, [1 / 3, 1 / 2])


def test_few_rows_are_learned_from(lspark, make_docs, monkeypatch):
    x = np.array([[0.0], [1.0]] * 4)
    y = np.array([0.0, 1.0] * 4)
    p = Q.fit(x, y).predict(x)
    assert p[1] > 0.5 > p[0]
    seen = []
    monkeypatch.setattr(Q, "fit", lambda x, y, fit=Q.fit: seen.append(len(y)) or fit(x, y))
    rows, labels = corpus(100)
    lab = lspark.createDataFrame([*labels, *[(i, i % 2, 0) for i in range(1000, 3000)]], "doc_id bigint, quality int, toxic int")
    Q.train(make_docs(rows), lab, max_train=50)
    assert seen == [50]  # labels without a document do not use up the bound


def test_an_id_of_several_texts_is_fitted_on_one_of_them(lspark, make_docs):
    rows, labels = corpus(120)
    twice = [*rows, *[(d, t.upper() + " other words") for d, t in rows]]
    lab = lspark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    nets = [Q.train(make_docs(x).repartition(n), lab)[1] for x, n in ((twice, 3), (twice[::-1], 5))]
    assert all(np.array_equal(getattr(nets[0], f), getattr(nets[1], f)) for f in ("mean", "scale", "w1", "b1", "w2", "b2", "temperature"))
