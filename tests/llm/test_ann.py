import math

import numpy as np

from clinicgen.llm import ann as A

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, leaf int"


def table(spark, ids, x):
    return spark.createDataFrame([(i, r, 0, "clash", 9) for i, r in zip(ids, x, strict=True)], SCHEMA)


def brute(ids, x, k):
    x64 = np.asarray(x, np.float32).astype(np.float64)
    out = {}
    for i, q in zip(ids, x64, strict=True):
        if i % 20 == 0:
            s = (q[None, :] * x64).sum(axis=1)
            out[i] = [(j, float(t)) for t, j in sorted((-s[n], j) for n, j in enumerate(ids) if j != i)][:k]
    return {i: [(j, -t) for j, t in v] for i, v in out.items()}


def run(vectors, **how):
    use = A.usable(vectors)
    out = {}
    for r in A.search(use, use.where("vec_id % 20 = 0"), **how).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}


def test_recall_and_exact_scores(lspark):
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(30, 24))
    x = (centers[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 24)) * 0.7).astype(np.float32)
    got, want = run(table(lspark, range(6000), x.tolist()).repartition(3)), brute(range(6000), x, 20)
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    x64 = x.astype(np.float64)
    assert all(s == float((x64[q] * x64[j]).sum()) for q in got for j, s in got[q])
    assert all(len(v) == 20 and [(-s, j) for j, s in v] == sorted((-s, j) for j, s in v) for v in got.values())


def test_hot_copies_ties_and_odd_rows(lspark, monkeypatch):
    monkeypatch.setattr(A, "BLOCK_ROWS", 64)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 8)).astype(np.float32)
    x[:400] = x[0]  # two thirds are copies
    rows = x.tolist()
    odd = [(1000, None), (1020, []), (1040, [0.0] * 8), (1060, [math.nan] + [1.0] * 7), (1080, [math.inf] + [1.0] * 7), (1100, [None] + [1.0] * 7), (1120, [1.0] * 3), (None, rows[0]), (20, rows[20])]
    got = run(table(lspark, [*range(600), *[i for i, _ in odd]], [*rows, *[v for _, v in odd]]), leaves=6)
    want = brute(range(600), x, 20)
    assert got.keys() == want.keys()
    for q in range(0, 400, 20):
        assert got[q] == want[q]  # the least ids among hundreds of equal scores


def test_queries_outside_the_dense_groups(lspark):
    """Most rows in a few tight groups, the others far apart: the lonely queries reach the recall too, and no list is short."""
    rng = np.random.default_rng(5)
    n, lonely = 8000, 1000
    x = (rng.normal(size=(4, 16))[rng.integers(0, 4, n)] * 3 + rng.normal(size=(n, 16)) * 0.05).astype(np.float32)
    at = rng.choice(n, lonely, replace=False)
    x[at] = (rng.normal(size=(lonely, 16)) * 2).astype(np.float32)
    got, want = run(table(lspark, range(n), x.tolist())), brute(range(n), x, 20)
    assert all(len(v) == 20 for v in got.values())
    own = [len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want if q in set(at.tolist())]
    assert len(own) > 30 and np.mean(own) >= 0.9 and np.mean(np.array(own) < 0.5) <= 0.1


def test_small_leaves_still_give_k_rows(lspark):
    """Leaves of a few rows: a query goes on until it has seen more than k."""
    root, n_leaves = A.fit_tree(np.random.default_rng(3).normal(size=(400, 4)), 8)
    held = np.full(n_leaves, 2)
    q = np.ones(4)
    assert len(A.best_bins(root, q, 1)) == 1 and len(A.best_bins(root, q, 1, held, 21)) == 11
    assert len(A.best_bins(root, q, 1, held, 10 ** 6)) == n_leaves
    x = np.random.default_rng(4).normal(size=(150, 4)).astype(np.float32)
    got = run(table(lspark, range(150), x.tolist()), recall=0.05, floor=0.05, leaves=70)
    assert all(len(v) == 20 for v in got.values())


def test_few_and_none(lspark):
    got = run(table(lspark, [0, 1, 20], [[1.0, 0.0], [0.5, 1.0], [2.0, 2.0]]))
    assert got == {0: [(20, 2.0), (1, 0.5)], 20: [(1, 3.0), (0, 2.0)]}
    assert run(table(lspark, [], [])) == {}
    assert run(table(lspark, [3, 4], [[1.0], [2.0]])) == {}
