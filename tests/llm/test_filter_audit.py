import random
import re
from itertools import permutations

from clinicgen.llm import filter_audit as A

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(rows, letters):
    """rows: (part, set of failing letters, good, toxic); filters applied one after the other, order by order."""
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations(letters):
            left, gone = own, []
            for step, x in enumerate(order, 1):
                here = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                out[part, "".join(order), step] = [len(left), len(here), sum(x in r[1] for r in gone), sum(r[1] == {x} for r in own),
                                                   sum(r[2] for r in here), sum(r[3] for r in here), x]
                gone = gone + here
                shapley[part, x] = shapley.get((part, x), 0) + len(here)
    return {(*key, *v[:6], shapley[key[0], v[6]]) for key, v in out.items()}


def test_intervals_are_the_orders_that_remove():
    for k in (1, 2, 4, 5):
        ranks = A.orders(k)
        assert [A.lehmer_start(o, k) for o in ranks] == list(range(len(ranks)))
        covered = {(m, r): s for m, s, lo, hi in A.intervals(k) for r in range(lo, hi)}
        assert len(covered) == sum(hi - lo for _, _, lo, hi in A.intervals(k)) == ((1 << k) - 1) * len(ranks)
        for (mask, r), step in covered.items():
            assert step == next(i for i, x in enumerate(ranks[r], 1) if mask >> x & 1)


def test_audit_against_every_order(lspark):
    rng = random.Random(4)
    for letters, n in (("ABCDE", 400), ("AB", 30), ("ACZ", 50)):
        rows = [(rng.choice(["", "s0", "é"]), {x for x in letters if rng.random() < 0.35}, rng.random() < 0.3, rng.random() < 0.1) for _ in range(n)]
        df = lspark.createDataFrame([(p, sum(1 << letters.index(x) for x in f), g, t) for p, f, g, t in rows], "part string, mask int, good boolean, toxic boolean")
        got = [tuple(r[c] for c in COLUMNS) for r in A.audit(df, letters).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows, letters)


def test_texts_copies_and_labels(lspark, make_docs):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(1, long), (2, long, None), (2, long, ""), (3, None), (4, ""), (None, long), (None, None, None), (5, "AB " * 80), (6, long + " #é"), (7, "é" * 95 + "ABCDE"),
            (8, "é" * 94 + "ABCDEF"), (9, " ".join(["a", "b"] * 50 + [f"c{i}" for i in range(183)])), (10, " ".join(["a", "b"] * 50 + [f"c{i}" for i in range(184)])),
            (11, "x y " * 49), (12, long + "\tz\x0bz\x1cz"), (13, "w " * 20_000)]
    labels = lspark.createDataFrame([(1, 1, 0), (2, 1, None), (2, 0, 1), (None, 1, 1), (5, None, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    least = {}
    for r in docs:
        if r[0] is not None:
            least[r[1] or ""] = min(least.get(r[1] or "", 1 << 60), r[0])
    rows = []
    for doc_id, text, *src in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {x for x, bad in zip("ABCDE", (len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                                               bool(re.search(r"[#$%&*|]", t)), doc_id is not None and doc_id > least[t]), strict=True) if bad}
        rows.append((src[0] or "" if src else "s", fails, doc_id in (1, 2), doc_id in (2, 5)))
    got = [tuple(r[c] for c in COLUMNS) for r in A.audit(A.marked(make_docs(docs), labels)).collect()]
    assert len(got) == 2 * 120 * 5 and set(got) == brute(rows, "ABCDE")


def test_empty(lspark, make_docs):
    labels = lspark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert A.audit(A.marked(make_docs([]), labels)).count() == 0
    assert {r.kept for r in A.audit(A.marked(make_docs([(1, "a $")]), labels)).collect()} == {0, 1}
