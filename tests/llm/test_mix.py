import random

from clinicgen.llm import mix as M


def brute_targets(sizes, weights=(1, 2, 3), cap=3.0):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = {}, float(sum(sizes.values()))
    while True:
        rest, open_w = total - sum(full.values()), sum(w[s] for s in names if s not in full)
        over = [s for s in names if s not in full and rest * w[s] / open_w > cap * sizes[s]]
        if not over:
            return {s: full.get(s, rest * w[s] / open_w if open_w else 0.0) for s in names}
        full.update({s: cap * sizes[s] for s in over})


def test_targets_reshare_until_none_is_above(lspark):
    rng = random.Random(2)
    for n in (1, 2, 7, 40):
        rows = [(f"s{rng.randint(0, n)}", rng.choice([0, 1, 5, 1000, 100000])) for _ in range(3 * n)] + [(None, 4), ("zero", 0), ("é", 9), ("Z", 2)]
        sizes = {}
        for s, x in rows:
            sizes[s] = sizes.get(s, 0) + x
        got = {r.source: r.target for r in M.source_targets(lspark.createDataFrame(rows, "source string, size bigint")).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        assert all(abs(got[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in want)


def test_mix_repeats_documents(lspark, make_docs):
    docs = make_docs([(i, "a b\tc d\ne " * (i % 5 + 1), f"s{i % 3}" if i % 7 else None) for i in range(900)] + [(5000, None, "s1"), (None, "", "s1"), (None, "x y", "s0")])
    sized = docs.select("doc_id", "source", M.word_count().alias("size"))
    plan = {(r.doc_id, r["size"]): r for r in M.repetitions(sized, ["doc_id"]).collect()}
    assert plan[5000, 0].copies >= 0 and plan[(3, 16)]["size"] == 16
    assert all(r.copies <= 3 and abs(r.copies - r.target / r.source_size) < 1 for r in plan.values())
    taken = {}
    for r in plan.values():
        taken.setdefault((r.source_size, r.target), []).append(r["size"] * r.copies)
    assert all(abs(sum(v) - t) < 0.15 * t for (_, t), v in taken.items())
    out = M.mix_documents(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in M.repetitions(sized, ["doc_id"]).collect())
    assert sorted(map(str, out.collect())) == sorted(map(str, M.mix_documents(docs).collect()))


def test_empty_and_wordless(lspark, make_docs):
    assert M.mix_documents(make_docs([])).count() == 0
    assert M.mix_documents(make_docs([(1, None), (2, " \n")])).count() == 0
