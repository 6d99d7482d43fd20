import random

import numpy as np
import xxhash

from clinicgen.llm import simhash as H
from clinicgen.llm.components import components


def slow_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(fps, k):
    """Component number of each fingerprint, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= k:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprint():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 40000):
        t = " ".join(rng.choice(["Ab", "cD", "É", "x", "yy", "z\x0bq"]) for _ in range(n))
        assert H.fingerprint(t) == slow_fingerprint(t) if n < 1000 else H.fingerprint(t) >= 0
    assert H.fingerprint(None) == 0 == H.fingerprint(" \t\n")
    assert H.fingerprint("A  b\tC") == H.fingerprint("a b c")


def test_links_find_every_pair(lspark):
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 60, dtype=np.uint64).tolist()
    for f in list(fps[:30]):
        for _ in range(12):
            for bits in (1, 2, 3, 4):
                fps.append(f ^ int(np.bitwise_or.reduce(np.uint64(1) << rng.choice(64, bits, replace=False).astype(np.uint64))))
    fps = sorted(set(fps) | {0, 3, 1 << 63})
    df = lspark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    for k in (0, 1, 2):
        pairs = [(int(np.int64(r.a).astype(np.uint64)), int(np.int64(r.b).astype(np.uint64))) for r in H.links(df, k).collect()]
        assert all(bin(a ^ b).count("1") <= k for a, b in pairs)
        root = {r.node: r.root for r in components(H.links(df, k)).collect()}
        mine = [root.get(int(np.uint64(f).astype(np.int64)), i) for i, f in enumerate(fps)]
        want = classes(fps, k)
        assert len(set(zip(mine, want, strict=True))) == len(set(mine)) == len(set(want))


def test_count_filter_equals_single_byte_postings(lspark):
    """Posting every (position, byte), tallying the shared ones of each pair and verifying those with 6 or more links the same fingerprints."""
    rng = np.random.default_rng(9)
    fps = rng.integers(0, 1 << 62, 40, dtype=np.uint64).tolist()
    for f in list(fps):
        fps += [f ^ (1 << int(rng.integers(64))), f ^ (3 << int(rng.integers(60))), f ^ (1 << int(rng.integers(32))) ^ (1 << int(rng.integers(32, 64))), f ^ (7 << int(rng.integers(60)))]
    fps = sorted(set(fps))
    postings, shared = {}, {}
    for i, f in enumerate(fps):
        for p in range(8):
            postings.setdefault((p, f >> 8 * p & 255), []).append(i)
    for held in postings.values():
        for i in held:
            for j in held:
                if i < j:
                    shared[i, j] = shared.get((i, j), 0) + 1
    pairs = {p for p, n in shared.items() if n >= 6 and bin(fps[p[0]] ^ fps[p[1]]).count("1") <= 2}
    arr = np.array(fps, np.uint64)
    for (i, j), n in shared.items():
        assert H.tally(arr[i:i + 1], arr[j:j + 1])[0] == n
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in pairs:
        root[find(i)] = find(j)
    df = lspark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp bigint")
    mine = {r.node: r.root for r in components(H.links(df, 2)).collect()}
    ours = [mine.get(int(np.uint64(f).astype(np.int64)), i) for i, f in enumerate(fps)]
    want = [find(i) for i in range(len(fps))]
    assert len(set(zip(ours, want, strict=True))) == len(set(ours)) == len(set(want)) < len(fps) - 60


def test_components_of_a_long_chain(lspark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 - i, 1001 - i) for i in range(50)] + [(5000, j) for j in range(5001, 5100)]
    got = {r.node: r.root for r in components(lspark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert all(got[i] == 0 for i in range(301)) and got[1001] == 951 and got[5099] == 5000
    assert components(lspark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_documents(lspark, make_docs):
    rng = random.Random(5)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 50)) for _ in range(400)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)] + [(100 + i, t.replace("a1 ", "q ", 1)) for i, t in enumerate(base)] + [(200 + i, t.upper()) for i, t in enumerate(base)]
    rows += [(300, None), (301, ""), (302, " \n"), (None, base[0]), (7, base[7]), (None, "only null ids here"), (None, "Only null ids here"), (303, "word")]
    got = H.near_duplicates(make_docs(rows)).collect()
    assert len(got) == len(rows)
    fps = [slow_fingerprint(t) for _, t in rows]
    want = classes(fps, 2)
    least = {}
    for (d, _), c in zip(rows, want, strict=True):
        if d is not None:
            least[c] = min(least.get(c, d), d)
    expect = sorted(((d, f, least.get(c)) for (d, _), f, c in zip(rows, fps, want, strict=True)), key=str)
    assert sorted(((r.doc_id, int(np.int64(r.fp).astype(np.uint64)), r.component_id) for r in got), key=str) == expect
    kept = H.deduplicate(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([*least.values(), None], key=str)


def test_an_id_of_several_components_loses_none(lspark, make_docs):
    rng = random.Random(8)
    a, b, c, d = (" ".join(rng.choice("abcdefghij") + str(rng.randint(0, 50)) for _ in range(300)) for _ in range(4))
    rows = [(1, a), (1, b), (1, a), (2, b), (2, c), (3, c.upper()), (None, d), (4, a), (None, "no id here")]
    kept = H.deduplicate(make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("1", a), ("1", b), ("2", c), ("None", d), ("None", "no id here")])


def test_empty(lspark, make_docs):
    assert H.near_duplicates(make_docs([])).count() == 0
    assert H.deduplicate(make_docs([])).count() == 0
