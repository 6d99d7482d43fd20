import hashlib
import random

import numpy as np
import pytest

from clinicgen.llm import fmindex as I
from clinicgen.llm import substrings as S


def brute(docs, length):
    """docs: (doc_id, text); windows of all documents in a dict of their words."""
    key = lambda d: S._NO_ID if d is None else d
    words = [(key(d), d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for k, _, w in words:
        for i in range(len(w) - length + 1):
            g = tuple(w[i:i + length])
            least[g] = min(least.get(g, (k, i)), (k, i))
    out = []
    for k, d, w in words:
        gone = set()
        for i in range(len(w) - length + 1):
            if least[tuple(w[i:i + length])] < (k, i):
                gone.update(range(i, i + length))
        out.append((d, len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return sorted(out, key=str)


def test_wavelet_tree_counts():
    rng = np.random.default_rng(1)
    for n, sigma in ((1, 1), (5, 2), (400, 3), (3000, 50), (1000, 1000)):
        seq = np.r_[np.arange(sigma), (rng.random(max(0, n - sigma)) ** 4 * sigma).astype(int)][:max(n, sigma)]
        rng.shuffle(seq)
        tree = I.WaveletTree(seq, sigma)
        bits = sum(int(x) for x in tree.length[seq])
        p = np.bincount(seq) / len(seq)
        assert bits <= len(seq) * (1 - (p * np.log2(p)).sum()) + 1e-6  # within a bit of the entropy
        c, at = rng.integers(0, sigma, 500), rng.integers(0, len(seq) + 1, 500)
        assert tree.rank(c, at).tolist() == [int((seq[:j] == x).sum()) for x, j in zip(c, at, strict=True)]


def test_matching_statistics():
    rng = random.Random(6)
    for depth, sigma, n in ((4, 2, 60), (5, 3, 300), (20, 2, 500), (7, 40, 400)):
        seq = [*range(1, sigma), *(rng.randrange(1, sigma) if rng.random() < 0.95 else 0 for _ in range(n)), 0]
        index = I.FmIndex(np.array(seq), sigma, depth)
        ends = [i for i, x in enumerate(seq) if x == 0]
        starts = [0] + [e + 1 for e in ends[:-1]]
        lo, hi = index.statistics(np.array(seq), np.array(starts), np.array(ends))
        grams = {}
        for s, e in zip(starts, ends, strict=True):
            for i in range(s, e - depth + 1):
                grams.setdefault(tuple(seq[i:i + depth]), []).append(i)
        met = set()
        for at in grams.values():
            assert {(lo[i], hi[i] - lo[i]) for i in at} == {(lo[at[0]], len(at))}
            met.update(at)
        assert len({lo[a[0]] for a in grams.values()}) == len(grams)
        assert all(hi[i] == 0 for i in range(len(seq)) if i not in met)


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 3, 600).astype(np.uint64)
    sizes = np.array([200, 0, 7, 393])
    s = S.Segments(h, sizes, 8)
    seen, ends = {}, np.cumsum(sizes)
    for k, (start, count, anchor, doc) in enumerate(zip(s.start, s.count, s.anchor, s.doc, strict=True)):
        assert 1 <= count <= 8 - S.GRAM + 1 and ends[doc] - sizes[doc] <= start and start + count + 7 <= ends[doc]
        assert s.local[k] == start - (ends - sizes)[doc]
        for i in range(start, start + count):
            assert seen.setdefault(tuple(h[i:i + 8]), (anchor, s.hashes(np.array([i]), 8)[0])) == (anchor, s.hashes(np.array([i]), 8)[0])
    assert s.count.sum() == 193 + 386
    assert len({v[1] for v in seen.values()}) == len(seen)


@pytest.mark.parametrize("hot,shard_words", [(5000, 1_000_000), (2, 200)])
def test_against_all_windows(lspark, make_docs, hot, shard_words):
    rng = random.Random(hot)
    common = [f"w{rng.randrange(30)}" for _ in range(60)]
    docs = []
    for i in range(120):
        w = [f"w{rng.randrange(8 if i % 3 else 4000)}" for _ in range(rng.randrange(0, 60))]
        for _ in range(rng.randrange(3)):
            a = rng.randrange(40)
            at = rng.randrange(len(w) + 1)
            w[at:at] = common[a:a + rng.randrange(4, 30)]
        docs.append((i if i % 17 else None, rng.choice([" ", "\n", " \t", "\x0b\x0c"]).join(w)))
    docs += [(300 + i, docs[5][1]) for i in range(12)] + [(200, docs[5][1]), (200, docs[5][1]), (200, docs[7][1]), (1 << 60, "a b c d e f g h " * 40), (-5, "x " * 500), (7, None), (8, ""),
             (9, " \n"), (400, "é\x1cü \x85 🙂 b c d e f g h i j"), (401, "zz é\x1cü \x85 🙂 b c d e f g h i j k")]
    docs.append((500, " ".join(f"w{rng.randrange(30)}" for _ in range(30_000))))
    for length in (6, 12):
        got = S.remove_repeats(make_docs(docs), length, hot=hot, shard_words=shard_words).collect()
        assert sorted(map(tuple, got), key=str) == brute(docs, length)


def test_twenty_words_and_digest(lspark, make_docs):
    text = [f"t{i}" for i in range(100)]
    docs = [(2, " ".join(text[:19])), (1, " ".join(text)), (3, " ".join(text[10:29])), (4, "new " + " ".join(text[10:30])), (5, " ".join(text[10:30]) + "\nnew"), (6, "a  b")]
    got = {r.doc_id: r for r in S.remove_repeats(make_docs(docs)).collect()}
    assert {d: r.n_removed for d, r in got.items()} == {1: 0, 2: 0, 3: 0, 4: 20, 5: 20, 6: 0}
    assert got[4].kept == "new" and got[6].kept == "a b"
    from pyspark.sql import functions as F

    digest = S.remove_repeats(make_docs([(6, "a  b"), (7, None)])).select("doc_id", F.sha2("kept", 256).alias("s")).collect()
    assert {r.doc_id: r.s for r in digest} == {6: hashlib.sha256(b"a b").hexdigest(), 7: hashlib.sha256(b"").hexdigest()}


def test_empty(lspark, make_docs):
    assert S.remove_repeats(make_docs([])).count() == 0
