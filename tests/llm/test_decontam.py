import random
import re
from itertools import combinations

import numpy as np
import pytest

from clinicgen.llm import decontam as D

BASE = [f"w{i}" for i in range(400)]


def brute(docs, items, span, subs, min_item):
    out = set()
    tok = lambda t: re.findall(r"\w+", (t or "").lower())
    for i, it in items:
        a = tok(it)
        n, allowed = (span, subs) if len(a) >= span else (len(a), subs * len(a) // span)
        for d, t in docs:
            b = tok(t)
            if len(a) < min_item:
                if a and a == b:
                    out.add((d, i))
                continue
            if any(sum(x != y for x, y in zip(a[p:p + n], b[q:q + n], strict=True)) <= allowed for p in range(len(a) - n + 1) for q in range(len(b) - n + 1)):
                out.add((d, i))
    return out


def cases():
    rng = random.Random(4)
    words = lambda n: [rng.choice(BASE) for _ in range(n)]
    items = [(i, " ".join(words(rng.randint(14, 30)))) for i in range(6)]
    items += [(6, "Short item here, of six words"), (7, "two words"), (8, ""), (9, None), (10, items[0][1]), (None, " ".join(words(20)))]
    docs = [(i, " ".join(words(rng.randint(0, 60)))) for i in range(20)]
    for k, (_, it) in enumerate(items[:6]):
        w = it.split()
        for subs in (0, 1, 2, 3, 5):
            c = list(w)
            for p in rng.sample(range(len(c)), subs):
                c[p] = "zzz"
            docs.append((100 + 10 * k + subs, " ".join(words(5) + c + words(5)).upper()))
        docs.append((100 + 10 * k + 9, " ".join(w[2:11])))
    docs += [(1, docs[20][1]), (None, docs[21][1]), (200, None), (201, ""), (202, "it is a short item here, OF six words!"), (203, "short item here of seven words"), (204, docs[20][1] * 300)]
    items += [(20, "one of twelve tokens in this question here is not the same"), (21, "seven tokens are in this short item"), (22, "Yes!"), (23, "four tokens of it"), (24, "yes")]
    docs += [(300, "well, one of twelve TOKENS in that question here is not the same?"), (301, "one of eleven tokens in that question here is not the same"), (302, "x seven tokens are in this shorter item y"),
             (303, "seven tokens were in this shorter item"), (304, "yes"), (305, "Oh yes"), (306, "four tokens of it"), (307, "four tokens of it more"), (308, "YES?"), (308, "four tokens of that")]
    return docs, items


def test_masks_cover_every_placement():
    for span, subs in ((13, 2), (8, 1), (9, 3)):
        for bad in combinations(range(span), subs):
            assert any(not set(bad) & set(kept) for kept in D.spaced(span, subs).kept())
    with pytest.raises(ValueError):
        D.spaced(3, 2)


def _screen(hashes, bits, part=0, parts=1):
    bitmap = np.zeros(1 << (bits - 3), np.uint8)
    s = D.Screen(bits, bitmap, part, parts)
    own = np.array([h for h in hashes if int(h) % parts == part], np.uint64)
    for places in [s.place(own, i) for i in range(D.PROBES)]:
        np.bitwise_or.at(bitmap, (places >> np.uint64(3)).astype(np.int64), (np.uint8(1) << (places & np.uint64(7)).astype(np.uint8)))
    return s


def test_slices_change_nothing(monkeypatch):
    tokens = np.arange(1, 1000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    plan = D.spaced(13, 2)
    want = D._seed_hashes(tokens, plan)
    held = (want[2][5], want[0][500], want[5][986])
    for size in (50, 400_000):
        monkeypatch.setattr(D, "_SLICE", size)
        at = D._hits(_screen(held, 25), tokens, plan).tolist()
        assert set(at) >= {5, 500, 986} and len(at) < 6
        # dealt to several bitmaps, each hash is found by one of them
        assert {x for p in range(3) for x in D._hits(_screen(held, 25, p, 3), tokens, plan).tolist()} >= {5, 500, 986}


def test_screen_keeps_its_share_as_the_benchmark_grows():
    """At the bits a hash that a bitmap has at least, fewer than 1% of clean windows pass its six masks, whatever the size (10,000 to 700,000 hashes)."""
    rng = np.random.default_rng(8)
    for bits in (18, 24):
        s = _screen(rng.integers(0, 1 << 63, (1 << bits) // D.BITS_A_HASH, dtype=np.uint64) << np.uint64(1), bits)
        n = 200_000
        passed = np.zeros(n, bool)
        for _ in range(6):
            passed[s.probe(rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1))] = True
        assert passed.mean() < 0.01


def test_against_brute_force(lspark, make_docs):
    docs, items = cases()
    bench = lspark.createDataFrame(items, "item_id bigint, text string")
    got = D.overlaps(make_docs(docs), bench, ["doc_id"])
    assert {(r.doc_id, r.item_id) for r in got.collect()} == brute(docs, items, 13, 2, 5)
    clean = {r.doc_id for r in D.decontaminate(make_docs(docs), bench).collect()}
    bad_texts = {t for d, t in docs if d in {x for x, _ in brute([(i, t) for i, (_, t) in enumerate(docs)], [], 13, 2, 5)}}
    assert not bad_texts
    bad = {i for i, _ in brute([(i, t) for i, (_, t) in enumerate(docs)], items, 13, 2, 5)}
    kept = [d for i, (d, _) in enumerate(docs) if i not in bad]
    out = D.decontaminate(make_docs(docs), bench)
    assert sorted([r.doc_id for r in out.collect()], key=str) == sorted(kept, key=str)
    assert out.columns == make_docs(docs).columns
    assert {200, 201} <= clean


def test_screens_are_sized_by_the_hashes(lspark, monkeypatch):
    hashes = [int(x) for x in np.random.default_rng(3).integers(-(1 << 63), 1 << 63, 5000)]
    df = lspark.createDataFrame([(h,) for h in hashes], "h bigint")
    for most, least, parts in ((30, 15, 1), (15, 15, 4)):
        monkeypatch.setattr(D, "MOST_BITS", most)
        monkeypatch.setattr(D, "LEAST_BITS", least)
        made = list(D.screens(df))
        assert len(made) == parts and all(s.bits == min(most, 17) for s in made)
        unsigned = np.array(hashes, np.int64).view(np.uint64)
        found = [set(s.probe(unsigned).tolist()) for s in made]
        assert set().union(*found) == set(range(5000)) and sum(map(len, found)) == 5000


def test_several_bitmaps_and_clashing_names(lspark, make_docs, monkeypatch):
    docs, items = cases()
    bench = lspark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(D, "MOST_BITS", 15)
    monkeypatch.setattr(D, "LEAST_BITS", 15)
    monkeypatch.setattr(D, "BITS_A_HASH", 200)
    named = make_docs(docs).selectExpr("doc_id AS n", "text", "1 AS pos", "2 AS win", "3 AS item", "4 AS `key`")
    got = D.overlaps(named, bench, ["n", "pos", "win", "item", "key"])
    assert got.columns[:5] == ["n", "pos", "win", "item", "key"]
    assert {(r.n, r.item_id) for r in got.collect()} == brute(docs, items, 13, 2, 5)


def test_empty_tables(lspark, make_docs):
    bench = lspark.createDataFrame([(1, " ".join(BASE[:20]))], "item_id bigint, text string")
    assert D.overlaps(make_docs([]), bench, ["doc_id"]).count() == 0
    assert D.overlaps(make_docs([(1, " ".join(BASE[:20]))]), bench.limit(0), ["doc_id"]).count() == 0
    assert D.decontaminate(make_docs([(1, "a")]), bench.limit(0)).count() == 1
