import math
import random
import zlib

import numpy as np

from clinicgen.llm import hpylm as P


def base(docs):
    tok = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda d: d is None or zlib.crc32(str(d).encode()) % 7 == 2
    c = {}
    for d, t in docs:
        if not held(d):
            for w in tok(t):
                c[w] = c.get(w, 0) + 1
    n, v = sum(c.values()), len(c)
    return {(d, t): (held(d), len(tok(t)), sum(w in c for w in tok(t)), n, sum(math.log10((c.get(w, 0) + 1) / (n + v + 1)) for w in tok(t))) for d, t in docs}


def corpus(n=300):
    rng = random.Random(0)
    nxt = {w: [rng.choice("abcdefghijklmnop") for _ in range(3)] for w in "abcdefghijklmnop"}
    rows = []
    for i in range(n):
        w, out = rng.choice("abcdefghijklmnop"), []
        for _ in range(rng.randint(5, 60)):
            out.append(w * 3)
            w = rng.choice(nxt[w])
        rows.append((i, " ".join(out)))
    return rows + [(1000, None), (1001, ""), (None, "aaa BBB"), (1002, "ÄÖ unseen Words"), (5, rows[5][1]), (1003, "aaa " * 30000)]


def test_digests_and_perplexity(lspark, make_docs, monkeypatch):
    rows = corpus()
    out = P.score(make_docs(rows).repartition(3))
    got = out.collect()
    want = base(rows)
    key = lambda d, a, b: (str(d), a, b)
    assert sorted((key(r.doc_id, r.held_out, r.n_tokens), r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == \
        sorted((key(d, want[d, t][0], want[d, t][1]), want[d, t][2], want[d, t][3], round(want[d, t][4], 6)) for d, t in rows)
    held = [r for r in got if r.held_out and r.n_known == r.n_tokens]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)  # both negative; the contexts are worth a lot here
    assert all(r.score < 0 for r in got)
    assert {r.held_out: r.perplexity for r in P.perplexity(out).collect()}[True] < 16
    again = {(r.doc_id, r.n_tokens): r.score for r in P.score(make_docs(rows).repartition(3)).collect()}
    assert all(abs(again[r.doc_id, r.n_tokens] - r.score) < 0.05 * abs(r.score) for r in got)


def test_chunks_and_buckets_change_no_count(lspark, make_docs, monkeypatch):
    rows = corpus(60)
    a = {(r.doc_id, r.n_tokens): (r.n_known, r.train_tokens, round(r.base_score, 6)) for r in P.score(make_docs(rows)).collect()}
    chunked = P.chunks(make_docs(rows)).collect()
    assert sum(r.n_train for r in chunked) == next(iter(a.values()))[1]
    assert sum(int(P.unpack(r["count"]).sum()) for r in chunked) == sum(n for _, n in [(k, k[1]) for k in {(i, d, len((t or '').split()) + 1) for i, (d, t) in enumerate(rows)} for k in [(k[0], k[2])]])
    dealt = P.by_bucket(P.chunks(make_docs(rows)), 5).collect()
    assert sum(len(P.unpack(r.ctx)) for r in dealt) == sum(r.n_types for r in chunked)


class Seating:
    """Seats of the customers of many dishes, moved one by one: what ``Dishes`` draws at once."""

    def __init__(self, counts: np.ndarray, discount: float, rng: np.random.Generator) -> None:
        self.c, self.d, self.rng = counts.astype(np.int64), discount, rng
        self.tables = np.minimum(self.c, 1)
        many = np.flatnonzero(self.c >= 2)
        self.many = many[np.argsort(-self.c[many], kind="stable")]  # most customers first, so that a move takes a prefix
        n = self.c[self.many]
        self.start = np.r_[0, np.cumsum(n)[:-1]] if len(n) else np.zeros(0, np.int64)
        t = np.maximum(1, np.round(n ** discount / 2)).astype(np.int64)  # a start near the law's growth; moves do the rest
        local = np.arange(int(n.sum())) - np.repeat(self.start, n)
        self.seat = np.repeat(self.start, n) + local % np.repeat(t, n)
        self.size = np.bincount(self.seat, minlength=len(self.seat)).astype(np.int64)
        self.tables[self.many] = t

    def sweep(self, new: np.ndarray, moves: int) -> None:
        """Reseats up to ``moves`` random customers per dish; ``new``: weight of a new table per dish."""
        n = self.c[self.many]
        for m in range(moves):
            k = int(np.searchsorted(-n, -m, side="left")) if m >= 2 else len(n)  # dishes with more than m customers
            if k:
                self._move(k, new[self.many[:k]])

    def _move(self, k: int, new: np.ndarray) -> None:
        rng, start, dish = self.rng, self.start[:k], self.many[:k]
        n = self.c[dish]
        who = (rng.random(k) * n).astype(np.int64)
        old = self.seat[start + who]
        self.size[old] -= 1
        closed = self.size[old] == 0
        t = self.tables[dish] - closed
        fresh = rng.random(k) * (new + (n - 1) - self.d * t) < new
        goal = np.full(k, -1, np.int64)
        goal[fresh & closed] = old[fresh & closed]
        todo = np.flatnonzero(fresh & ~closed)
        while len(todo):  # a free place among the dish's n
            at = start[todo] + (rng.random(len(todo)) * n[todo]).astype(np.int64)
            free = self.size[at] == 0
            goal[todo[free]] = at[free]
            todo = todo[~free]
        todo = np.flatnonzero(~fresh)
        while len(todo):  # a table by size - d: that of a random other customer, kept with (size - d) / size
            other = (rng.random(len(todo)) * (n[todo] - 1)).astype(np.int64)
            other += other >= who[todo]
            at = self.seat[start[todo] + other]
            s = self.size[at]
            ok = rng.random(len(todo)) * s < s - self.d
            goal[todo[ok]] = at[ok]
            todo = todo[~ok]
        self.seat[start + who] = goal
        self.size[goal] += 1
        self.tables[dish] = t + fresh


def test_seating_stays_valid_and_mixes():
    rng = np.random.default_rng(0)
    c = np.array([1, 2, 2, 3, 10, 500, 1, 40])
    s = Seating(c, 0.6, rng)
    seen = []
    for _ in range(400):
        s.sweep(np.full(len(c), 0.8), 8)
        seen.append(s.tables.copy())
        for j, d in enumerate(s.many):
            size = s.size[s.start[j]:s.start[j] + c[d]]
            assert size.sum() == c[d] and (size > 0).sum() == s.tables[d] and (size >= 0).all()
            assert (np.bincount(s.seat[s.start[j]:s.start[j] + c[d]] - s.start[j], minlength=c[d]) == size).all()
    # two customers of one dish: apart with weight a * a', together with a * (1 - d); a new table weighs a = 0.8
    apart = np.mean([t[1] == 2 for t in seen[50:]])
    assert abs(apart - 0.8 / (0.8 + 0.4)) < 0.12
    assert all(t[0] == 1 for t in seen)


def test_predictive_sums_to_one():
    rng = np.random.default_rng(1)
    words = np.sort(rng.choice(1 << 60, 200, replace=False).astype(np.uint64))
    ctx, word = rng.integers(0, 6, 5000), np.sort(rng.integers(0, 200, 5000) ** 2 // 200)
    key, count = np.unique((word << 16) | ctx, return_counts=True)
    full = np.array([(w << 16) | u for w in range(200) for u in range(6)])
    n = dict(zip(key.tolist(), count.tolist(), strict=True))
    rows = P.pd.DataFrame({"bucket": [0], "chunk": [0], "words": [P.pack(words)], "per_word": [P.pack(np.full(200, 6))],
                           "ctx": [P.pack(full & 0xFFFF)], "train": [P.pack(np.array([n.get(int(k), 0) for k in full]))]})
    b = P._Bucket(rows)
    s = P._Sampler(b, None, 1, 1.0, 3)
    for _ in range(5):
        s.sweep(8)
    t = np.bincount(b.ctx, weights=s.seats.tables, minlength=6)
    s.shared = s.shared._replace(tables=t, root_customers=float(t.sum()), root_tables=0.0)
    s.root()
    s.shared = s.shared._replace(root_tables=float(s.top.tables.sum()))
    g = s.shared
    new = (1.0 + g.root_discount * g.root_tables) / (g.vocabulary + 1)
    s.p_word = (s.sent - g.root_discount * s.top.tables + new) / (1.0 + g.root_customers)
    unknown = new / (1.0 + g.root_customers)
    seen = b.word_count > 0
    assert abs(s.p_word[seen].sum() + unknown - 1) < 1e-9
    p, u = s.predictive(), np.arange(6)
    for c in u:
        own = (b.ctx == c) & seen[b.word]
        back = (1.0 + g.discount * t[c]) / (1.0 + g.customers[c])
        assert abs(p[own].sum() + back * unknown - 1) < 1e-9


def test_no_text(lspark, make_docs):
    assert P.score(make_docs([])).count() == 0
    r = P.score(make_docs([(4, "a b")])).first()
    assert r.n_tokens == 3


def stirling(n, d):
    """S(n, t) for t = 1 .. n by the plain recursion."""
    row = [1.0]
    for m in range(1, n):
        row = [(row[t] * (m - d * (t + 1)) if t < len(row) else 0) + (row[t - 1] if t else 0) for t in range(m + 1)]
    return np.array(row)


def test_tables_follow_their_law_whatever_the_customers():
    rng = np.random.default_rng(2)
    for n, d, a, g in ((2, 0.6, 0.8, 0.0), (3, 0.3, 0.5, 0.2), (12, 0.7, 2.0, 0.1), (120, 0.5, 6.0, 0.3)):
        k = 20_000
        s = P.Dishes(np.full(k, n), d, rng)
        s.draw(np.full(k, a), np.full(k, g))
        law = stirling(n, d) * np.r_[1, np.cumprod(a + g * np.arange(1, n))]
        law /= law.sum()
        got = np.bincount(s.tables, minlength=n + 1)[1:] / k
        assert np.abs(got - law).max() < 5 * math.sqrt(0.25 / k)
    # one draw per dish is enough however many customers: t - 1 is Poisson(new / d) in the limit
    k = 4000
    s = P.Dishes(np.full(k, 30_000_000), 0.8, rng)
    s.draw(np.full(k, 8.0), np.zeros(k))
    assert abs(s.tables.mean() - 11) < 5 * math.sqrt(10 / k) and abs(s.tables.var() - 10) < 1.5
    # many steps taken together give the same as single ones
    many, one = list(P._occupancy(np.array([9000]), 0.7, 60))[0], list(P._occupancy(np.arange(2, 9001), 0.7, 60))[-1]
    assert np.abs(many - one).max() < 1e-4


def test_wide_laws_with_many_customers():
    """A frequent word after a frequent word: the law by long steps is that of single steps, at a small part of the time."""
    import time

    rng = np.random.default_rng(4)
    for d, n, width in ((0.9, 6000, 700), (0.5, 9000, 300)):
        fast = list(P._occupancy(np.array([n]), d, width))[0]
        one = list(P._occupancy(np.arange(2, n + 1), d, width))[-1]
        assert np.abs(fast - one)[one > -600].max() < 1e-3
    begin = time.process_time()
    s = P.Dishes(np.r_[np.full(3000, 3), 100_000, 90_000], 0.9, rng)
    s.draw(np.r_[np.full(3000, 1.0), 1800.0, 2.0], np.full(3002, 0.03))
    assert time.process_time() - begin < 20 and 1000 < s.tables[3000] < 3000 and 1 <= s.tables[3001] < 40


def test_several_buckets_and_chunks_score_alike(lspark, make_docs):
    """Three or more of each: the same digests as one bucket and chunk, and scores that differ no more than two seeds of it do."""
    rows = corpus()
    docs = make_docs(rows).repartition(3)
    one = {(r.doc_id, r.n_tokens): r for r in P.score(docs).collect()}
    chunked = P.chunks(docs, tokens=1500).collect()
    assert len(chunked) > 3
    dealt = P.by_bucket(P.chunks(docs, tokens=1500), 4)
    assert {r.bucket for r in dealt.select("bucket").distinct().collect()} == {0, 1, 2, 3}
    many = {(r.doc_id, r.n_tokens): r for r in P.score(docs, chunk_tokens=1500, bucket_types=max(1, sum(r.n_types for r in chunked) // 4)).collect()}
    assert one.keys() == many.keys()
    twice = {(r.doc_id, r.n_tokens): r for r in P.score(docs, chunk_tokens=700, bucket_types=max(1, sum(r.n_types for r in chunked) // 12), fan=3).collect()}  # dealt in two levels
    for k, r in one.items():
        m = many[k]
        assert (r.held_out, r.n_known, r.train_tokens, round(r.base_score, 6)) == (twice[k].held_out, twice[k].n_known, twice[k].train_tokens, round(twice[k].base_score, 6))
        assert (r.held_out, r.n_known, r.train_tokens) == (m.held_out, m.n_known, m.train_tokens) and abs(r.base_score - m.base_score) < 1e-6 * abs(r.base_score)
    held = [k for k, r in one.items() if r.held_out]
    a, b, c = (sum(x[k].score for k in held) for x in (one, many, twice))
    assert abs(a - b) < 0.02 * abs(a) and abs(a - c) < 0.02 * abs(a)


def test_two_levels_deal_what_one_does(lspark, make_docs):
    """Merged groups of chunks hold the same types, contexts and counts per bucket, and rows in proportion to the chunks."""
    def types(dealt):
        out = {}
        for r in dealt.collect():
            words, names, train = P.unpack(bytes(r.words)), P._from_steps(bytes(r.ctxs)), P.unpack(bytes(r.train))
            for w, c, n in zip(np.repeat(words, P.unpack(bytes(r.per_word)).astype(int)).tolist(), names[P.unpack(bytes(r.ctx))].tolist(), train.tolist(), strict=True):
                key = (r.bucket, w, c)
                out[key] = out.get(key, 0) + n
        return out

    rows = corpus(80)
    cells = []
    for n in (1, 2):
        docs = make_docs([(i * 10_000 + d if d is not None else None, t) for i in range(n) for d, t in rows])
        chunked = P.write(P.chunks(docs, tokens=700), "chunks")[0]
        slices, per = 3, 2 * n  # buckets follow the input
        dealt = P.write(P.by_bucket(chunked, slices), "cells")[0]
        merged = P.write(P.regroup(dealt, max(1, chunked.count() // per), per, slices * per), "groups")[0]
        assert types(P.by_bucket(chunked, slices * per)) == types(merged.where("block = 0"))
        cells.append(dealt.count() + merged.count())
    assert cells[1] <= 2.3 * cells[0]  # twice the input, about twice the rows


def test_tables_that_nothing_reads_are_deleted(lspark, make_docs):
    import os

    from clinicgen.llm.common import scratch_path

    folder = scratch_path(lspark, "").removeprefix("file:")
    before = {n for n in os.listdir(folder) if n.startswith("lm-")}
    P.score(make_docs(corpus(40)), rounds=3).collect()
    left = sorted(n.split("-")[1] for n in set(os.listdir(folder)) - before if n.startswith("lm-"))
    assert left == ["answers", "chunks"]
    chunks = next(n for n in set(os.listdir(folder)) - before if n.startswith("lm-chunks"))
    assert [n for n in os.listdir(f"{folder}/{chunks}") if n.startswith("kind")] == ["kind=lists"]


def test_tables_of_a_round_are_where_the_next_begins(lspark, make_docs):
    state = P.write(P._begin(P.by_bucket(P.chunks(make_docs(corpus(60))), 2), 2, 1.0), "begin")[0]
    types = state.where("block = -1").select("bucket", "chunk", "words", "per_word", "ctxs", "ctx", "train")
    tables = lambda s: {r.bucket: P.unpack(bytes(r.tables)).tolist() for r in s.where("block = -1").collect()}
    state = P.write(P._round(types, state, 2, 1.0, 2, 1), "round")[0]
    first = tables(state)
    assert any(max(t) > 1 for t in first.values())
    assert tables(P._round(types, state, 2, 1.0, 0, 2)) == first  # no sweep: the types' tables stay


def test_every_previous_word_is_a_context(lspark, make_docs):
    by_class = {}
    for i in range(5000):  # two words of one class of 65,536
        w = f"w{i}"
        u = by_class.setdefault(P.xxhash.xxh64_intdigest(w.encode()) & 0xFFFF, w)
        if u != w:
            break
    rows = [(i, f"{u} red {w} blue") for i in range(300)]
    held = [d for d in range(1000, 1100) if P.held_out(d)][:2]
    pairs = [(i, f"{u} red end" if i % 2 else f"{w} blue end") for i in range(300)]
    got = {r.doc_id: r.score for r in P.score(make_docs([*pairs, (held[0], f"{u} red end"), (held[1], f"{u} blue end")])).collect()}
    assert got[held[0]] > got[held[1]] + 1  # one restaurant for both would give about the same
    # totals of a context are those of all buckets
    state = P._begin(P.by_bucket(P.chunks(make_docs(rows)), 4), 4, 1.0)
    scalars, shares = P._shares(state)
    cells = [r for r in state.where("block >= 0").collect()]
    want = {}
    for r in cells:
        for h, c in zip(P._from_steps(bytes(r.ctxs)).tolist(), P.unpack(bytes(r.customers)).tolist(), strict=True):
            want[h] = want.get(h, 0) + c
    names = {(r.bucket, r.block): P._from_steps(bytes(r.ctxs)).tolist() for r in cells}
    n = sum(not P.held_out(d) for d, _ in rows)
    assert len(want) == 5 and set(want.values()) == {n}
    for r in shares.where("block >= 0").collect():
        assert P.unpack(bytes(r.customers)).tolist() == [want[h] for h in names[r.bucket, r.block]]
