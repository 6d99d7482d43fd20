"""Benchmark decontamination by spaced-seed hashing.

A training text is contaminated by a benchmark item when some window of ``span`` consecutive
tokens of the one equals a window of the other in all but at most ``substitutions`` places. An item of n < ``span`` tokens
is one window; as many substitutions are allowed as n has of ``span`` (rounded down). Items below ``min_item`` tokens are too common inside
texts and must be the whole text. Tokens are lower-cased ``\\w+`` runs.

Seeds: the window's positions fall into ``substitutions + 2`` residue classes; a mask keeps two
classes and ignores the others, and there is a mask for every two. Substitutions lie in at most
``substitutions`` classes, so two classes are untouched and their mask hashes alike on
both sides: no qualifying window is missed. Joined hits are verified position by position.

Test hashes set four bits each in a bitmap of at least ``BITS_A_HASH`` bits a hash, which is all that is
broadcast; training windows with a hash in the bitmap go to the join, each distinct window
once, so a passage that a third of the documents share is joined once. The bitmap has 2**``MOST_BITS`` bits at most: the hashes of
a benchmark that needs more are dealt to several bitmaps, and the texts are read once for each.

Cases: null and empty texts are clean; null or empty items match nothing; equal items all are reported; repeated rows are
rows of their own; empty tables give empty results; key columns may have any name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cache, reduce
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read

_TOKEN = re.compile(r"\w+")
BITS_A_HASH, LEAST_BITS, MOST_BITS = 24, 20, 30  # powers of two for the last two: 128 KB to 128 MB
PROBES = 4
_MUL = np.random.default_rng(5).integers(1, 1 << 63, 1024, dtype=np.uint64) | np.uint64(1)


class Plan(NamedTuple):
    """Masks over windows of ``n`` tokens: position classes, and which classes each mask keeps."""
    n: int
    classes: list[list[int]]
    masks: list[tuple[int, ...]]

    def kept(self) -> list[list[int]]:
        return [sorted(p for c in m for p in self.classes[c]) for m in self.masks]


def spaced(span: int, substitutions: int) -> Plan:
    """A mask for every two of ``substitutions + 2`` residue classes."""
    k = substitutions + 2
    if not k <= span <= len(_MUL):
        raise ValueError(f"span must lie between substitutions + 2 and {len(_MUL)}")
    return Plan(span, [list(range(c, span, k)) for c in range(k)], list(combinations(range(k), 2)))


def unspaced(n: int) -> Plan:
    """The one mask that keeps all of a short item."""
    return Plan(n, [list(range(n))], [(0,)])


def short_plan(n: int, span: int, substitutions: int) -> tuple[Plan, int]:
    """Masks for an item of n < ``span`` tokens, and the substitutions that it may have."""
    allowed = substitutions * n // span
    return (spaced(n, allowed) if allowed else unspaced(n)), allowed


def plan_of(n: int, span: int, substitutions: int) -> Plan:
    """Masks of windows of ``n`` tokens; ``-n`` stands for whole texts of n tokens."""
    return spaced(span, substitutions) if n == span else unspaced(-n) if n < 0 else short_plan(n, span, substitutions)[0]


class _Words(dict):
    """Token -> 64-bit hash; forgets when it holds a million."""

    def __missing__(self, w: str) -> int:
        if len(self) >= 1_000_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"), 9)
        return h


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _seed_hashes(tokens: np.ndarray, plan: Plan) -> list[np.ndarray]:
    """Per mask, the hash of every window: class sums are shared by the masks."""
    m = len(tokens) - plan.n + 1
    sums = []
    for c in plan.classes:
        total = np.zeros(m, np.uint64)
        for p in c:
            total += tokens[p:p + m] * _MUL[p]
        sums.append(total)
    return [_mix(sum((sums[c] for c in mask[1:]), sums[mask[0]]) + np.uint64(i + 1)) for i, mask in enumerate(plan.masks)]


class Screen(NamedTuple):
    """A bitmap of ``PROBES`` bits a hash, for the hashes that are ``part`` modulo ``parts``."""
    bits: int
    bitmap: np.ndarray
    part: int = 0
    parts: int = 1

    def place(self, h: np.ndarray, i: int) -> np.ndarray:
        """The i-th bit of each hash: its first bits, and steps of later ones."""
        mask = np.uint64((1 << self.bits) - 1)
        return ((h >> np.uint64(64 - self.bits)) + np.uint64(i) * ((h >> np.uint64(8)) & mask)) & mask

    def probe(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes of this part whose bits are all set."""
        at = np.arange(len(h)) if self.parts == 1 else np.flatnonzero(h % np.uint64(self.parts) == self.part)
        for i in range(PROBES):
            x = self.place(h[at] if i or self.parts > 1 else h, i)
            at = at[((self.bitmap[x >> np.uint64(3)] >> (x & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)]
        return at


_SLICE = 400_000  # tokens hashed at a time


def _hits(screen: Screen, tokens: np.ndarray, plan: Plan) -> np.ndarray:
    """Sorted starts of the windows that have a seed hash in the bitmap."""
    found = []
    for s in range(0, len(tokens) - plan.n + 1, _SLICE):
        found += [s + screen.probe(h) for h in _seed_hashes(tokens[s:s + _SLICE + plan.n - 1], plan)]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def item_windows(items: DataFrame, span: int, substitutions: int, min_item: int, text: str, id_col: str) -> DataFrame:
    """(item_id, n, win, h array): windows of the benchmark with their seed hashes; n is negative for items that must be the whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                toks = _TOKEN.findall((t or "").lower())
                if not toks:
                    continue
                kind = span if len(toks) >= span else len(toks) if len(toks) >= min_item else -len(toks)
                own = plan_of(kind, span, substitutions)
                n, h = own.n, np.fromiter(map(words.__getitem__, toks), np.uint64, len(toks))
                hs = np.stack(_seed_hashes(h, own), 1).view(np.int64)
                for s in range(0, len(hs), 4096):
                    part = hs[s:s + 4096]
                    yield pa.RecordBatch.from_pydict({
                        "item_id": pa.array([item] * len(part), pa.int64()), "n": pa.array([kind] * len(part), pa.int32()),
                        "win": [" ".join(toks[i:i + n]) for i in range(s, s + len(part))], "h": pa.array(list(part), pa.list_(pa.int64()))})

    return items.select(F.col(id_col).cast("bigint"), F.col(text)).mapInArrow(run, "item_id bigint, n int, win string, h array<bigint>")


def screens(hashes: DataFrame) -> Iterator[Screen]:
    """Bitmaps for the counted hashes, one after the other; gathered as blocks of 32,768 bits."""
    n = hashes.count()
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(max(n, 1) * BITS_A_HASH))))
    parts = max(1, math.ceil(n * BITS_A_HASH / (1 << bits)))
    mask = (1 << bits) - 1
    first, step = F.shiftrightunsigned("h", 64 - bits), F.shiftrightunsigned("h", 8).bitwiseAND(mask)
    cell = F.explode(F.array(*[(first + i * step).bitwiseAND(mask) for i in range(PROBES)])).alias("bit")
    for part in range(parts):
        own = hashes if parts == 1 else hashes.where((F.pmod(F.shiftrightunsigned("h", 1), F.lit(parts)) * 2 + F.col("h").bitwiseAND(1)) % parts == part)  # of the unsigned hash
        blocks = own.select(cell).groupBy(F.shiftright("bit", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(32767)).alias("bits"))
        out = np.zeros(1 << (bits - 3), np.uint8)
        for block, held in blocks.toLocalIterator():
            out[block * 4096:(block + 1) * 4096] = np.frombuffer(held, np.uint8)
        yield Screen(bits, out, part, parts)


def training_windows(docs: DataFrame, screen: Screen, span: int, substitutions: int, short: list[int], key: list[str], text: str) -> DataFrame:
    """(key columns, pos, n, win): windows of the training texts with a seed hash in the bitmap; ``short``: the window kinds below ``span``."""
    shared = docs.sparkSession.sparkContext.broadcast(screen)
    src = docs.select(*key, F.col(text).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits = _Words(), shared.value
        plans = [plan_of(n, span, substitutions) for n in [span, *short] if n > 0]
        whole = {-n for n in short if n < 0}
        out = [*key, "pos", "n", "win"]

        def search(docs: list[tuple[int, list[str]]], b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate([np.fromiter(map(words.__getitem__, t), np.uint64, len(t)) for _, t in docs])
            ends = np.cumsum([len(t) for _, t in docs])
            rows, poss, ns, wins = [], [], [], []
            for plan in plans:
                for at in _hits(bits, tokens, plan).tolist():
                    d = int(np.searchsorted(ends, at, side="right"))
                    if at + plan.n <= ends[d]:  # a window lies in one text
                        row, toks = docs[d]
                        p = at - (ends[d] - len(toks))
                        rows.append(row)
                        poss.append(p)
                        ns.append(plan.n)
                        wins.append(" ".join(toks[p:p + plan.n]))
            for row, toks in docs:
                if len(toks) in whole and len(_hits(bits, np.fromiter(map(words.__getitem__, toks), np.uint64, len(toks)), unspaced(len(toks)))):
                    rows.append(row)
                    poss.append(0)
                    ns.append(-len(toks))
                    wins.append(" ".join(toks))
            if rows:
                at = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(i).take(at) for i in range(len(key))] + [pa.array(poss, pa.int32()), pa.array(ns, pa.int32()), pa.array(wins, pa.string())], out)

        for b in batches:
            docs, held = [], 0
            for r, t in enumerate(b.column(len(key)).to_pylist()):
                toks = _TOKEN.findall(t.lower()) if t else []
                if toks:
                    docs.append((r, toks))
                    held += len(toks)
                if held >= _SLICE:
                    yield from search(docs, b)
                    docs, held = [], 0
            if docs:
                yield from search(docs, b)

    return src.mapInArrow(run, f"{schema}, pos int, n int, win string")


def _hashed(windows: DataFrame, span: int, substitutions: int) -> DataFrame:
    """(n, win, h): the seed hashes of distinct windows, a row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, plans = _Words(), cache(lambda n: plan_of(n, span, substitutions))
        for b in batches:
            ns, wins, hs = [], [], []
            for n, win in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                toks = win.split(" ")
                h = np.fromiter(map(words.__getitem__, toks), np.uint64, len(toks))
                for seed in _seed_hashes(h, plans(n)):
                    ns.append(n)
                    wins.append(win)
                    hs.append(seed[0])
            yield pa.RecordBatch.from_arrays([pa.array(ns, pa.int32()), pa.array(wins, pa.string()), pa.array(np.array(hs, np.uint64).view(np.int64))], ["n", "win", "h"])

    return windows.mapInArrow(run, "n int, win string, h bigint")


def overlaps(docs: DataFrame, items: DataFrame, key: list[str], span: int = 13, substitutions: int = 2, min_item: int = 5,
             text: str = "text", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(key columns, item_id, windows, first_pos, last_pos, matched): every contaminated text with every item found in it.

    ``windows``: how many windows of the text match; ``matched``: most equal tokens in one window.
    """
    row = docs.select(F.struct(*[F.col(f"`{k}`") for k in key]).alias("key"), F.col(f"`{text}`").alias("text"))  # key columns may be called as ours
    bench = cut(item_windows(items, span, substitutions, min_item, item_text, item_id), "decon-items")
    hashes = cut(bench.select("n", "win", F.explode("h").alias("h")).distinct(), "decon-hashes")
    short = sorted(r[0] for r in bench.where(F.col("n") < span).select("n").distinct().collect())  # below span + min_item values
    hits = reduce(DataFrame.unionAll, [cut(training_windows(row, s, span, substitutions, short, ["key"], "text"), "decon-hits") for s in screens(hashes.select("h").distinct())])
    met = (_hashed(hits.select("n", "win").distinct(), span, substitutions).alias("d")
           .join(hashes.alias("i"), F.expr("d.h = i.h and d.n = i.n"))
           .select("d.n", F.col("d.win").alias("win"), F.col("i.win").alias("item_win")).distinct())
    equal = F.aggregate(F.zip_with(F.split("win", " "), F.split("item_win", " "), lambda x, y: (x == y).cast("int")), F.lit(0), lambda a, x: a + x)
    least = F.when(F.col("n") < 0, -F.col("n")).otherwise(F.col("n") - F.when(F.col("n") == span, substitutions).otherwise(F.floor(F.col("n") * substitutions / span)))
    same = met.withColumn("matched", equal).where(F.col("matched") >= least)
    # item windows -> items, best match of a window first, so that shared passages meet few rows
    found = (same.join(bench.select(F.col("win").alias("item_win"), "n", "item_id").distinct(), ["item_win", "n"])
             .groupBy("win", "n", "item_id").agg(F.max("matched").alias("matched")))
    pairs = hits.join(found, ["win", "n"]).groupBy("key", "item_id").agg(
        F.countDistinct("pos").alias("windows"), F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.max("matched").alias("matched"))
    return pairs.select("key.*", "item_id", "windows", "first_pos", "last_pos", "matched")


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose texts are clean (null texts are)."""
    row = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.xxhash64(text).alias("h"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("m"))
    bad = overlaps(row.select("h", "m", "text"), items, ["h", "m"], **how).select("h", "m").distinct()
    return row.join(bad, ["h", "m"], "left_anti").select("row.*")


def op1_spaced_seed_overlaps(spark, sf_dir: str) -> DataFrame:
    return overlaps(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), ["doc_id"])
