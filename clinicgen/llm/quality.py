"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Random indexing: every word and every word shape has a sparse ternary index vector (``NONZERO``
entries of +1 or -1 among ``DIM``); its context vector is the sum of the index vectors of its
neighbours over the whole corpus, summed in integers so that the order of tasks does not matter.
Words are hashed into ``BUCKETS`` rows, which fixes the size of the table (8 MB) that is summed and
broadcast, whatever the corpus. A document is the mean of the unit context vectors of its
words and of its shapes, the logarithm of its length, and how often it repeats words.

The network (tanh layer, sigmoid output) is fitted by Adam in numpy on at most ``max_train``
labelled documents (those of least id hash), one fifth of which is held back to fit the temperature
that its logits are divided by. Every document is scored over its whole text.

Cases: null and empty texts have a zero vector and get a score; rows without a label, or with an unknown
or null id, are never learned from; several labels of one id are averaged; with no or one-sided labels the score is
the rate of label 1 (one half without any); an empty table gives an empty result.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read, without

BUCKETS, DIM, NONZERO = 1 << 14, 64, 4
_FLUSH = 1 << 20
_LETTER, _RUN = re.compile(r"[^\W\d_]+"), re.compile(r"(.)\1+", re.S)


@lru_cache(4096)
def _shape(w: str) -> str:
    """Letters by case, digits as 0, other characters themselves; runs are one."""
    kinds = _LETTER.sub(lambda m: "".join("A" if c.isupper() else "a" for c in m[0]), w)
    return _RUN.sub(r"\1", re.sub(r"\d", "0", kinds))


class _Names(dict):
    """Word -> 64-bit hash of its letters, so that repeats are counted on the words themselves; forgets when it holds 800,000."""

    def __missing__(self, w: str) -> int:
        if len(self) >= 800_000:
            self.clear()
        core = w.strip(string.punctuation)
        bare = core.lower() if core.isalpha() else "".join(_LETTER.findall(w)).lower() or w
        h = self[w] = xxhash.xxh64_intdigest(bare.encode("utf-8", "surrogatepass"))
        return h


class _Ids(dict):
    """Word -> rows of the word and of its shape in one number; words take the lower half of the table."""

    def __init__(self) -> None:
        super().__init__()
        self.names = _Names()

    def __missing__(self, w: str) -> int:
        if len(self) >= 800_000:
            self.clear()
        core = w.strip(string.punctuation)
        if core.isalpha():
            at = w.index(core)
            mid = "a" if core.islower() else "A" if core.isupper() else "Aa" if core[0].isupper() and core[1:].islower() else _shape(core)
            bare, shape = core.lower(), _shape(w[:at]) + mid + _shape(w[at + len(core):])
        else:
            bare, shape = "".join(_LETTER.findall(w)).lower() or w, _shape(w)
        row, shape_row = (zlib.crc32(x.encode("utf-8", "surrogatepass")) % (BUCKETS // 2) for x in (bare, shape))
        ids = self[w] = row << 16 | BUCKETS // 2 + shape_row
        return ids

    def rows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(rows of the words, rows of their shapes)"""
        both = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        return both >> 16, both & 0xFFFF


def index_vectors(seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(positions, signs) of the nonzero entries of every row's index vector."""
    rng = np.random.default_rng(seed)
    at = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return at.astype(np.int32), rng.choice(np.array([-1, 1], np.int8), (BUCKETS, NONZERO))


def _add_contexts(table: np.ndarray, seqs: list[np.ndarray], slot: np.ndarray) -> None:
    """Adds the neighbours' index vectors to the rows of each sequence's members (a -1 stands between documents)."""
    ids = np.concatenate(seqs).astype(np.int64)
    ok = (ids[:-1] >= 0) & (ids[1:] >= 0)
    left, right = ids[:-1][ok], ids[1:][ok]
    for target, near in ((left, right), (right, left)):
        base = target * (2 * DIM)
        for j in range(NONZERO):  # +1 and -1 are counted apart: integer counts need no weights
            both = np.bincount(base + slot[j][near], minlength=2 * BUCKETS * DIM).reshape(BUCKETS, 2, DIM)
            table += (both[:, 0] - both[:, 1]).reshape(-1)


def context_table(docs: DataFrame, text: str = "text", seed: int = 3, blocks: int = 64) -> np.ndarray:
    """BUCKETS x DIM context vectors of the whole corpus; tasks add up locally, then block by block."""
    rows = BUCKETS * DIM // blocks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sign = index_vectors(seed)
        slot = np.ascontiguousarray((at + DIM * (sign < 0)).T.astype(np.int64))
        ids, table = _Ids(), np.zeros(BUCKETS * DIM, np.int64)
        seqs, n = [], 0
        gap = np.array([-1], np.int32)
        for b in batches:
            for t in b.column(0).to_pylist():
                words = (t or "").split()
                if not words:
                    continue
                row, shape = ids.rows(words)
                seqs += [row, gap, shape, gap]
                n += 2 * len(words)
                if n >= _FLUSH:
                    _add_contexts(table, seqs, slot)
                    seqs, n = [], 0
        if seqs:
            _add_contexts(table, seqs, slot)
        for k in range(blocks):
            part = table[k * rows:(k + 1) * rows]
            if part.any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([k], pa.int32()), "part": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())})

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(rows, np.int64)
        for p in parts:
            for x in p["part"]:
                total += np.frombuffer(zlib.decompress(x), np.int64)
        yield pd.DataFrame({"block": [key[0]], "part": [total.tobytes()]})

    summed = docs.select(text).mapInArrow(run, "block int, part binary").groupBy("block").applyInPandas(add, "block int, part binary")
    table = np.zeros(BUCKETS * DIM, np.int64)
    for k, part in summed.collect():  # 64 blocks of fixed size, 8 MB in all
        table[k * rows:(k + 1) * rows] = np.frombuffer(part, np.int64)
    return table.reshape(BUCKETS, DIM)


def unit_rows(table: np.ndarray) -> np.ndarray:
    """Context vectors without their common direction, at unit length."""
    t = table.astype(np.float64)
    t /= np.maximum(np.linalg.norm(t, axis=1, keepdims=True), 1.0)
    used = (table != 0).any(axis=1)
    if used.any():
        for half in (slice(0, BUCKETS // 2), slice(BUCKETS // 2, BUCKETS)):
            u = used[half]
            if u.any():
                t[half][u] -= t[half][u].mean(axis=0)
    t /= np.maximum(np.linalg.norm(t, axis=1, keepdims=True), 1e-9)
    t[~used] = 0
    return t.astype(np.float32)


FEATURES = 2 * DIM + 3


def pooled(text: str | None, vectors: np.ndarray, ids: _Ids) -> np.ndarray:
    """Mean word vector, mean shape vector, log length, share of words that repeat the one before, share of distinct words."""
    words = (text or "").split()
    out = np.zeros(FEATURES, np.float32)
    if words:
        n = len(words)
        for k, row in enumerate(ids.rows(words)):
            total = np.zeros(DIM)
            for i in range(0, n, 1 << 12):
                total += vectors[row[i:i + (1 << 12)]].sum(axis=0)
            out[k * DIM:(k + 1) * DIM] = total / n
        name = np.fromiter(map(ids.names.__getitem__, words), np.uint64, n)
        out[-2:] = (name[1:] == name[:-1]).mean() if n > 1 else 0, len(np.unique(name)) / n
        out[-3] = np.log1p(n)
    return out


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 3e-3, decay: float = 1e-4, seed: int = 1) -> Network:
    rng = np.random.default_rng(seed)
    d = x.shape[1] if x.size else FEATURES
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))), 1.0)
    order = rng.permutation(len(y))
    held, used = order[:len(y) // 5], order[len(y) // 5:]
    mean, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
    a = (x - mean) / scale
    p = [rng.normal(0, 1 / np.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v, step = [np.zeros_like(q) for q in p], [np.zeros_like(q) for q in p], 0
    for _ in range(epochs):
        used = rng.permutation(used)
        for s in range(0, len(used), 256):
            xb, yb = a[used[s:s + 256]], y[used[s:s + 256]]
            h = np.tanh(xb @ p[0] + p[1])
            e = (1 / (1 + np.exp(-(h @ p[2] + p[3][0]))) - yb) / len(yb)
            back = np.outer(e, p[2]) * (1 - h * h)
            grads = [xb.T @ back + decay * p[0], back.sum(axis=0), h.T @ e + decay * p[2], np.array([e.sum()])]
            step += 1
            for q, g, mm, vv in zip(p, grads, m, v, strict=True):
                mm += 0.1 * (g - mm)
                vv += 0.001 * (g * g - vv)
                q -= rate * (mm / (1 - 0.9 ** step)) / (np.sqrt(vv / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    check = held if len(held) else used
    z = net.logits(x[check])
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    net.temperature = float(grid[int(np.argmin([_loss(z / t, y[check]) for t in grid]))])
    return net


def _learnable(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_train: int = 20_000, text: str = "text") -> tuple[np.ndarray, Network]:
    """(word vectors of the whole corpus, network fitted on at most ``max_train`` labelled rows)."""
    vectors = unit_rows(context_table(docs, text))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    present = docs.select("doc_id").distinct()  # the bound counts labels that have a document
    picked = (labels.where(F.col("quality").isNotNull() & _learnable(F.col("doc_id"))).groupBy("doc_id").agg(F.avg("quality").alias("y"))
              .join(present, "doc_id", "left_semi")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train))
    sample = cut(picked, "quality-sample")
    # one row per id, that of the least hash of its texts, so that copies of a labelled row do not outgrow the bound
    texts = docs.select("doc_id", text).join(F.broadcast(sample), "doc_id").select("doc_id", F.col(text).alias("t"), "y", F.xxhash64(text).alias("h"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids()
        for b in batches:
            x = [pooled(t, shared.value, ids).tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.binary()), b.column(3)], ["doc_id", "y", "x", "h"])

    pooled_rows = texts.mapInArrow(run, "doc_id bigint, y double, x binary, h bigint")
    rows = pooled_rows.groupBy("doc_id").agg(F.min(F.struct("h", "x", "y")).alias("r")).select("doc_id", "r.y", "r.x").collect()  # max_train rows at most
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64).reshape(len(rows), FEATURES)
    y = np.array([float(r["y"] >= 0.5) for r in rows])
    return vectors, fit(x, y)


def score_column(docs: DataFrame, vectors: np.ndarray, net: Network, text: str = "text") -> Column:
    shared = docs.sparkSession.sparkContext.broadcast((vectors, net))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids = _Ids()
        v, n = shared.value
        for texts in batches:
            x = np.array([pooled(t, v, ids) for t in texts], np.float64).reshape(len(texts), FEATURES)
            yield pd.Series(n.predict(x))
    return score(F.col(text))


def score_quality(docs: DataFrame, labels: DataFrame, text: str = "text", max_train: int = 20_000) -> DataFrame:
    """``docs`` with ``score``: the probability of label 1."""
    vectors, net = train(docs, labels, max_train, text)
    keep = without(docs, "score")
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    return row.withColumn("score", score_column(docs, vectors, net, f"row.{text}")).select(*[F.col(f"row.`{c}`") for c in keep], "score")


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **how) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more."""
    cols = docs.columns
    row = docs.select(F.struct("*").alias("row"), F.col("text").alias("text"))
    vectors, net = train(docs, labels, **how)
    return row.where(score_column(docs, vectors, net) >= threshold).select(*[F.col(f"row.`{c}`") for c in cols])


def op6_quality_scores(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, read(spark, sf_dir, "labels"))
    return scored.select("doc_id", (~_learnable(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
