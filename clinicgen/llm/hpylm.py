"""Hierarchical Pitman-Yor language model, seated by Gibbs sampling.

A restaurant per context (the previous word, by its 64-bit hash) has the customers ``count(context, word)``; a table serves one word and sends a customer
to the parent, the unigram restaurant that all contexts share; its base is uniform over the known words and one unknown.
Predictive probability of word w after context u, with c customers and t tables:

    P(w|u) = (c_uw - d t_uw + (theta + d T_u) P(w)) / (theta + c_u)

and alike in the parent; it is averaged over Gibbs samples.

On Spark: chunks of texts are counted into distinct (word, context) types, so a pair that fills a third
of the corpus is one entry per chunk. Types are dealt by word into buckets, where
seats matter only by the number of a type's tables: a sweep draws that number anew from its law given all else (``Dishes``), at
once for all customers of the type, and so does the parent. All that a bucket needs from others are totals per context and
of the parent; each bucket's sums are added up by context in the shared folder after a sampling round, joined back to
the buckets that know the context and, but for the bucket's own share, taken as fixed in the next (parallel Gibbs
with totals one round old). Tables of children and parent are written after a round, and the next goes on from them. The last round sends every chunk the averaged log probabilities of its own types, and the chunk adds them up by
document. Discounts are estimated from the counts of counts, n1 / (n1 + 2 n2).

Chunks and buckets both follow the input, so a row is dealt to at most ``FAN`` cells: beyond that many buckets, slices of them are dealt first, and groups of
chunks are merged within a slice before they are dealt to its buckets (``regroup``, ``ungroup``). The types are exchanged once (twice beyond): a bucket keeps the places of each chunk's types.

Cases: null and empty texts are the end token alone; a null id is held out; repeated rows are scored each; with no
training text every word is unknown; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import read, release, unique_path, write

CHUNK_TOKENS = 2_000_000
BUCKET_TYPES = 1_500_000
END, START = xxhash.xxh64_intdigest(b" end"), xxhash.xxh64_intdigest(b" start")  # no word holds a space


def pack(a: np.ndarray) -> bytes:
    """Byte planes of an integer or float array, compressed; integers in the least width that holds them."""
    if a.dtype.kind in "iu":
        top = int(a.max()) if len(a) else 0
        a = a.astype(next(t for t in ("<u1", "<u2", "<u4", "<u8") if top < 1 << 8 * int(t[2])))
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return a.dtype.str.encode() + zstandard.compress(planes.tobytes(), 1)


def unpack(b: bytes) -> np.ndarray:
    kind = np.dtype(b[:3].decode())
    planes = np.frombuffer(zstandard.decompress(b[3:]), np.uint8).reshape(kind.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _steps(ascending: np.ndarray) -> bytes:
    return pack(np.diff(ascending.astype(np.uint64), prepend=np.uint64(0)))


def _from_steps(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b).astype(np.uint64), dtype=np.uint64)


class _Words(dict):
    """Word -> 64-bit hash; forgets when it holds 400,000."""

    def __missing__(self, w: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        h = self[w] = xxhash.xxh64_intdigest(w)
        return h


def held_out(doc_id: int | None) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 7 == 2


def _chunk_row(chunk: int, pieces: list[tuple[int, int | None, np.ndarray]]) -> dict:
    """One chunk: pieces are (row id, doc id, word hashes led by the word before)."""
    sizes = np.array([len(p[2]) - 1 for p in pieces])
    words, at = np.unique(np.concatenate([p[2] for p in pieces]), return_inverse=True)  # a word that is only a context has no types
    begin = np.cumsum(sizes + 1) - sizes - 1
    doc = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
    train = np.repeat(np.array([not held_out(p[1]) for p in pieces]), sizes)
    lead, last = np.ones(len(at), bool), np.ones(len(at), bool)
    lead[begin], last[begin + sizes] = False, False
    key = (at[lead] << 32) | at[last]  # (word, the one before it)
    del at, lead, last
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return {"chunk": chunk, "words": pack(words), "per_word": pack(np.bincount(key[first] >> 32, minlength=len(words))), "ctx": pack(key[first] & 0xFFFFFFFF),
            "count": pack(np.diff(np.r_[first, len(key)])), "train": pack(np.add.reduceat(train[order].astype(np.int64), first)),
            "docs": pack(doc[order]), "rids": pack(np.array([p[0] for p in pieces], np.int64)),
            "doc_ids": [p[1] for p in pieces], "n_types": len(first), "n_train": int(train.sum())}


_CHUNK = pa.schema([("chunk", pa.int64()), *[(c, pa.binary()) for c in ("words", "per_word", "ctx", "count", "train", "docs", "rids")],
                    ("doc_ids", pa.list_(pa.int64())), ("n_types", pa.int64()), ("n_train", pa.int64())])
_CHUNK_SQL = ("chunk bigint, words binary, per_word binary, ctx binary, count binary, train binary, docs binary, rids binary, "
              "doc_ids array<bigint>, n_types bigint, n_train bigint")


def chunks(docs: DataFrame, text: str = "text", tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Counted chunks of all texts; a long text may run over several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, row, n_chunks = TaskContext.get().partitionId() << 33, 0, 0
        words, pieces, held = _Words(), [], 0
        for b in batches:
            for doc_id, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                toks = (t or "").encode("utf-8", "surrogatepass").lower().split()
                h = np.empty(len(toks) + 2, np.uint64)
                h[0], h[-1] = START, END
                h[1:-1] = np.fromiter(map(words.__getitem__, toks), np.uint64, len(toks))
                for s in range(0, len(h) - 1, tokens):
                    pieces.append((base + row, doc_id, h[s:s + tokens + 1]))
                    held += len(pieces[-1][2]) - 1
                    if held >= tokens:
                        yield pa.RecordBatch.from_pylist([_chunk_row(base + n_chunks, pieces)], schema=_CHUNK)
                        pieces, held, n_chunks = [], 0, n_chunks + 1
                row += 1
        if pieces:
            yield pa.RecordBatch.from_pylist([_chunk_row(base + n_chunks, pieces)], schema=_CHUNK)

    return docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, _CHUNK_SQL)


FAN = 1024  # cells that a row is dealt to at most, so that cells keep a size and their number follows the input
_CELL = "bucket int, chunk bigint, words binary, per_word binary, ctxs binary, ctx binary, train binary"


def _cells(chunk: int, words: np.ndarray, per_word: np.ndarray, names: np.ndarray, ctx: np.ndarray, train: np.ndarray, buckets: int, own: range) -> Iterator[dict]:
    """The types (by word; contexts as places in ``names``) of each bucket in ``own``, equal slices of the hashes; buckets without any are left out."""
    bucket = ((words.astype(np.uint64) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    ends, upto = np.searchsorted(bucket, np.arange(own.start, own.stop + 1)), np.r_[0, np.cumsum(per_word, dtype=np.int64)]
    for k, i, j in zip(own, ends, ends[1:], strict=False):
        if i < j:
            s, e = upto[i], upto[j]
            near, place = np.unique(ctx[s:e], return_inverse=True)
            yield {"bucket": k, "chunk": chunk, "words": pack(words[i:j]), "per_word": pack(per_word[i:j]), "ctxs": _steps(names[near]), "ctx": pack(place), "train": pack(train[s:e])}


def by_bucket(counted: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, words, per_word, ctxs, ctx, train): every chunk's types, dealt by word; ``ctx`` are places in ``ctxs``, the steps between sorted hashes."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), *[(c, pa.binary()) for c in ("words", "per_word", "ctxs", "ctx", "train")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, *blobs in zip(*[c.to_pylist() for c in b.columns], strict=True):
                words, per_word, ctx, train = map(unpack, blobs)
                for cell in _cells(chunk, words, per_word, words, ctx, train, buckets, range(buckets)):
                    yield pa.RecordBatch.from_pylist([cell], schema=schema)

    return counted.select("chunk", "words", "per_word", "ctx", "train").mapInArrow(run, _CELL)


def regroup(cells: DataFrame, groups: int, per: int, buckets: int) -> DataFrame:
    """The second level of the deal: the cells of a group of chunks in one slice of the hashes are merged and cut into the slice's ``per`` buckets.

    Rows of block 0 are cells as those of ``by_bucket``, with the group as their chunk; rows of block -2 give, for each (group, slice, chunk), the places
    of the chunk's words and types among the merged ones.
    """
    columns = ["block", "grp", *[c.split()[0] for c in _CELL.split(", ")]]

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        b = _Bucket(rows)
        merged = _cells(key[0], b.words, np.bincount(b.word, minlength=len(b.words)), b.ctxs, b.ctx, b.count, buckets, range(key[1] * per, (key[1] + 1) * per))
        out = [{"block": 0, "grp": key[0], **c} for c in merged] + [{**r, "grp": key[0], "bucket": key[1]} for r in b.placed()]
        return pd.DataFrame({c: pd.Series([r.get(c) for r in out], dtype=None if c in ("block", "grp", "bucket", "chunk") else object) for c in columns})

    grp = F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("grp")
    return cells.select(grp, "*").groupBy("grp", "bucket").applyInPandas(run, f"block int, grp bigint, {_CELL}")


def ungroup(answers: DataFrame, merged: DataFrame, per: int) -> DataFrame:
    """Answers of groups (chunk, bucket, logs, known) as answers of their chunks, by slice."""
    def run(key: tuple, placed: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        parts = parts.sort_values("bucket")
        logs, known = (np.concatenate([unpack(x) for x in parts[c]]) for c in ("logs", "known"))
        at = lambda c: [_from_steps(x).astype(np.int64) for x in placed[c]]
        return pd.DataFrame({"chunk": placed["chunk"], "bucket": key[1], "logs": [pack(logs[i]) for i in at("ctx")], "known": [pack(known[i]) for i in at("words")]})

    left = merged.where("block = -2").select("grp", F.col("bucket").alias("slice"), "chunk", "words", "ctx")
    right = answers.select(F.col("chunk").alias("grp"), F.floor(F.col("bucket") / per).cast("int").alias("slice"), "bucket", "logs", "known")
    return left.groupBy("grp", "slice").cogroup(right.groupBy("grp", "slice")).applyInPandas(run, "chunk bigint, bucket int, logs binary, known binary")


class Totals(NamedTuple):
    """What buckets share: tables and customers of the contexts that a bucket knows, and of the parent."""
    tables: np.ndarray
    customers: np.ndarray
    root_tables: float
    root_customers: float
    vocabulary: int
    discount: float
    root_discount: float


def _discount(counts: np.ndarray) -> tuple[int, int]:
    return int((counts == 1).sum()), int((counts == 2).sum())


def _rate(n1: float, n2: float) -> float:
    return min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5


ORDER = 8


def _occupancy(ns: np.ndarray, d: float, width: int) -> Iterator[np.ndarray]:
    """For each of the ascending ``ns``, log q_n(t) for t = 1 .. min(n, width).

    q_n(t) = S(n, t) / S(n, 1) d**(t-1) (t-1)!, with S the generalized Stirling numbers of discount d, goes from n to n + 1 by
    (1 - x) q_n(t) + x q_n(t-1), x = d (t-1) / (n-d). The steps are powers of one matrix, so from 4,096 customers on many are taken
    together, by a series in x to the ``ORDER``-th term: as many as make the sum of x at most 1, so that what is left out is below 1 / (ORDER + 1)!.
    """
    q = np.zeros(width, np.longdouble)  # long: few tables are far likelier than many, and the weights may ask for many
    q[0], n, pull = 1, 1, d * np.arange(1, width, dtype=np.longdouble)
    reach = 1 / (d * width)
    for goal in ns.tolist():
        while n < goal:
            k = min(goal - n, max(1, int(reach * n))) if n >= 4096 else 1
            m = min(width, n + k)
            if k < 8:
                for _ in range(k):
                    m = min(width, n + 1)
                    q[1:m] += pull[:m - 1] * (q[:m - 1] - q[1:m]) / (n - d)
                    n += 1
                continue
            lo, hi = n - d - 0.5, n + k - d - 0.5
            power = [math.log(hi / lo)] + [(lo ** -i - hi ** -i) / i for i in range(1, ORDER)]  # sums of 1 / (n-d), 1 / (n-d)**2, ... over the steps
            e = [1.0]  # and of the products of any 1, 2, ... of them, by Newton's identities
            for i in range(1, ORDER + 1):
                e.append(sum((-1) ** (j - 1) * e[i - j] * power[j - 1] for j in range(1, i + 1)) / i)
            step, total = q, q
            for c in e[1:]:
                step = np.r_[0, pull * (step[:-1] - step[1:])]
                total = total + c * step
            q = np.maximum(total, 0)
            n += k
        with np.errstate(divide="ignore"):
            yield np.log(q[:min(n, width)]).astype(np.float64)


class Dishes:
    """Tables of many dishes. Given their customers, only the number of tables counts, and its law is known: with weight
    new + more k of the table after the k-th, P(t) is proportional to S(n, t) times the weights of the tables 2 to t."""

    def __init__(self, counts: np.ndarray, discount: float, rng: np.random.Generator, tables: np.ndarray | None = None) -> None:
        self.c, self.d, self.rng = counts.astype(np.int64), discount, rng
        self.tables = np.minimum(self.c, 1) if tables is None else np.clip(tables, np.minimum(self.c, 1), self.c)

    def draw(self, new: np.ndarray, more: np.ndarray) -> None:
        """Draws the tables of all dishes, whatever they hold."""
        many = np.flatnonzero(self.c >= 2)
        if not len(many):
            return
        a, g = new / self.d, more / self.d
        rest = np.maximum(1 - g, 1e-3)
        spread = a / rest
        top = np.minimum(self.c, 42 + spread + 10 * np.sqrt(spread / rest)).astype(np.int64)  # tables beyond have no weight left
        # dishes of like widths together: the cost of a law is its customers times its width, and few dishes are wide
        kind = np.searchsorted([64, 512, 4096], top[many])
        for k in range(4):
            if (kind == k).any():
                self._draw(many[kind == k], a, g, top)

    def _draw(self, many: np.ndarray, a: np.ndarray, g: np.ndarray, top: np.ndarray) -> None:
        many = many[np.argsort(self.c[many], kind="stable")]
        n, a, g, top = self.c[many], a[many], g[many], top[many]
        ns, first = np.unique(n, return_index=True)
        ends = np.r_[first[1:], len(n)]
        for s, e, log_q in zip(first, ends, _occupancy(ns, self.d, int(top.max())), strict=True):
            w = int(top[s:e].max())
            k = np.arange(1, w)
            rows = max(1, 2_000_000 // w)
            for i in range(s, e, rows):
                j = min(e, i + rows)
                logs = np.zeros((j - i, w))
                np.cumsum(np.log(a[i:j, None] / k + g[i:j, None]), axis=1, out=logs[:, 1:])
                logs += log_q[:w]
                logs -= logs.max(axis=1, keepdims=True)
                upto = np.cumsum(np.exp(logs), axis=1)
                self.tables[many[i:j]] = 1 + (upto[:, :-1] <= self.rng.random((j - i, 1)) * upto[:, -1:]).sum(axis=1)


class _Bucket:
    """The types of one bucket, merged over the chunks."""

    def __init__(self, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("chunk") if len(rows) > 1 else rows
        self.chunks = rows["chunk"].tolist()
        if len(rows) == 1 and "ctxs" in rows:  # one cell, or the merged types of all: each word, context and type once and in order
            row = rows.iloc[0]
            self.words, self.ctxs = unpack(row["words"]).astype(np.uint64), _from_steps(row["ctxs"])
            self.word, self.ctx = np.repeat(np.arange(len(self.words)), unpack(row["per_word"])), unpack(row["ctx"]).astype(np.int64)
            self.word_of, self.type_of = [np.arange(len(self.words))], [np.arange(len(self.word))]
            self._count(unpack(row["train"]).astype(np.int64))
            return
        words = [unpack(x).astype(np.uint64) for x in rows["words"]]
        per_word, ctx = [unpack(x).astype(np.int64) for x in rows["per_word"]], [unpack(x) for x in rows["ctx"]]
        if "ctxs" in rows:
            ctx = [_from_steps(x)[c] for x, c in zip(rows["ctxs"], ctx, strict=True)]
        self.words, at = np.unique(np.concatenate(words), return_inverse=True)
        ends = np.cumsum([len(w) for w in words])
        self.word_of = np.split(at, ends[:-1])  # per chunk
        self.ctxs, place = np.unique(np.concatenate(ctx).astype(np.uint64), return_inverse=True)
        key = np.concatenate([np.repeat(a, n) for a, n in zip(self.word_of, per_word, strict=True)]) << 32 | place
        types, inv = np.unique(key, return_inverse=True)
        self.type_of = np.split(inv, np.cumsum([len(c) for c in ctx])[:-1])
        self.word, self.ctx = types >> 32, types & 0xFFFFFFFF
        train = np.concatenate([unpack(x) for x in rows["train"]]).astype(np.float64)
        self._count(np.bincount(inv, weights=train, minlength=len(types)).astype(np.int64))

    def _count(self, count: np.ndarray) -> None:
        self.count = count
        self.word_count = np.bincount(self.word, weights=count, minlength=len(self.words)).astype(np.int64)

    def placed(self) -> list[dict]:
        """Per chunk, the places of its words and types among the merged ones (both ascend)."""
        return [{"block": -2, "chunk": c, "words": _steps(w), "ctx": _steps(t)} for c, w, t in zip(self.chunks, self.word_of, self.type_of, strict=True)]


class _Sampler:
    """Tables of one bucket; ``shared`` follows the bucket's own changes."""

    def __init__(self, b: _Bucket, total: Totals | None, buckets: int, theta: float, seed: int, tables: np.ndarray | None = None, top: np.ndarray | None = None) -> None:
        self.b, self.theta, self.rng = b, theta, np.random.default_rng(seed)
        self.shared = total
        if total is None:  # nothing is shared yet: a table per type, and this bucket's own totals, scaled, stand in for those of all
            one = np.minimum(b.count, 1)
            n = np.bincount(b.ctx, weights=one, minlength=len(b.ctxs))
            known = int((b.word_count > 0).sum())
            self.shared = Totals(n * buckets, np.bincount(b.ctx, weights=b.count, minlength=len(b.ctxs)) * buckets, known * buckets, one.sum() * buckets,
                                 known * buckets, _rate(*_discount(b.count)), _rate(*_discount(np.bincount(b.word, weights=one, minlength=len(b.words)))))
        self.seats = Dishes(b.count, self.shared.discount, self.rng, tables)
        self.sent = self._sent()
        self.top = Dishes(self.sent, self.shared.root_discount, self.rng, top)

    def _sent(self) -> np.ndarray:
        return np.bincount(self.b.word, weights=self.seats.tables, minlength=len(self.b.words)).astype(np.int64)

    def root(self) -> None:
        """The parent's customers are the children's tables."""
        g, b = self.shared, self.b
        self.sent, before = self._sent(), self.top.tables
        self.top = Dishes(self.sent, g.root_discount, self.rng, before)
        self.top.draw((self.theta + g.root_discount * np.maximum(g.root_tables - before, 0)) / (g.vocabulary + 1), np.full(len(b.words), g.root_discount / (g.vocabulary + 1)))
        self.shared = g = g._replace(root_tables=max(g.root_tables + float((self.top.tables - before).sum()), float(self.top.tables.sum())))
        new = (self.theta + g.root_discount * g.root_tables) / (g.vocabulary + 1)
        self.p_word = (self.sent - g.root_discount * self.top.tables + new) / (self.theta + g.root_customers)

    def sweep(self, times: int = 1) -> None:
        for _ in range(times):
            self.root()
            g, b, before = self.shared, self.b, self.seats.tables.copy()
            p = self.p_word[b.word]
            self.seats.draw((self.theta + g.discount * np.maximum(g.tables[b.ctx] - before, 0)) * p, g.discount * p)
            change = self.seats.tables - before
            self.shared = g._replace(tables=g.tables + np.bincount(b.ctx, weights=change, minlength=len(g.tables)), root_customers=g.root_customers + float(change.sum()))

    def predictive(self) -> np.ndarray:
        g, b = self.shared, self.b
        own = b.count - g.discount * self.seats.tables
        return (own + (self.theta + g.discount * g.tables[b.ctx]) * self.p_word[b.word]) / (self.theta + g.customers[b.ctx])


_STATE = "bucket int, block int, chunk bigint, words binary, per_word binary, ctxs binary, ctx binary, train binary, tables binary, customers binary, scalars array<double>"


def _state(bucket: int, blocks: int, b: _Bucket, s: _Sampler, more: list[dict] | None = None) -> pd.DataFrame:
    """What a bucket writes: in block -1 its tables, in blocks from 0 on its share of the contexts' totals; and ``more`` rows."""
    tables, customers = (np.bincount(b.ctx, weights=x, minlength=len(b.ctxs)).astype(np.int64) for x in (s.seats.tables, b.count))
    scalars = [float(s.top.tables.sum()), float(s.sent.sum()), float((b.word_count > 0).sum()), *map(float, _discount(b.count)), *map(float, _discount(s.sent))]
    rows = [{"block": -1, "tables": pack(s.seats.tables), "customers": pack(s.top.tables), "scalars": scalars}]
    ends = np.searchsorted(((b.ctxs >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32), np.arange(blocks + 1))
    rows += [{"block": k, "ctxs": _steps(b.ctxs[i:j]), "tables": pack(tables[i:j]), "customers": pack(customers[i:j])} for k, (i, j) in enumerate(zip(ends, ends[1:], strict=False)) if i < j]
    rows += more or []
    empty = {c.split()[0]: None for c in _STATE.split(", ")} | {"bucket": bucket, "chunk": -1}
    return pd.DataFrame({c: pd.Series([(empty | r)[c] for r in rows], dtype=None if c in ("bucket", "block", "chunk") else object) for c in empty})


def _begin(dealt: DataFrame, buckets: int, theta: float, blocks: int | None = None) -> DataFrame:
    """The state with one table per type; block -1 also holds a bucket's types, merged over the chunks, and block -2 a row per chunk with the places of its own."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        b = _Bucket(rows)
        out = _state(key[0], blocks or buckets, b, _Sampler(b, None, buckets, theta, 0), b.placed())
        types = {"words": pack(b.words), "per_word": pack(np.bincount(b.word, minlength=len(b.words))), "ctxs": _steps(b.ctxs), "ctx": pack(b.ctx), "train": pack(b.count)}
        for c, x in types.items():
            out.at[0, c] = x
        return out

    return dealt.groupBy("bucket").applyInPandas(run, _STATE)


def _shares(state: DataFrame) -> tuple[list[float], DataFrame]:
    """Totals of the parent, and per bucket its tables and, block by block in the order of its contexts, the totals of all buckets."""
    def add(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [_from_steps(x) for x in rows["ctxs"]]
        ends = np.cumsum([len(h) for h in hashes])[:-1]
        at = np.unique(np.concatenate(hashes), return_inverse=True)[1]
        total = [np.split(np.bincount(at, weights=np.concatenate([unpack(x) for x in rows[c]])).astype(np.int64)[at], ends) for c in ("tables", "customers")]
        return rows[["bucket", "block"]].assign(tables=[pack(x) for x in total[0]], customers=[pack(x) for x in total[1]])

    own, cells = state.where("block = -1"), state.where("block >= 0").select("bucket", "block", "ctxs", "tables", "customers")
    scalars = [x or 0.0 for x in own.agg(*[F.sum(F.col("scalars")[i]) for i in range(7)]).first()]
    summed = cells.groupBy("block").applyInPandas(add, "bucket int, block int, tables binary, customers binary")
    return scalars, own.select("bucket", "block", "tables", "customers").union(summed)


def _sampler(bucket: int, rows: pd.DataFrame, shares: pd.DataFrame, scalars: list[float], buckets: int, theta: float, seed: int) -> tuple[_Bucket, _Sampler]:
    b, shares = _Bucket(rows), shares.sort_values("block")  # the tables come first
    tables, customers = ([unpack(x).astype(np.int64) for x in shares[c]] for c in ("tables", "customers"))
    total = Totals(*(np.concatenate([np.zeros(0), *x[1:]]) for x in (tables, customers)), scalars[0], scalars[1], int(scalars[2]), _rate(*scalars[3:5]), _rate(*scalars[5:7]))
    return b, _Sampler(b, total, buckets, theta, seed * 1_000_003 + bucket, tables[0], customers[0])


def _round(types: DataFrame, state: DataFrame, buckets: int, theta: float, sweeps: int, seed: int, blocks: int | None = None) -> DataFrame:
    """The state after ``sweeps`` sweeps over the merged types."""
    scalars, shares = _shares(state)

    def run(key: tuple, rows: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        b, s = _sampler(key[0], rows, old, scalars, buckets, theta, seed)
        s.sweep(sweeps)
        s.root()
        return _state(key[0], blocks or buckets, b, s)

    return types.groupBy("bucket").cogroup(shares.groupBy("bucket")).applyInPandas(run, _STATE)


def score(docs: DataFrame, theta: float = 1.0, rounds: int = 1, sweeps: int = 2, samples: int = 3, seed: int = 1, text: str = "text",
          chunk_tokens: int = CHUNK_TOKENS, bucket_types: int = BUCKET_TYPES, fan: int = FAN) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``rounds`` sampling rounds before the scoring one; in each, ``sweeps`` sweeps that draw every type's tables anew;
    then ``samples`` further sweeps whose predictive probabilities are averaged. Contexts are dealt once; tables that only led to the next ones are deleted.
    """
    spark = docs.sparkSession
    # one pass writes two tables: what is dealt, and what a chunk keeps to add up its documents
    place = unique_path(spark, "lm-chunks")
    kinds = F.explode(F.array(F.struct(F.lit("types").alias("kind"), *["words", "ctx", "train"], *[F.lit(None).cast(t).alias(c) for c, t in (("count", "binary"), ("docs", "binary"), ("rids", "binary"), ("doc_ids", "array<bigint>"))]),
                              F.struct(F.lit("lists").alias("kind"), *[F.lit(None).cast("binary").alias(c) for c in ("words", "ctx", "train")], "count", "docs", "rids", "doc_ids"))).alias("k")
    chunks(docs, text, chunk_tokens).select("chunk", "per_word", "n_types", "n_train", kinds).select("chunk", "per_word", "n_types", "n_train", "k.*").write.partitionBy("kind").parquet(place)
    # an empty corpus has no file of either kind
    whole = spark.read.schema("chunk bigint, per_word binary, n_types bigint, n_train bigint, words binary, ctx binary, train binary, count binary, docs binary, rids binary, "
                              "doc_ids array<bigint>, kind string").parquet(place)
    lists = whole.where("kind = 'lists'")
    n_types, n_train = lists.agg(F.sum("n_types"), F.sum("n_train")).first()
    n_train = n_train or 0
    buckets = max(1, math.ceil((n_types or 0) / bucket_types))
    slices = min(buckets, fan)
    per = -(-buckets // slices)
    buckets = slices * per
    blocks = min(buckets, max(fan, buckets // 50))  # 50 buckets know some 20 million contexts: what one task adds up
    merged, merged_place = None, ""
    if per == 1:
        dealt = by_bucket(whole.where("kind = 'types'"), buckets)
    else:
        groups = max(1, lists.count() // per)
        merged, merged_place = write(regroup(by_bucket(whole.where("kind = 'types'"), slices), groups, per, buckets), "lm-groups")
        dealt = merged.where("block = 0").select(*[c.split()[0] for c in _CELL.split(", ")])
    first, first_place = write(_begin(dealt, buckets, theta, blocks), "lm-types")
    del dealt
    release(spark, f"{place}/kind=types")
    types = first.where("block = -1").select("bucket", "block", "chunk", "words", "per_word", "ctxs", "ctx", "train")
    placed = first.where("block = -2").select("bucket", "block", "chunk", "words", "per_word", "ctxs", "ctx", "train")
    state, state_place = first, ""
    for r in range(max(1, rounds)):
        state, new_place = write(_round(types, state, buckets, theta, sweeps, seed + r, blocks), "lm-round")
        release(spark, *([state_place] if state_place else []))
        state_place = new_place
    scalars, shares = _shares(state)

    def answer(key: tuple, rows: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        own = rows["block"] == -1
        b, s = _sampler(key[0], rows[own], old, scalars, buckets, theta, seed + rounds)
        s.sweep(sweeps)
        p = np.zeros(len(b.count))
        for _ in range(samples):
            s.sweep()
            s.root()
            p += s.predictive()
        logs, of = np.log10(p / samples).astype(np.float32), rows[~own]
        return pd.DataFrame({"chunk": of["chunk"], "bucket": key[0], "logs": [pack(logs[_from_steps(x).astype(np.int64)]) for x in of["ctx"]],
                             "known": [pack(b.word_count[_from_steps(x).astype(np.int64)]) for x in of["words"]]})

    answers, answers_place = write(types.union(placed).groupBy("bucket").cogroup(shares.groupBy("bucket")).applyInPandas(
        answer, "chunk bigint, bucket int, logs binary, known binary"), "lm-answers")
    vocabulary = int(scalars[2])
    del first, types, placed, state, shares
    release(spark, first_place, state_place)
    if merged is not None:
        answers, chunk_place = write(ungroup(answers, merged, per), "lm-answers")
        release(spark, answers_place, merged_place)
    out = "rid bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double"

    def add(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        chunk, parts = left.iloc[0], right.sort_values("bucket")
        logs = np.concatenate([unpack(x) for x in parts["logs"]]).astype(np.float64)
        known = np.concatenate([unpack(x) for x in parts["known"]]).astype(np.float64)
        count, per_word, doc, rids = (unpack(chunk[c]) for c in ("count", "per_word", "docs", "rids"))
        n = len(rids)
        word = np.repeat(np.repeat(np.arange(len(known)), per_word), count)
        sums = lambda w: np.bincount(doc, weights=w, minlength=n)
        ids = pd.array([None if x is None or x != x else int(x) for x in chunk["doc_ids"]], dtype="Int64")
        return pd.DataFrame({"rid": rids.astype(np.int64), "doc_id": ids, "n_tokens": np.bincount(doc, minlength=n), "n_known": sums((known > 0)[word]).astype(np.int64),
                             "base": sums(np.log10(known + 1)[word]), "score": sums(np.repeat(logs, count))})

    scored = lists.select("chunk", "per_word", "count", "docs", "rids", "doc_ids").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(add, out)
    scored_rows = scored.groupBy("rid").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")])
    return scored_rows.select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(True)).alias("held_out"), "n_tokens", "n_known",
        F.lit(int(n_train)).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * math.log10(n_train + vocabulary + 1)).alias("base_score"), "score")


def perplexity(scored: DataFrame) -> DataFrame:
    """(held_out, perplexity): 10 to the mean negative log10 probability of a token."""
    return scored.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"))


def op5_pitman_yor_scores(spark, sf_dir: str) -> DataFrame:
    return score(read(spark, sf_dir, "documents"))
