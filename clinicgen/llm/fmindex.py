"""A compressed FM-index over words: Huffman-shaped wavelet tree of the Burrows-Wheeler transform.

Suffixes are sorted by their first ``depth`` symbols, which is all that patterns of up to ``depth`` symbols need. The tree's
bit vectors hold as many bits as the Huffman codes of all symbols (zero-order entropy), each with a directory of counts;
a rank walks a symbol's code from the root, many queries at once. ``boundaries`` marks where neighbouring suffixes
differ within ``depth - 1`` symbols, so that a match can drop its last symbol.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """Bit vector with constant-time counts of ones."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words), np.int32)
        np.cumsum(np.bitwise_count(self.words[:-1]), dtype=np.int32, out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        w = at >> 6
        low = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & low)


def code_lengths(counts: np.ndarray) -> np.ndarray:
    """Huffman code lengths of symbols with these counts (at least one each), by merging two ascending queues."""
    n = len(counts)
    if n == 1:
        return np.ones(1, np.int64)
    order = np.argsort(counts, kind="stable")
    leaf, inner = counts[order].tolist(), []
    parent = [0] * (2 * n - 1)
    i = j = 0
    for made in range(n - 1):
        total = 0
        for _ in range(2):
            if j >= len(inner) or (i < n and leaf[i] <= inner[j]):
                total, parent[i], i = total + leaf[i], n + made, i + 1
            else:
                total, parent[n + j], j = total + inner[j], n + made, j + 1
        inner.append(total)
    depth = [0] * (2 * n - 1)
    for v in range(2 * n - 3, -1, -1):
        depth[v] = depth[parent[v]] + 1
    out = np.empty(n, np.int64)
    out[order] = depth[:n]
    return out


class WaveletTree:
    """Ranks of symbols 0 .. sigma - 1 in a sequence; each symbol occurs."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        self.length = code_lengths(np.bincount(seq, minlength=sigma))
        order = np.lexsort((np.arange(sigma), self.length))
        self.code = np.zeros(sigma, np.int64)  # canonical: ascending codes by (length, symbol)
        steps = self.length[order]
        value, last = 0, int(steps[0])
        codes = []
        for n in steps.tolist():
            value <<= n - last
            codes.append(value)
            value, last = value + 1, n
        self.code[order] = codes
        self.levels: list[Bits] = []
        self.node: list[np.ndarray] = []   # per level and symbol: where its node starts ...
        self.ones: list[np.ndarray] = []   # ... and the ones before it
        for level in range(int(self.length.max())):
            alive = np.flatnonzero(self.length > level)
            prefix = np.zeros(sigma, np.int64)
            prefix[alive] = self.code[alive] >> (self.length[alive] - level)
            own = prefix[seq]  # a node's elements stay together: all of them share the prefix
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            by = np.argsort(own[first], kind="stable")
            start = np.zeros(sigma, np.int32)
            start[alive] = first[by][np.searchsorted(own[first], prefix[alive], sorter=by)]
            bit = np.zeros(sigma, bool)
            bit[alive] = self.code[alive] >> (self.length[alive] - level - 1) & 1
            bits = bit[seq]
            self.levels.append(Bits(bits))
            self.node.append(start)
            self.ones.append(self.levels[-1].rank(start.astype(np.int64)).astype(np.int32))
            seq = np.concatenate([seq[~bits], seq[bits]])
            seq = seq[self.length[seq] > level + 1]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before its position."""
        at = at.copy()
        todo = np.arange(len(at))
        for level, bits in enumerate(self.levels):
            c = symbol[todo]
            ones = bits.rank(self.node[level][c] + at[todo]) - self.ones[level][c]
            at[todo] = np.where(self.code[c] >> (self.length[c] - level - 1) & 1, ones, at[todo] - ones)
            todo = todo[self.length[c] > level + 1]
            if not len(todo):
                break
        return at


def suffix_order(seq: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their first ``depth`` symbols (ties by position), and whether each differs from the one before within ``depth - 1``.

    Ranks of 2, 4, 8, ... symbols by pairs of ranks; shorter suffixes come first.
    """
    n = len(seq)

    def dense(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)

    def later(r: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[:max(n - by, 0)] = r[by:] + 1
        return out

    rank, width = seq.astype(np.int64), 1
    while 2 * width < depth:
        rank, width = dense(rank, later(rank, width)), 2 * width
    shorter = rank if depth - 1 <= width else dense(rank, later(rank, depth - 1 - width))
    whole = rank if depth <= width else dense(rank, later(rank, depth - width))
    order = np.argsort(whole, kind="stable")
    by = shorter[order]
    return order, np.r_[True, by[1:] != by[:-1]]


class FmIndex:
    """Index of a sequence of symbols 0 .. sigma - 1 (each occurs) for patterns of up to ``depth`` symbols."""

    def __init__(self, seq: np.ndarray, sigma: int, depth: int) -> None:
        order, differs = suffix_order(seq, depth)
        self.n, self.depth = len(seq), depth
        self.smaller = np.r_[0, np.cumsum(np.bincount(seq, minlength=sigma))]
        self.tree = WaveletTree(seq[order - 1], sigma)  # the symbol before each suffix; the last one before the first
        self.first = np.flatnonzero(np.r_[differs, True])
        self.boundaries = Bits(differs)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the suffixes [lo, hi) with ``symbol`` put in front."""
        at = self.smaller[symbol] + self.tree.rank(np.r_[symbol, symbol], np.r_[lo, hi]).reshape(2, -1)
        return at[0], at[1]

    def shorten(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that share their first ``depth - 1`` symbols with suffix ``lo``."""
        group = self.boundaries.rank(lo + 1) - 1
        return self.first[group], self.first[group + 1]

    def statistics(self, queries: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of sequences ``queries[start:end]`` that occur in the index, cut off at ``depth`` symbols.

        Each is read from its end, all at once: a match of ``depth`` symbols drops its last one before the next is put in front. For every place
        where ``depth`` symbols begin: the first and one past the last suffix that begin with them; (0, 0) elsewhere.
        """
        lo_at, hi_at = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
        order = np.argsort(start - end, kind="stable")  # longest first, so that those still read are a prefix
        size = (end - start)[order]
        lo, hi = np.zeros(len(order), np.int64), np.full(len(order), self.n, np.int64)
        for step in range(int(size[0]) if len(size) else 0):
            k = int(np.searchsorted(-size, -step, side="left"))  # those of more than ``step`` symbols
            at = end[order[:k]] - 1 - step
            a, b = (lo[:k], hi[:k]) if step < self.depth else self.shorten(lo[:k])
            lo[:k], hi[:k] = self.extend(queries[at], a, b)
            if step >= self.depth - 1:
                lo_at[at], hi_at[at] = lo[:k], hi[:k]
        return lo_at, hi_at
