"""Cross-tokenizer alignment by products of token-byte incidence matrices.

Two tokenizers cut the same bytes. The incidence matrix of one has a row per token and a column per byte, in
compressed rows (``Csr``) built here by hand. Gustavson's row product ``A . B^T`` lists for each A token the B tokens that it
overlaps, with the bytes they share. The byte offsets where tokens of both end cut the bytes into groups;
the rows (group, token id) of each side, multiplied the same way over the groups, give the links: all pairs of an A and a B token of one group.

A text is cut at single spaces between characters that are no white space. Both tokenizers always cut there (the byte-level
pre-tokenizer starts a word at such a space; no piece of the other holds its space sign after another character), so every such place ends a group and a
text's alignment is that of its pieces, one after the other. A worker aligns each distinct piece once; odd white space stays inside a piece.

On Spark: a task cuts its documents into blocks of about ``BLOCK_PIECES`` pieces and writes one row for each: documents as lists of pieces, pieces as lists of
links, and for every distinct pair of ids the number of the block's documents that hold it. Only these pre-aggregated counts
are shuffled: summed by pair, compared with the highest of their A id (a table of at most a vocabulary), and sent back to the blocks
that hold the pair, which add them up by document. A pair that a third of all documents hold is one row per block.

Cases: null and empty texts and texts that either tokenizer doesn't give back byte by byte (a literal U+2581) have no tokens:
zeros and an empty digest; null ids are kept as they are; repeated rows are documents of their own, each counted; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator, Sequence
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read
from clinicgen.llm.hpylm import _from_steps, _steps, pack, unpack
from clinicgen.llm.token_files import Encoder

BLOCK_PIECES = 2_000_000
_KNOWN_BYTES = 140_000_000  # remembered alignments per worker, cleared between blocks
_SLICE = 2_000_000  # entries that a product expands at a time
_ODD = re.compile(r"\s | \s| $")
_CUT = re.compile(r"(?<=\S) (?=\S)")


class Csr(NamedTuple):
    """Compressed sparse rows."""
    start: np.ndarray  # rows + 1
    col: np.ndarray
    val: np.ndarray
    width: int

    @classmethod
    def from_pairs(cls, row: np.ndarray, col: np.ndarray, rows: int, width: int) -> Csr:
        """Counts of equal (row, col)."""
        key, val = np.unique(row.astype(np.int64) * max(width, 1) + col, return_counts=True)
        return cls(np.r_[0, np.cumsum(np.bincount(key // max(width, 1), minlength=rows))], key % max(width, 1), val, width)

    @classmethod
    def of_spans(cls, sizes: np.ndarray) -> Csr:
        """Incidence of consecutive tokens of these byte counts: row i has a one in each of its bytes."""
        start = np.r_[0, np.cumsum(sizes)]
        return cls(start, np.arange(start[-1]), np.ones(start[-1], np.int64), int(start[-1]))

    def transpose(self) -> Csr:
        row = np.repeat(np.arange(len(self.start) - 1), np.diff(self.start))
        order = np.argsort(self.col, kind="stable")
        return Csr(np.r_[0, np.cumsum(np.bincount(self.col, minlength=self.width))], row[order], self.val[order], len(self.start) - 1)


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each run one after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - ends + size, size)


def gustavson(a: Csr, b: Csr) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, col, value) of ``a . b`` in slices of a's rows: row i is the sum of b's rows k times a[i, k], collected per row."""
    fan = np.diff(b.start)[a.col]  # entries that each entry of a brings
    upto = np.r_[0, np.cumsum(fan)]
    at = upto[a.start]
    i, rows = 0, len(a.start) - 1
    while i < rows:
        j = max(i + 1, int(np.searchsorted(at, at[i] + _SLICE, side="right")) - 1)
        s, e = a.start[i], a.start[j]
        n = fan[s:e]
        total = int(upto[e] - upto[s])
        if total:
            row = np.repeat(np.repeat(np.arange(i, j), np.diff(a.start[i:j + 1])), n)
            src = np.arange(total) + np.repeat(b.start[a.col[s:e]] - (upto[s:e] - upto[s]), n)
            key = row * b.width + b.col[src]
            val = np.repeat(a.val[s:e], n) * b.val[src]
            if (key[1:] <= key[:-1]).any():  # a row met a column twice, or out of order
                order = np.argsort(key, kind="stable")
                key, val = key[order], val[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            yield key[first] // b.width, key[first] % b.width, np.add.reduceat(val, first)
        i = j


class Aligned(NamedTuple):
    """Alignments of many pieces; ``a_group`` and ``b_group`` count over all of them."""
    n_groups: np.ndarray
    n_links: np.ndarray
    n_overlaps: np.ndarray
    a_group: np.ndarray
    b_group: np.ndarray
    link_piece: np.ndarray  # distinct (piece, a id, b id), by piece
    link_a: np.ndarray
    link_b: np.ndarray
    link_times: np.ndarray


def align(a_ids: np.ndarray, a_size: np.ndarray, a_piece: np.ndarray, b_ids: np.ndarray, b_size: np.ndarray, b_piece: np.ndarray, pieces: int) -> Aligned:
    """Aligns tokens (id, bytes, piece) of two tokenizers; each piece has the same bytes on both sides, and at least one."""
    overlaps = np.zeros(pieces, np.int64)
    for row, _, _ in gustavson(Csr.of_spans(a_size), Csr.of_spans(b_size).transpose()):
        overlaps += np.bincount(a_piece[row], minlength=pieces)
    a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
    cuts = np.intersect1d(a_end, b_end, assume_unique=True)
    a_group, b_group = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    group_piece = np.empty(len(cuts), np.int64)
    group_piece[a_group] = a_piece
    links = np.bincount(a_group, minlength=len(cuts)) * np.bincount(b_group, minlength=len(cuts))
    # a row per (group, A id) with one column, its group; times the rows of groups by B id
    width_a = int(a_ids.max()) + 1 if len(a_ids) else 1
    key, times = np.unique(a_group * width_a + a_ids, return_counts=True)
    left = Csr(np.arange(len(key) + 1), key // width_a, times, len(cuts))
    right = Csr.from_pairs(b_group, b_ids, len(cuts), int(b_ids.max()) + 1 if len(b_ids) else 1)
    found = [(group_piece[left.col[row]], key[row] % width_a, col, val) for row, col, val in gustavson(left, right)]
    piece, a, b, val = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4))
    order = np.lexsort((b, a, piece))  # several groups of a piece may link the same ids
    piece, a, b, val = piece[order], a[order], b[order], val[order]
    first = np.flatnonzero(np.r_[True, (piece[1:] != piece[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])][:len(piece)])
    return Aligned(np.bincount(group_piece, minlength=pieces), np.bincount(group_piece, weights=links, minlength=pieces).astype(np.int64), overlaps, a_group, b_group,
                   piece[first], a[first], b[first], np.add.reduceat(val, first) if len(first) else val)


def pieces_of(text: str) -> list[str]:
    """Pieces of space + text, each without its leading space."""
    return _CUT.split(text) if _ODD.search(" " + text) else text.split(" ")


class Tokenizers:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, byte_level: str, pieces: str) -> None:
        import sentencepiece

        self.enc = Encoder(byte_level)
        self.enc.tok.encode_special_tokens = True  # their strings in a text are plain text
        # the byte-level spelling: a printable byte is the character of its number, the others follow from 256 on
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in set(plain))}
        vocab = self.enc.tok.get_vocab()
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.sp = sentencepiece.SentencePieceProcessor(model_file=pieces)
        n = self.sp.get_piece_size()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(self.sp.id_to_piece, range(n)))]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # a last mark after a letter: the byte-level pre-tokenizer parts them, and so does the other if no piece holds both
        crossing = {y for p in map(self.sp.id_to_piece, range(n)) for x, y in zip(p, p[1:], strict=False) if x.isalpha()}
        self.marks = "".join(m for m in ",.;:!?" if m not in crossing and self.sp.piece_to_id(m) != self.sp.unk_id())
        self.names = [np.array([b"%c%d" % (sep, i) for i in range(max(len(self.a_bytes), n))]) for sep in b",;|"]

    def a(self, pieces: list[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lead + piece, one after the other, and how many each has."""
        known: dict[str, bytes] = {}
        if lead:
            joint = [p for p in pieces if p and " " not in p and not p[0].isspace() and not p[-1].isspace()]
            known.update(zip(joint, self.enc._joined(joint), strict=True))
        rest = [p for p in pieces if p not in known]
        known.update(zip(rest, self.enc._plain([lead + p for p in rest]), strict=True))
        ids = [known[p] for p in pieces]
        return np.frombuffer(b"".join(ids), f"<u{self.enc.width}").astype(np.int64), np.array([len(x) for x in ids], np.int64) // self.enc.width

    def b(self, pieces: list[str], lead: str) -> tuple[np.ndarray, np.ndarray]:
        # the library puts a space in front; without one there are only marks, which are pieces
        ids = self.sp.encode(pieces, num_threads=1) if lead else [[self.sp.piece_to_id(p)] for p in pieces]
        return np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids], np.int64)


class Known:
    """Alignments of the pieces a worker has met, by number."""

    def __init__(self, tok: Tokenizers) -> None:
        self.tok = tok
        self.clear()

    def clear(self) -> None:
        self.index: dict[str | tuple[str], int] = {}
        self.n_a, self.n_b, self.n_groups, self.n_links, self.n_overlaps = self.counts = [array("q") for _ in range(5)]  # n_a -1: not given back byte by byte
        self.name: list[bytes] = []
        self.link_start, self.link_code, self.link_times = array("q", [0]), array("Q"), array("q")
        self.held = 0

    def learn(self, pieces: list[str]) -> None:
        """Aligns new pieces; one that ends in a mark after a letter is put together from its stem and the mark."""
        marks = self.tok.marks
        ended = [p for p in pieces if len(p) > 1 and p[-1] in marks and p[-2].isalpha()]
        # a mark without a space in front is kept under a tuple, which no piece is
        bare = [m for m in sorted({p[-1] for p in ended}) if (m,) not in self.index]
        self._align(bare, "", [(m,) for m in bare])
        stems = dict.fromkeys(p for p in pieces if not (len(p) > 1 and p[-1] in marks and p[-2].isalpha()))
        stems.update(dict.fromkeys(p[:-1] for p in ended if p[:-1] not in self.index))
        stem_list = list(stems)
        for s in range(0, len(stem_list), 20_000):
            part = stem_list[s:s + 20_000]
            self._align(part, " ", part)
        self._compose(ended)

    def _compose(self, ended: list[str]) -> None:
        at = np.array([self.index[p[:-1]] for p in ended], np.int64)
        mark = np.array([self.index[p[-1],] for p in ended], np.int64)
        counts = [np.frombuffer(c, np.int64) for c in self.counts]
        new = [c[at] + c[mark] for c in counts]
        bad = counts[0][at] < 0
        new[0][bad] = -1
        start, code, times = np.frombuffer(self.link_start, np.int64), np.frombuffer(self.link_code, np.uint64), np.frombuffer(self.link_times, np.int64)
        n_at, n_mark = start[at + 1] - start[at], start[mark + 1] - start[mark]
        ends = np.cumsum(n_at + n_mark)
        which = np.empty(2 * len(at), np.int64)
        which[::2], which[1::2] = at, mark
        n = start[which + 1] - start[which]
        src = _runs(start[which], n)
        code, times, ends = code[src], times[src], self.link_start[-1] + ends
        names = [b"" if x else self.name[i] + b";" + self.name[m] for i, m, x in zip(at.tolist(), mark.tolist(), bad.tolist(), strict=True)]
        del start, counts  # their arrays grow now
        self._add(ended, new, names, ends, code, times)

    def _add(self, pieces: Sequence[str | tuple[str]], counts: list[np.ndarray], names: list[bytes], link_ends: np.ndarray, code: np.ndarray, times: np.ndarray) -> None:
        for own, new in zip(self.counts, counts, strict=True):
            own.frombytes(new.astype(np.int64).tobytes())
        self.name += names
        self.link_start.frombytes(link_ends.astype(np.int64).tobytes())
        self.link_code.frombytes(code.tobytes())
        self.link_times.frombytes(times.astype(np.int64).tobytes())
        base = len(self.index)
        self.index.update(zip(pieces, range(base, base + len(pieces)), strict=True))
        self.held += sum(map(len, names)) + 2 * sum(map(len, pieces)) + 280 * len(pieces) + 16 * len(code)

    def _align(self, part: list[str], lead: str, names: Sequence[str | tuple[str]]) -> None:
        tok = self.tok
        if not part:
            return
        (a_ids, n_a), (b_ids, n_b) = tok.a(part, lead), tok.b(part, lead)
        raw = [(lead + p).encode() for p in part]
        size = np.array([len(r) for r in raw])
        whole = b"".join(raw)
        at = np.arange(len(part))
        a_at, b_at = np.repeat(at, n_a), np.repeat(at, n_b)
        fits = [(np.bincount(x_at, weights=x_size[x], minlength=len(part)).astype(np.int64) == size).all() and b"".join(map(x_bytes.__getitem__, x.tolist())) == whole
                for x, x_at, x_size, x_bytes in ((a_ids, a_at, tok.a_size, tok.a_bytes), (b_ids, b_at, tok.b_size, tok.b_bytes))]
        same = np.ones(len(part), bool)
        if not all(fits):  # some piece is not given back: look at each
            for x, x_at, x_bytes in ((a_ids, a_at, tok.a_bytes), (b_ids, b_at, tok.b_bytes)):
                held = [b""] * len(part)
                for i, p in zip(x.tolist(), x_at.tolist(), strict=True):
                    held[p] += x_bytes[i]
                same &= np.array([h == r for h, r in zip(held, raw, strict=True)])
            a_ids, a_at, b_ids, b_at = a_ids[same[a_at]], a_at[same[a_at]], b_ids[same[b_at]], b_at[same[b_at]]
        out = align(a_ids, tok.a_size[a_ids], a_at, b_ids, tok.b_size[b_ids], b_at, len(part))
        n_a = np.where(same, np.bincount(a_at, minlength=len(part)), -1)
        ends = self.link_start[-1] + np.cumsum(np.bincount(out.link_piece, minlength=len(part)))
        code = out.link_a.astype(np.uint64) << np.uint64(32) | out.link_b.astype(np.uint64)
        self._add(names, [n_a, np.bincount(b_at, minlength=len(part)), out.n_groups, out.n_links, out.n_overlaps], self._names(a_ids, a_at, b_ids, b_at, out), ends, code, out.link_times)

    def _names(self, a_ids: np.ndarray, a_at: np.ndarray, b_ids: np.ndarray, b_at: np.ndarray, out: Aligned) -> list[bytes]:
        """Per piece `a1,a2|b1;a3|b2`, in order: every token's decimal id with the sign in front of it, the first sign cut off."""
        group, side = np.r_[out.a_group, out.b_group], np.repeat([0, 1], [len(a_ids), len(b_ids)])
        order = np.argsort(group * 2 + side, kind="stable")  # by group, A before B, in order
        ids, piece = np.r_[a_ids, b_ids][order], np.r_[a_at, b_at][order]
        key = (group * 2 + side)[order]
        first = np.r_[True, key[1:] != key[:-1]][:len(key)]
        sign = np.where(first, np.where(key & 1, 2, 1), 0)
        spelled = np.empty(len(ids), self.tok.names[0].dtype)
        for k, table in enumerate(self.tok.names):
            spelled[sign == k] = table[ids[sign == k]]
        raw = spelled.view(np.uint8).reshape(len(ids), spelled.itemsize)
        used = raw != 0
        upto = np.r_[0, np.cumsum(np.bincount(piece, weights=used.sum(axis=1), minlength=len(out.n_groups)).astype(np.int64))].tolist()
        flat = raw[used].tobytes()
        return [flat[i + 1:j] for i, j in zip(upto, upto[1:], strict=False)]


_KNOWN: dict[tuple[str, str], Known] = {}  # per worker process


def _known(a: str, b: str) -> Known:
    if (a, b) not in _KNOWN:
        _KNOWN[a, b] = Known(Tokenizers(a, b))
    return _KNOWN[a, b]


_DOC = ("n_a", "n_b", "n_groups", "n_links", "n_overlaps")
_BLOBS = ("pairs", "n_docs", "per_piece", "link", "times", "per_doc", "piece")
_BLOCK = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in _BLOBS], ("doc_ids", pa.list_(pa.int64())), ("no_id", pa.list_(pa.bool_())), *[(c, pa.list_(pa.int64())) for c in _DOC], ("digests", pa.list_(pa.string()))])
_BLOCK_SQL = ", ".join(["block bigint", *[f"{c} binary" for c in _BLOBS], "doc_ids array<bigint>", "no_id array<boolean>", *[f"{c} array<bigint>" for c in _DOC], "digests array<string>"])


class _Block:
    def __init__(self, known: Known) -> None:
        self.known, self.ids, self.digests, self.pieces, self.sums, self.size = known, [], [], [], [], 0

    def add(self, ids: list[int | None], texts: list[str | None]) -> None:
        k = self.known
        cut_up = [pieces_of(t) if t else [] for t in texts]
        index = k.index
        unknown = [p for p in set().union(*cut_up) if p not in index]
        if unknown:
            k.learn(unknown)
        lists = [list(map(index.__getitem__, words)) for words in cut_up]
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum()))
        doc = np.repeat(np.arange(len(lists)), sizes)
        counts = [np.frombuffer(x, np.int64) for x in k.counts]
        lost = np.bincount(doc, weights=counts[0][flat] < 0, minlength=len(lists)) > 0
        sums = np.stack([np.bincount(doc, weights=c[flat], minlength=len(lists)).astype(np.int64) for c in counts])
        sums[:, lost] = 0
        ends = np.r_[0, np.cumsum(sizes)]
        for i, (at, gone) in enumerate(zip(lists, lost.tolist(), strict=True)):
            self.pieces.append(flat[ends[i]:ends[i] if gone else ends[i + 1]].astype(np.int32))
            self.digests.append(hashlib.sha256(b";".join(map(k.name.__getitem__, at))).hexdigest() if at and not gone else "")
            self.size += len(self.pieces[-1])
        self.ids += ids
        self.sums += sums.T.tolist()

    def row(self, block: int) -> dict:
        k = self.known
        flat, per_doc = np.concatenate(self.pieces), np.array([len(x) for x in self.pieces], np.int64)
        met = np.zeros(len(k.index), bool)
        met[flat] = True
        pieces = np.flatnonzero(met)
        local = np.cumsum(met) - 1
        piece = local[flat]
        start, codes, times = np.frombuffer(k.link_start, np.int64), np.frombuffer(k.link_code, np.uint64), np.frombuffer(k.link_times, np.int64)
        per_piece = start[pieces + 1] - start[pieces]
        begin = np.r_[0, np.cumsum(per_piece)]
        src = _runs(start[pieces], per_piece)
        pairs, link = np.unique(codes[src], return_inverse=True)
        # documents that hold a pair: a document's pieces, then its links, each leave their place in ``seen``; the last of equal ones finds its own there
        n, seen_piece, seen = np.zeros(len(pairs), np.int64), np.zeros(len(pieces), np.int64), np.zeros(len(pairs), np.int64)
        upto = np.r_[0, np.cumsum(per_doc)].tolist()
        for i, j in zip(upto, upto[1:], strict=False):
            own, at = piece[i:j], np.arange(j - i)
            seen_piece[own] = at
            own = own[seen_piece[own] == at]
            held = link[_runs(begin[own], per_piece[own])]
            at = np.arange(len(held))
            seen[held] = at
            n[held[seen[held] == at]] += 1
        sums = np.array(self.sums, np.int64).reshape(-1, len(_DOC))
        return {"block": block, "pairs": _steps(pairs), "n_docs": pack(n), "per_piece": pack(per_piece), "link": pack(link), "times": pack(times[src]),
                "per_doc": pack(per_doc), "piece": pack(piece), "doc_ids": [i or 0 for i in self.ids], "no_id": [i is None for i in self.ids], "digests": self.digests, **{c: sums[:, x].tolist() for x, c in enumerate(_DOC)}}


def blocks(docs: DataFrame, byte_level: str, pieces: str, block_pieces: int = BLOCK_PIECES, text: str = "text") -> DataFrame:
    """Aligned blocks of documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base, n, known = TaskContext.get().partitionId() << 33, 0, _known(byte_level, pieces)
        block = _Block(known)
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for s in range(0, len(ids), 64):
                block.add(ids[s:s + 64], texts[s:s + 64])
                if block.size >= block_pieces:
                    yield pa.RecordBatch.from_pylist([block.row(base + n)], schema=_BLOCK)
                    if known.held > _KNOWN_BYTES:
                        known.clear()
                    block, n = _Block(known), n + 1
        if block.ids:
            yield pa.RecordBatch.from_pylist([block.row(base + n)], schema=_BLOCK)

    return docs.select(F.col("doc_id").cast("bigint"), text).mapInArrow(run, _BLOCK_SQL)


def pair_counts(written: DataFrame) -> DataFrame:
    """(block, place, pair, n): the pairs of every block, by their place in it, with the number of documents of all blocks that hold them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, pairs, n_docs in zip(*[c.to_pylist() for c in b.columns], strict=True):
                p, n = _from_steps(pairs).astype(np.int64), unpack(n_docs).astype(np.int64)
                for s in range(0, len(p), 100_000):
                    e = min(len(p), s + 100_000)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(e - s, block)), pa.array(np.arange(s, e, dtype=np.int32)), pa.array(p[s:e]), pa.array(n[s:e])], ["block", "place", "pair", "n"])

    rows = written.select("block", "pairs", "n_docs").mapInArrow(run, "block bigint, place int, pair bigint, n bigint")
    # a pair has a row per block that holds it, so also a pair of all documents is a small group
    return cut(rows.withColumn("n", F.sum("n").over(Window.partitionBy("pair"))), "align-pairs")


def alignments(docs: DataFrame, byte_level: str, pieces: str, block_pieces: int = BLOCK_PIECES, text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups_sha256) of every row."""
    written = cut(blocks(docs, byte_level, pieces, block_pieces, text), "align-blocks")
    counted = pair_counts(written)
    a = F.shiftright("pair", 32)
    highest = counted.groupBy(a.alias("a")).agg(F.max("n").alias("top"))  # at most a row per A id
    judged = counted.withColumn("a", a).join(highest, "a").select("block", "place", "n", (F.col("n") == F.col("top")).alias("best"))

    def add(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        b = left.iloc[0]
        per_piece, link, times, per_doc, piece = (unpack(b[c]).astype(np.int64) for c in ("per_piece", "link", "times", "per_doc", "piece"))
        n, best = np.zeros(len(right), np.int64), np.zeros(len(right), np.int64)
        n[right["place"]], best[right["place"]] = right["n"], right["best"]
        of = np.repeat(np.arange(len(per_piece)), per_piece)
        doc = np.repeat(np.arange(len(per_doc)), per_doc)

        def sums(w: np.ndarray) -> np.ndarray:  # of whole numbers below 2 ** 53
            by_piece = np.bincount(of, weights=times * w[link], minlength=len(per_piece))
            return np.bincount(doc, weights=by_piece[piece], minlength=len(per_doc)).astype(np.int64)

        ids = pd.arrays.IntegerArray(np.array(b["doc_ids"], np.int64), np.array(b["no_id"], bool))
        return pd.DataFrame({"doc_id": ids, **{c: b[c] for c in _DOC}, "n_best": sums(best), "count_sum": sums(n), "groups_sha256": b["digests"]})

    lists = written.select("block", "per_piece", "link", "times", "per_doc", "piece", "doc_ids", "no_id", *_DOC, "digests")
    out = ", ".join(["doc_id bigint", *[f"{c} bigint" for c in _DOC], "n_best bigint", "count_sum bigint", "groups_sha256 string"])
    return lists.groupBy("block").cogroup(judged.groupBy("block")).applyInPandas(add, out)


def op11_token_alignment(spark, sf_dir: str, byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    import public_tokenizers

    return alignments(read(spark, sf_dir, "documents"), byte_level or public_tokenizers.path("byte_bpe_50k.json"), pieces or public_tokenizers.path("piece_bpe_32k.model"))
