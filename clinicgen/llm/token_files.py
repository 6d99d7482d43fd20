"""Token ids in Arrow IPC files of fixed-size-list batches.

The ids of all documents, in ascending id order and each with an end id, form one stream. A
file holds a range of documents: record batches of ``batch_rows`` sequences, each a
fixed-size list of ``seq_len`` ids beside a fixed-size list of mask bits (false where the last sequence of a
file is padded). Equal lengths make sequence ``i`` row ``i % batch_rows`` of batch
``i // batch_rows``, read from a memory map without a copy. A second Arrow file lists each
document's start in the file and its count of ids.

Encoding: a text is cut at single spaces between non-space characters, which the byte-level
pre-tokenizer always cuts at too, so the pieces' ids joined are the text's ids; pieces are encoded
by the tokenizers library once and remembered. Texts with other runs of white space next to a
space, or with the spelling of a special token, are handed to the library whole.

Cases: null and empty texts have the end id alone; null ids come first; equal ids are ordered by the hash of
their text, repeated rows are documents of their own; an empty table writes no file; extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from array import array
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read, scratch_path, spread_files
from clinicgen.llm.files import create, open_random

_PIECES = 1_000_000  # remembered pieces per worker
_JOINED = 256  # unknown pieces encoded as one text


class Encoder:
    """Ids of texts as little-endian bytes, ``width`` bytes an id."""

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.code = "H" if self.tok.get_vocab_size() <= 1 << 16 else "I"
        self.width = array(self.code).itemsize
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # a byte-level token's spelling has a character per byte
        vocab = self.tok.get_vocab()
        self.bytes_of = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)
        self.opening: dict[str, bytes | None] = {}  # pieces without a space before them
        self.spaced: dict[str, bytes | None] = {}   # words after a space, without it

    def _plain(self, pieces: list[str]) -> list[bytes]:
        return [array(self.code, e.ids).tobytes() for e in self.tok.encode_batch_fast(pieces, add_special_tokens=False)]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of `` word`` for each word, encoded together and parted by byte counts (words hold no space)."""
        out: list[bytes] = []
        groups = [words[i:i + _JOINED] for i in range(0, len(words), _JOINED)]
        texts = [" " + " ".join(g) for g in groups]
        for group, text, e in zip(groups, texts, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, f"<u{self.width}")
            upto = np.cumsum(self.bytes_of[ids])
            raw = text.encode()
            ends = np.r_[np.flatnonzero(np.frombuffer(raw, np.uint8) == 32)[1:], len(raw)]
            cuts = np.searchsorted(upto, ends)
            if upto[-1] == len(raw) and (upto[cuts] == ends).all():
                flat, at = ids.tobytes(), [0, *((cuts + 1) * self.width).tolist()]
                out += [flat[i:j] for i, j in zip(at, at[1:], strict=False)]
            else:  # a token reaches over a word's end: never seen, but then each alone
                out += self._plain([" " + w for w in group])
        return out

    def _learn(self, words: list[str], known: dict[str, bytes | None], lead: str) -> None:
        """Encodes unknown pieces; a last punctuation mark after a letter is a pre-token of its own, so stems are shared.

        Pieces that begin or end with white space, or are empty, may join their neighbours: they become None, which sends their texts to the library whole.
        """
        ended, joint, rest = [], [], []
        for w in words:
            if not w or w[0].isspace() or w[-1].isspace():
                known[w] = None
            elif w[-1] in ",.;:!?" and len(w) > 1 and w[-2].isalpha():
                ended.append(w)
            elif lead:
                joint.append(w)
            else:
                rest.append(w)
        stems = {w[:-1] for w in ended}.difference(joint, rest)
        (joint if lead else rest).extend(w for w in stems if w not in known)
        rest_ids = self._plain([lead + w for w in rest])
        known.update(zip(rest, rest_ids, strict=True))
        known.update(zip(joint, self._joined(joint), strict=True))
        marks = [m for m in sorted({w[-1] for w in ended}) if m not in self.opening]
        self.opening.update(zip(marks, self._plain(marks), strict=True))
        for w in ended:
            known[w] = known[w[:-1]] + self.opening[w[-1]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.opening) + len(self.spaced) > _PIECES:
            self.opening.clear()
            self.spaced.clear()
        cut_up = [(t or "").split(" ") for t in texts]
        first = [w.pop(0) for w in cut_up]  # the others follow a space
        openings = [w for w in set(first) if w and w not in self.opening]  # (a difference of sets would walk all that is known)
        if openings:
            self._learn(openings, self.opening, "")
        words = [w for w in set().union(*cut_up) if w not in self.spaced]
        if words:
            self._learn(words, self.spaced, " ")
        out, get = [], self.spaced.__getitem__
        for t, w, words in zip(texts, first, cut_up, strict=True):
            if t and not any(s in t for s in self.special):
                try:
                    out.append((self.opening[w] if w else b"") + b"".join(map(get, words)))
                    continue
                except TypeError:  # a piece is None
                    pass
            out.append(array(self.code, self.tok.encode(t, add_special_tokens=False).ids).tobytes() if t else b"")
        return out


_ENCODERS: dict[str, Encoder] = {}  # per worker process, so pieces are learned once for many tasks


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class _Writer:
    """Packs bytes of ids into batches of fixed-size lists."""

    def __init__(self, out: Any, dtype: np.dtype, seq_len: int, batch_rows: int) -> None:
        self.dtype, self.seq_len, self.room = dtype, seq_len, seq_len * batch_rows
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("ids", pa.list_(pa.field("item", kind, False), seq_len)), ("mask", pa.list_(pa.field("item", pa.bool_(), False), seq_len))])
        self.out, self.held, self.size = pa.ipc.new_file(out, self.schema), [], 0

    def add(self, ids: bytes) -> None:
        self.held.append(ids)
        self.size += len(ids) // self.dtype.itemsize
        if self.size >= self.room:
            flat = np.frombuffer(b"".join(self.held), self.dtype)
            whole = len(flat) // self.room * self.room
            for i in range(0, whole, self.room):
                self._put(flat[i:i + self.room], self.room)
            self.held, self.size = [flat[whole:].tobytes()], len(flat) - whole

    def _put(self, flat: np.ndarray, used: int) -> None:
        mask = np.zeros(len(flat), bool)
        mask[:used] = True
        arrays = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), self.schema, strict=True)]
        self.out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=self.schema))

    def close(self) -> None:
        if self.size:
            flat = np.zeros(-(-self.size // self.seq_len) * self.seq_len, self.dtype)
            flat[:self.size] = np.frombuffer(b"".join(self.held), self.dtype)
            self._put(flat, self.size)
        self.out.close()


_DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_token_files(docs: DataFrame, path: str, tokenizer: str, seq_len: int = 1024, batch_rows: int = 64, end_id: int = 0) -> DataFrame:
    """Writes the files under ``path``; returns the manifest (part, ids_file, docs_file, n_ids, n_docs), parts in id order."""
    text_hash = F.xxhash64("text")
    src = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", text_hash.alias("h"))
    ordered = src.repartitionByRange(F.col("doc_id").asc_nulls_first(), "h").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = _encoder(tokenizer)
        end = array(enc.code, [end_id]).tobytes()
        part, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        files = [f"{path}/ids-{part:06d}-{name}.arrow", f"{path}/docs-{part:06d}-{name}.arrow"]
        writer, at, n_docs = None, 0, 0
        for b in batches:
            if not b.num_rows:
                continue
            if writer is None:
                ids_out, docs_out = create(files[0]), create(files[1])
                writer, index = _Writer(ids_out, np.dtype(f"<u{enc.width}"), seq_len, batch_rows), pa.ipc.new_file(docs_out, _DOCS)
            starts, counts = [], []
            for ids in enc.encode(b.column(1).to_pylist()):
                writer.add(ids)
                writer.add(end)
                starts.append(at)
                counts.append(len(ids) // enc.width + 1)
                at += counts[-1]
            index.write_batch(pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())], schema=_DOCS))
            n_docs += b.num_rows
        if writer is not None:
            writer.close()
            index.close()
            ids_out.close()
            docs_out.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "ids_file": [files[0]], "docs_file": [files[1]], "n_ids": [at], "n_docs": [n_docs]})

    return cut(ordered.mapInArrow(run, "part bigint, ids_file string, docs_file string, n_ids bigint, n_docs bigint"), "token-manifest")


def sequence(path: str, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, mask) of sequence ``i`` of a file; the ids are a view of the mapped file."""
    reader = pa.ipc.open_file(open_random(path))
    rows = reader.get_batch(0).num_rows
    batch = reader.get_batch(i // rows)
    ids, mask = batch.column("ids"), batch.column("mask")
    n, r = ids.type.list_size, i % rows
    return ids.values.to_numpy(zero_copy_only=True)[r * n:(r + 1) * n], mask.values.slice(r * n, n).to_numpy(zero_copy_only=False)


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; ``start`` counts from the first file's first id."""
    # one small row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("ids_file", "docs_file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    spread = spread_files(files, "ids_file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids_file, docs_file, base in zip(*[c.to_pylist() for c in b.columns], strict=True):
                ids, index = pa.ipc.open_file(open_random(ids_file)), pa.ipc.open_file(open_random(docs_file))
                k, flat, at = -1, np.zeros(0, np.uint16), 0
                for d in range(index.num_record_batches):
                    docs = index.get_batch(d)
                    crcs = []
                    for n in docs.column("n_tokens").to_pylist():
                        crc, left = 0, n
                        while left:
                            if at == len(flat):
                                k, at = k + 1, 0
                                flat = ids.get_batch(k).column("ids").values.to_numpy(zero_copy_only=True)
                            take = flat[at:at + left]
                            crc = zlib.crc32(take.astype("<u4").tobytes(), crc)
                            at, left = at + len(take), left - len(take)
                        crcs.append(crc)
                    start = pa.array(docs.column("start").to_numpy() + base)
                    yield pa.RecordBatch.from_arrays([docs.column("doc_id"), start, docs.column("n_tokens"), pa.array(crcs, pa.int64())],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spread.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op10_arrow_token_files(spark, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents")
    return read_token_files(write_token_files(docs, scratch_path(spark, f"tokens-{uuid.uuid4().hex}"), tokenizer))
