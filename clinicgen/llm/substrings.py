"""Substring dedup: repeated runs of words found by FM-indexes over shards of the corpus.

A window is ``length`` consecutive words of a document. Every word covered by a window whose words also start earlier
(smaller id, or the same document and an earlier place) is removed; windows are judged on the input.

Streaming every document past the index of every shard would take shards x documents. So shards are made by content: each window has an anchor,
the least hash (leftmost) among its runs of ``GRAM`` words, and windows next to each other with the same anchor place form a segment. Equal
windows have equal anchors at equal places, hence lie in segments of one anchor, and a segment holds no window twice. A shard holds whole anchors.

* A segment whose anchor occurs once has no repeated window. Copies of a segment are one row (least document): the others are repeated whole.
* The remaining distinct segments, of anchors with several, are indexed by shard. Their documents stream past the shard's index in the order of the
  corpus; backward search over the wavelet tree gives each position's matching statistics, cut off at ``length`` words. Windows with
  one interval of suffixes are equal, and all but the first of an interval are repeated.
* An anchor with more than ``HOT`` distinct segments (a common phrase, a passage with many surroundings) is not put into one shard: its windows
  are routed one by one, where equal windows again are one row and nothing is left to search.

Words are 64-bit hashes; a segment is known by its anchor and a hash of its words, 128 bits together.

Cases: null texts have no words; rows that share an id count as one document and are told apart by a hash of their text, windows at the same
place of such rows are not earlier than each other; rows without an id come last and count as one document; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read, release, write
from clinicgen.llm.fmindex import FmIndex
from clinicgen.llm.hpylm import _Words

GRAM = 4
HOT = 2_000
SHARD_WORDS = 250_000
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that its powers have inverses
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_NO_ID = (1 << 63) - 1
_START, _COUNT = 30, 5  # bits of a place: text tag, start, windows


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _runs(start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places start, start + 1, ... of each run one after the other, and where runs end (led by 0)."""
    ends = np.r_[0, np.cumsum(size)]
    return np.arange(ends[-1]) + np.repeat(start - ends[:-1], size), ends


class Segments:
    """Segments of consecutive documents, given the hashes of their words one after the other."""

    def __init__(self, h: np.ndarray, sizes: np.ndarray, length: int) -> None:
        n, ends = len(h), np.cumsum(sizes)
        self.h, self.length = h, length
        grams, powers = np.zeros(n, np.uint64), _powers(_BASE, max(n, GRAM))
        for j in range(GRAM):
            grams[:max(n - j, 0)] += h[j:] * powers[j + 1]
        grams = _mix(grams)
        # leftmost least gram of each window, by doubling
        best, reach, span = np.arange(n), 1, length - GRAM + 1
        while reach < span:
            by = min(reach, span - reach)
            a, b = best[:max(n - by, 0)], best[by:]
            best = np.r_[np.where(grams[a] <= grams[b], a, b), best[max(n - by, 0):]]
            reach += by
        doc = np.repeat(np.arange(len(sizes)), sizes)
        begin = np.arange(n)
        inside = begin + length <= ends[doc] if n else np.zeros(0, bool)
        windows = begin[inside]
        place = best[inside]
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]][:len(place)])
        self.start, self.count = windows[first], np.diff(np.r_[first, len(windows)])
        self.doc = doc[self.start]
        self.anchor = grams[place[first]]
        self.local = self.start - (ends - sizes)[self.doc]
        self.upto = np.r_[np.uint64(0), np.cumsum(h * powers[:n], dtype=np.uint64)]

    def hashes(self, start: np.ndarray, words: np.ndarray | int) -> np.ndarray:
        """Hash of the ``words`` words from each start."""
        back = _powers(_INVERSE, len(self.h))
        return _mix((self.upto[start + words] - self.upto[start]) * back[start] + np.uint64(1) * np.asarray(words, np.uint64))


def _word_hashes(texts: list[str | None], words: _Words) -> tuple[np.ndarray, np.ndarray]:
    split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    return np.fromiter((words[w] for s in split for w in s), np.uint64, int(sizes.sum())), sizes


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """(doc, tag, doc_id, text): the order of documents and a tag that tells apart texts of one id."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_NO_ID)).alias("doc"), F.shiftrightunsigned(F.xxhash64(F.col(text)), 64 - 28).alias("tag"),
                       F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).alias("text"))


def _start() -> Column:
    return F.shiftright("place", _COUNT).bitwiseAND((1 << _START) - 1)


def _tag() -> Column:
    return F.shiftright("place", _COUNT + _START)


def segments(keyed: DataFrame, length: int) -> DataFrame:
    """(anchor, segment, doc, place) of all segments; a segment that its own document holds before has no anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            h, sizes = _word_hashes(b.column(2).to_pylist(), words)
            s = Segments(h, sizes, length)
            doc, tag = b.column(0).to_numpy(), b.column(1).to_numpy()
            segment = s.hashes(s.start, s.count + length - 1)
            _, first = np.unique(_mix(segment ^ s.anchor * _BASE) + s.doc.astype(np.uint64) * _BASE, return_index=True)
            again = np.ones(len(segment), bool)
            again[first] = False
            place = (tag[s.doc] << _START | s.local) << _COUNT | s.count
            columns = [pa.array(s.anchor.view(np.int64), mask=again), pa.array(segment.view(np.int64)), pa.array(doc[s.doc]), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "segment", "doc", "place"])

    return keyed.select("doc", "tag", "text").mapInArrow(run, "anchor bigint, segment bigint, doc bigint, place bigint")


def _gather(wanted: DataFrame, keyed: DataFrame, length: int) -> DataFrame:
    """The words of the wanted segments, from their documents: (anchor, hot, segment, doc, place, words); hot ones as windows, without words."""
    # a list holds segments of one document
    lists = wanted.groupBy("doc", _tag().alias("tag")).agg(F.collect_set(F.struct("place", "anchor", "hot")).alias("list"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for b in batches:
            h, sizes = _word_hashes(b.column(2).to_pylist(), words)
            s = Segments(h, sizes, length)
            begin = np.cumsum(sizes) - sizes
            lists = b.column(3)
            row = np.repeat(np.arange(len(sizes)), np.diff(lists.offsets.to_numpy()))
            items = lists.flatten()
            place, anchor, hot = items.field(0).to_numpy(), items.field(1).to_numpy(), items.field(2).to_numpy(zero_copy_only=False)
            doc = b.column(0).to_numpy()[row]
            start = begin[row] + (place >> _COUNT & (1 << _START) - 1)
            count = place & (1 << _COUNT) - 1
            names = ["anchor", "hot", "segment", "doc", "place", "words"]
            for i in range(0, len(place), 50_000):
                cold = np.flatnonzero(~hot[i:i + 50_000]) + i
                src, ends = _runs(start[cold], count[cold] + length - 1)
                blob = pa.Array.from_buffers(pa.binary(), len(cold), [None, pa.py_buffer((8 * ends).astype(np.int32).tobytes()), pa.py_buffer(h[src].tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[cold]), pa.array(hot[cold]), pa.nulls(len(cold), pa.int64()), pa.array(doc[cold]), pa.array(place[cold]), blob], names)
                warm = np.flatnonzero(hot[i:i + 50_000]) + i
                at, _ = _runs(start[warm], count[warm])
                each = np.repeat(warm, count[warm])
                window = s.hashes(at, length).view(np.int64)
                single = (place[each] >> _COUNT) + (at - start[each]) << _COUNT | 1
                yield pa.RecordBatch.from_arrays([pa.array(anchor[each]), pa.array(hot[each]), pa.array(window), pa.array(doc[each]), pa.array(single), pa.nulls(len(each), pa.binary())], names)

    joined = keyed.join(lists, ["doc", "tag"]).select("doc", "tag", "text", "list")
    return joined.mapInArrow(run, "anchor bigint, hot boolean, segment bigint, doc bigint, place bigint, words binary")


def repeated_windows(doc: np.ndarray, start: np.ndarray, words: list[bytes], length: int) -> list[np.ndarray]:
    """Per segment, whether each of its windows has the words of an earlier one of the shard."""
    flat = np.frombuffer(b"".join(words), np.uint64)
    sizes = np.array([len(w) for w in words], np.int64) // 8
    alphabet, symbol = np.unique(flat, return_inverse=True)
    # a separator (symbol 0) follows each segment
    seq = np.zeros(len(flat) + len(sizes), np.int64)
    end = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(seq), bool)
    inside[end] = False
    seq[inside] = symbol + 1
    lo, hi = FmIndex(seq, len(alphabet) + 1, length).statistics(seq, end - sizes, end)
    at = np.flatnonzero(hi > lo)  # where windows begin
    of = np.searchsorted(end, at)
    begins = start[of] + at - (end - sizes)[of]
    # equal (document, place) are one rank, so that rows of one document are not before each other
    order = np.lexsort((begins, doc[of]))
    rank = np.empty(len(at), np.int64)
    rank[order] = np.cumsum(np.r_[False, (doc[of][order][1:] != doc[of][order][:-1]) | (begins[order][1:] != begins[order][:-1])][:len(at)])
    least = np.full(len(seq), len(at), np.int64)
    np.minimum.at(least, lo[at], rank)
    again = np.zeros(len(seq), bool)
    again[at] = rank > least[lo[at]]
    return [again[e - n:e - length + 1] for e, n in zip(end.tolist(), sizes.tolist(), strict=True)]


def _search(found: DataFrame, shards: int, length: int) -> DataFrame:
    """(doc, place) of the runs of repeated windows among the segments, shard by shard."""
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        doc, place = rows["doc"].to_numpy(), rows["place"].to_numpy()
        start = place >> _COUNT & (1 << _START) - 1
        docs, places = [], []
        for d, p, again in zip(doc.tolist(), place.tolist(), repeated_windows(doc, start, rows["words"].tolist(), length), strict=True):
            edge = np.flatnonzero(np.diff(np.r_[False, again, False]))
            for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
                docs.append(d)
                places.append(((p >> _COUNT) + i) << _COUNT | (j - i))
        return pd.DataFrame({"doc": np.array(docs, np.int64), "place": np.array(places, np.int64)})

    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards))
    return found.select(shard.alias("shard"), "doc", "place", "words").groupBy("shard").applyInPandas(run, "doc bigint, place bigint")


def repeats(docs: DataFrame, length: int = 20, text: str = "text", hot: int = HOT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc, tag, spans): per document the spans [from, to) of words covered by a repeated window; spans may overlap. ``length``: GRAM to GRAM + 27 words."""
    if not GRAM <= length < GRAM + (1 << _COUNT) - 4:
        raise ValueError(f"length: {GRAM} to {GRAM + (1 << _COUNT) - 5}")
    spark, keyed = docs.sparkSession, _keyed(docs, text)
    every, every_place = write(segments(keyed, length), "substring-segments")
    several = every.where("anchor is not null").groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    columns = ("anchor", "segment", "doc", "place")
    met, met_place = write(every.join(several, "anchor").select(*columns).union(every.where("anchor is null").select(*columns)), "substring-met")
    del every, several
    release(spark, every_place)
    least, least_place = write(met.where("anchor is not null").groupBy("anchor", "segment").agg(F.min("doc").alias("doc")), "substring-least")
    # joined by document too: copies of a segment don't meet in one task; rows without an anchor stay as well
    copies = met.join(least, ["anchor", "segment", "doc"], "left_anti").select("doc", "place")
    forms = least.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", (F.col("n") > hot).alias("hot"))
    wanted, wanted_place = write(met.join(least, ["anchor", "segment", "doc"], "left_semi").join(forms, "anchor").select("anchor", "hot", "doc", "place"), "substring-wanted")
    found, found_place = write(_gather(wanted, keyed, length), "substring-words")
    del wanted, forms
    release(spark, wanted_place)
    words = found.where("not hot").agg(F.sum(F.length("words"))).first()[0] or 0
    searched = _search(found.where("not hot"), max(1, -(-words // (8 * shard_words))), length)
    windows = found.where("hot").select("anchor", "segment", "doc", "place", _start().alias("start"))
    first = windows.groupBy("anchor", "segment").agg(F.min(F.struct("doc", "start")).alias("f")).select("anchor", "segment", "f.doc", "f.start")
    single = windows.join(first, ["anchor", "segment", "doc", "start"], "left_anti").select("doc", "place")
    spans = copies.union(searched).union(single).select(
        "doc", _tag().alias("tag"), _start().alias("s"), (_start() + F.col("place").bitwiseAND((1 << _COUNT) - 1) + (length - 1)).alias("e"))
    spans = cut(spans.groupBy("doc", "tag").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "substring-spans")
    del met, least, found, copies, searched, windows, first, single
    release(spark, met_place, least_place, found_place)
    return spans


def remove_repeats(docs: DataFrame, length: int = 20, text: str = "text", **how: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept``: the words that are left, joined by a space."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for t, spans in zip(b.column(1).to_pylist(), b.column(2), strict=True):
                words = (t or "").encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                if spans.is_valid and len(spans.values):
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, spans.values.field(0).to_numpy(), 1)
                    np.add.at(edge, spans.values.field(1).to_numpy(), -1)
                    stays = np.cumsum(edge)[:-1] == 0
                    words = [w for w, s in zip(words, stays.tolist(), strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept"])

    keyed = _keyed(docs, text)
    joined = keyed.join(repeats(docs, length, text, **how), ["doc", "tag"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id bigint, n_words bigint, n_removed bigint, kept string")


def op12_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(read(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
