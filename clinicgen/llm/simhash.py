"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A document's 64-bit fingerprint is the bitwise majority of the XXH64 of its word shingles
(repeats included). Two fingerprints that differ in at most ``max_bits`` = k bits share at
least ``8 - k`` of their 8 positional bytes, so ``8 - k`` is the guaranteed minimum of
the count filter. The index is posted under every choice of ``8 - k`` byte positions with the
bytes there: two fingerprints meet in a posting list just when their tally of shared
positional bytes reaches the minimum (posting single bytes and counting afterwards would list
n / 256 fingerprints under each key, a pair count that grows with the square of n). A
list holds distinct fingerprints equal but for k bytes, at most ``256 ** k`` of them, and is
verified by enumerating the bit flips within k bits in those free bytes, not pair by pair.
Lists give a spanning set of their links; components follow by star contraction.

Equal fingerprints are one node throughout, so groups of copies cost one row.

Cases: null or wordless texts have fingerprint zero and link like any other; repeated rows share
a component; a component whose ids are all null has a null id; empty tables give empty
results; extra columns are ignored by the fingerprint and kept by ``deduplicate``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read
from clinicgen.llm.components import components

_BLOCK = 1 << 15  # shingles whose bits are unpacked at a time


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one text (A-Z lower-cased, split at ASCII white space)."""
    if not text:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        grams = [h64(b" ".join(words), seed)]
    else:
        joined = b" ".join(words)
        at, starts = 0, []
        for w in words:
            starts.append(at)
            at += len(w) + 1
        ends = starts[shingle:] + [at]
        grams = [h64(joined[s:e - 1], seed) for s, e in zip(starts, ends, strict=False)]
    h = np.fromiter(grams, "<u8", len(grams))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), _BLOCK):
        bits = np.unpackbits(h[i:i + _BLOCK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprint_column(text: str = "text", shingle: int = 3) -> Column:
    """The fingerprint of a text column as a signed 64-bit integer."""
    @F.pandas_udf("bigint")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))
    return fp(F.col(text))


def _flips(free: tuple[int, ...], k: int) -> np.ndarray:
    """All XOR masks of 1..k bits inside the free bytes."""
    bits = [np.uint64(1 << (8 * p + i)) for p in free for i in range(8)]
    return np.array([np.bitwise_or.reduce(np.array(c, np.uint64)) for n in range(1, k + 1) for c in combinations(bits, n)], np.uint64)


def tally(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Positional bytes that two fingerprints share, of 8."""
    return ((a ^ b)[:, None].view(np.uint8) == 0).sum(axis=1)


def _spanning(list_: np.ndarray, flips: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Links (larger, smaller) that connect the fingerprints of one posting list as its pairs within k bits do.

    Candidate pairs (some bits flipped) are counted, kept if they share at least ``8 - k`` bytes, and verified by their differing bits.
    """
    fps = np.unique(list_)
    parent = np.arange(len(fps))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    out = []
    for m in flips:
        other = fps ^ m
        at = np.minimum(np.searchsorted(fps, other), len(fps) - 1)
        i = np.flatnonzero((fps[at] == other) & (other < fps))
        i = i[tally(fps[i], fps[at[i]]) >= 8 - k]
        for i in i[np.bitwise_count(fps[i] ^ fps[at[i]]) <= k]:
            a, b = root(i), root(at[i])
            if a != b:
                parent[a] = b
                out.append((int(fps[i]), int(fps[at[i]])))
    return out


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect just what pairs within ``max_bits`` connect."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2: a posting list holds up to 256 ** max_bits fingerprints")
    if max_bits == 0:
        return fps.sparkSession.createDataFrame([], "a bigint, b bigint")
    choices = list(combinations(range(8), max_bits))  # the byte positions left free
    masks = [np.uint64(0xFFFFFFFFFFFFFFFF) ^ np.bitwise_or.reduce(np.array([0xFF << (8 * p) for p in c], np.uint64)) for c in choices]
    keys = F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("free"), F.col("fp").bitwiseAND(F.lit(int(m.view(np.int64)))).alias("bytes"))
                               for i, m in enumerate(masks)]))
    posted = fps.select("fp", keys.alias("k")).groupBy("k.free", "k.bytes").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = [_flips(c, max_bits) for c in choices]
        for b in batches:
            found: list[tuple[int, int]] = []
            for free, list_ in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                found += _spanning(list_.values.to_numpy().view(np.uint64), flips[free], max_bits)
            pairs = np.array(found, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])

    return posted.select("free", "fps").mapInArrow(verify, "a bigint, b bigint").distinct()


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """The nodes (fp, ...) with ``root``, the least fingerprint reachable through links."""
    roots = components(links(nodes.select("fp"), max_bits))
    return nodes.join(roots, nodes["fp"] == roots["node"], "left").drop("node").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, fp, root, component_id) of every row: the least fingerprint and the least id reachable through linked fingerprints."""
    rows = cut(docs.select(F.col(id_col).alias("doc_id"), fingerprint_column(text, shingle).alias("fp")), "simhash-rows")
    rooted = _rooted(cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes"), max_bits)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = cut(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-components")
    return rows.join(ids, "fp").select("doc_id", "fp", "root", "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3, max_bits: int = 2, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row of each component: that with its least id and, of its rows with this id, the least fingerprint and hash of the text (any where these agree).

    Rows are numbered and written with their fingerprint once; whom to keep is found by fingerprint, one row of each. Texts are exchanged once, by row number, at every
    size (hashed against the numbers that stay, without a sort).
    """
    rows = cut(docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), fingerprint_column(text, shingle).alias("fp"),
                           F.xxhash64(text).alias("mark"), F.monotonically_increasing_id().alias("rid")), "simhash-rows")
    order = F.struct(F.col("id").isNull().alias("nameless"), "id", "fp", "mark", "rid")
    nodes = cut(rows.groupBy("fp").agg(F.min(order).alias("least")), "simhash-nodes")
    kept = cut(_rooted(nodes, max_bits).groupBy("root").agg(F.min("least").alias("least")).select("least.rid"), "simhash-kept")
    return rows.join(kept.hint("shuffle_hash"), "rid", "left_semi").select("row.*")


def op7_simhash_components(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
