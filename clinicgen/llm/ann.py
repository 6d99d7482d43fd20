"""Nearest neighbours by inner product in a hierarchical k-means tree, searched best bin first.

The tree is fitted on a sample of at most ``sample`` vectors (those of least id hash) and every
row is indexed: it descends to the leaf of its nearest centroids. A query walks the tree with
a priority queue over centroid inner products and visits leaves in that order. How many
is calibrated: for a bounded set of calibration queries the exact neighbours are found against all rows
in blocks, and the number of leaves is widened until the mean recall reaches its target and that of each of them a floor. It is a number of its own
for queries in leaves of each of four sizes, as in one mean those of dense regions would hide the others. A query goes on past it until its leaves hold more than k rows.

Query and row meet in blocks of a leaf: a leaf's rows and its queries are salted by their counts,
so a leaf that holds a third of all rows is many blocks. Blocks return their best, with scores of
the original vectors in double precision, computed alike for equal vectors.

Cases: vectors that are null, empty, zero, of another length than most, or hold a null or
non-finite component take no part, nor do rows with a null id; of rows that share an id the least vector
counts; ties go to the smaller id; fewer candidates than k are all returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, read

BLOCK_ROWS, BLOCK_QUERIES = 32_768, 2048


@dataclass
class Node:
    centroid: np.ndarray
    children: list[Node] = field(default_factory=list)
    leaf: int = -1


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centers = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        at = np.argmin((centers ** 2).sum(1) - 2 * x @ centers.T, axis=1)
        for j in range(k):
            if (at == j).any():
                centers[j] = x[at == j].mean(axis=0)
    return centers, np.argmin((centers ** 2).sum(1) - 2 * x @ centers.T, axis=1)


def fit_tree(x: np.ndarray, leaf_rows: int, branch: int = 8, seed: int = 2) -> tuple[Node, int]:
    """(root, number of leaves); nodes split until ``leaf_rows`` sample rows or no difference is left."""
    rng, leaves = np.random.default_rng(seed), 0

    def grow(rows: np.ndarray, center: np.ndarray) -> Node:
        nonlocal leaves
        node = Node(center)
        if len(rows) > max(leaf_rows, branch):
            centers, at = _kmeans(rows, branch, rng)
            kept = [j for j in range(branch) if (at == j).any()]
            if len(kept) > 1:
                node.children = [grow(rows[at == j], centers[j]) for j in kept]
                return node
        node.leaf, leaves = leaves, leaves + 1
        return node

    return grow(x, x.mean(axis=0) if len(x) else np.zeros(1)), leaves


def assign(root: Node, x: np.ndarray) -> np.ndarray:
    """Leaf of every row, descending to the nearest centroid."""
    out = np.zeros(len(x), np.int32)

    def go(node: Node, rows: np.ndarray) -> None:
        if not node.children:
            out[rows] = node.leaf
            return
        c = np.stack([n.centroid for n in node.children])
        at = np.argmin((c ** 2).sum(1) - 2 * x[rows] @ c.T, axis=1)
        for j, child in enumerate(node.children):
            if (at == j).any():
                go(child, rows[at == j])

    go(root, np.arange(len(x)))
    return out


def best_bins(root: Node, q: np.ndarray, visits: int, held: np.ndarray | None = None, least: int = 0) -> list[int]:
    """The first ``visits`` leaves in best-bin-first order, and further ones until they hold ``least`` rows (``held``: rows per leaf)."""
    heap, n, rows, out = [(0.0, 0, root)], 0, 0, []
    while heap and (len(out) < visits or (held is not None and rows < least)):
        _, _, node = heapq.heappop(heap)
        if not node.children:
            out.append(node.leaf)
            rows += int(held[node.leaf]) if held is not None else 0
            continue
        for child, s in zip(node.children, np.stack([c.centroid for c in node.children]) @ q, strict=True):
            n += 1
            heapq.heappush(heap, (-float(s), n, child))
    return out


def _exact(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products row by row, so that equal vectors score equal to the last bit."""
    return (q * v).sum(axis=1)


def block_best(qid: np.ndarray, q: np.ndarray, vid: np.ndarray, v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query ids, row ids, scores): the best k rows of ``v`` per query, own id left out, ties to the smaller id."""
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for s in range(0, len(q), 256):
        sims = q[s:s + 256] @ v.T
        sims[qid[s:s + 256, None] == vid[None, :]] = -np.inf
        for i, row in enumerate(sims):
            if len(row) > k:
                edge = np.partition(row, len(row) - k)[len(row) - k]
                near = np.flatnonzero(row >= edge - 1e-9 * max(1.0, abs(edge))) if np.isfinite(edge) else np.flatnonzero(np.isfinite(row))
            else:
                near = np.flatnonzero(np.isfinite(row))
            score = _exact(q[s + i][None, :], v[near])
            top = np.lexsort((vid[near], -score))[:k]
            out.append((np.full(len(top), qid[s + i]), vid[near][top], score[top]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))  # type: ignore[return-value]


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors that take part, one row per id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda x: x != 0)))
    rows = cut(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "ann-rows")
    dim = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (dim["n"] if dim else 0))


def _nearest(parts: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return parts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, recall: float = 0.97, floor: float = 0.9, sample: int = 20_000, calibrators: int = 256,
           leaves: int = 64, leaf_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of ``queries`` against ``vectors`` (both (vec_id, v) of ``usable``).

    The tree aims at ``leaves`` leaves, or at leaves of ``leaf_rows`` rows where that is more, up to ``sample / 32``. Each visit
    returns at most k rows, so what a query shuffles follows its visits, not the rows it passes.
    """
    spark = vectors.sparkSession
    out = "query_id bigint, rank int, vec_id bigint, score double"
    total = vectors.count()
    if not total:
        return spark.createDataFrame([], out)
    fit = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).toPandas()  # at most `sample` rows
    x = np.array(fit["v"].tolist(), np.float64)
    dim = x.shape[1]
    aim = max(leaves, math.ceil(total / leaf_rows))
    root, n_leaves = fit_tree(x, max(32, math.ceil(2 * len(x) / aim)))  # nodes split down to twice the mean
    tree = spark.sparkContext.broadcast(root)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf = assign(tree.value, _matrix(b.column(1), dim))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(leaf)], ["vec_id", "v", "leaf"])

    rows = cut(vectors.select("vec_id", "v").mapInArrow(index, "vec_id bigint, v array<double>, leaf int"), "ann-index")
    held = np.zeros(n_leaves, np.int64)
    for r in rows.groupBy("leaf").count().collect():  # a row per leaf
        held[r["leaf"]] = r["count"]
    edges, visits = _calibrate(rows, queries, root, held, dim, k, recall, floor, calibrators)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            q = _matrix(b.column(1), dim)
            own = [int(visits[np.searchsorted(edges, held[best_bins(tree.value, x, 1)[0]])]) for x in q]
            bins = [best_bins(tree.value, x, n, held, k + 1) for x, n in zip(q, own, strict=True)]
            at = pa.array(np.repeat(np.arange(len(q)), [len(x) for x in bins]), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array([x for y in bins for x in y], pa.int32())], ["vec_id", "v", "leaf"])

    asked = cut(queries.select("vec_id", "v").mapInArrow(visit, "vec_id bigint, v array<double>, leaf int"), "ann-visits")
    # blocks: a row per leaf, at most sample / 32 of them
    size = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("row_parts"))
    load = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK_QUERIES).cast("int").alias("query_parts"))
    grid = F.broadcast(cut(size.join(load, "leaf"), "ann-grid"))
    salt = lambda n: F.pmod(F.xxhash64(F.lit(17), F.col("vec_id")), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = asked.join(grid, "leaf").withColumn("qp", salt("query_parts")).withColumn("rp", every("row_parts")).select("leaf", "rp", "qp", "vec_id", "v")
    right = rows.join(grid, "leaf").withColumn("rp", salt("row_parts")).withColumn("qp", every("query_parts")).select("leaf", "rp", "qp", "vec_id", "v")

    def meet(q: pa.Table, v: pa.Table) -> pa.Table:
        if not q.num_rows or not v.num_rows:
            ids, near, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            ids, near, score = block_best(q["vec_id"].to_numpy(), _matrix(q["v"].combine_chunks(), dim), v["vec_id"].to_numpy(), _matrix(v["v"].combine_chunks(), dim), k)
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(near, pa.int64()), "score": pa.array(score, pa.float64())})

    key = ["leaf", "rp", "qp"]
    parts = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(meet, "query_id bigint, vec_id bigint, score double")
    return _nearest(parts, k).select("query_id", "rank", "vec_id", "score")


def exact(rows: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """(query_id, vec_id, leaf, rank): brute force of a bounded set of queries against all rows, block by block."""
    dim, shared = q.shape[1], rows.sparkSession.sparkContext.broadcast((ids, q))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_, q_ = shared.value
        best = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "leaf": np.zeros(0, np.int32), "score": np.zeros(0)})
        for b in batches:
            if not b.num_rows:
                continue
            vid = b.column(0).to_numpy()
            a, n, s = block_best(ids_, q_, vid, _matrix(b.column(1), dim), k)
            leaf = pd.Series(b.column(2).to_numpy(), index=vid).loc[n].to_numpy()
            best = pd.concat([best, pd.DataFrame({"query_id": a, "vec_id": n, "leaf": leaf, "score": s})])
            best = best.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k)
        yield pa.RecordBatch.from_pandas(best, preserve_index=False)

    return _nearest(rows.mapInArrow(run, "query_id bigint, vec_id bigint, leaf int, score double"), k)


_SIZES = 4


def _calibrate(rows: DataFrame, queries: DataFrame, root: Node, held: np.ndarray, dim: int, k: int, recall: float, floor: float, calibrators: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves to visit, by the rows in a query's first leaf (up to each edge, and above): widened until the calibration queries' mean recall
    reaches ``recall`` and that of each of them ``floor``."""
    none, n_leaves = np.zeros(0, np.int64), len(held)
    picked = queries.select("vec_id", "v").orderBy(F.xxhash64(F.lit(5), "vec_id"), "vec_id").limit(calibrators).toPandas()
    if picked.empty or n_leaves == 1:
        return none, np.array([n_leaves])
    ids, q = picked["vec_id"].to_numpy(np.int64), np.array(picked["v"].tolist(), np.float64).reshape(-1, dim)
    walk = {int(i): best_bins(root, x, n_leaves) for i, x in zip(ids, q, strict=True)}
    ranks: dict[int, list[int]] = {}
    for r in exact(rows, ids, q, k).select("query_id", "leaf").collect():  # calibrators x k rows
        ranks.setdefault(r["query_id"], []).append(walk[r["query_id"]].index(r["leaf"]))
    if not ranks:
        return none, np.array([n_leaves])
    size = {i: int(held[walk[i][0]]) for i in ranks}
    edges = np.unique(np.quantile(list(size.values()), np.arange(1, _SIZES) / _SIZES, method="lower").astype(np.int64))
    reached = lambda x, share: sorted(x)[max(0, math.ceil(share * len(x)) - 1)]
    visits = []
    for j in range(len(edges) + 1):
        group = [x for i, x in ranks.items() if np.searchsorted(edges, size[i]) == j] or list(ranks.values())
        visits.append(1 + max(reached([r for x in group for r in x], recall), *[reached(x, floor) for x in group]))
    return edges, np.array(visits)


def op9_kmeans_tree_search(spark, sf_dir: str) -> DataFrame:
    vectors = usable(read(spark, sf_dir, "embeddings"))
    return search(vectors, vectors.where("vec_id % 20 = 0"))
