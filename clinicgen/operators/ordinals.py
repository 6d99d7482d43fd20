"""Ordinals without a single-partition window.

A global (or per-group) running count/sum is split in two:

1. totals per *block* -- a small table of (group, block) rows -- and their
   running sum, which gives each block's offset;
2. a running sum inside each block, a window partitioned by (group, block).

Blocks must be monotone in the order (the true order is ``(block..., order...)``)
and small enough to sort in one task. Block counts are bounded by the caller
(``rows / block_rows`` plus one per group), never by a hot key: a key that
holds a third of all rows is split over many blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicgen.functions import draws as D
from clinicgen.session import cut_lineage, spread

DEFAULT_BLOCK_ROWS = 131_072  # rows a task ranks: small enough that a few million rows use every slot


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def prefix_sum(
    df: DataFrame,
    value: Column,
    order: Sequence[str],
    blocks: Sequence[str],
    partition: Sequence[str] = (),
    out: str = "prefix",
    inclusive: bool = True,
) -> DataFrame:
    """Running sum of ``value`` within ``partition`` in ``(blocks, order)`` order.

    ``order`` must make the order total inside a block (add a unique key) so
    the result is deterministic under recomputation. Columns named in
    ``blocks`` / ``partition`` must be non-NULL.
    """
    part, blk = list(partition), list(blocks)
    tmp = df.withColumn("_pv", value)
    if not blk:
        # no blocks: each partition is one block (callers pass this only with a proven
        # bound on the partition's rows), so the running sum is a plain window
        if not part:
            raise ValueError("prefix_sum needs blocks or a partition: a global window would run in one task")
        run = tmp.withColumn("_in", F.sum("_pv").over(
            Window.partitionBy(*part).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)))
        total = F.col("_in") if inclusive else F.col("_in") - F.col("_pv")
        return run.withColumn(out, total).drop("_pv", "_in")
    totals = tmp.groupBy(*part, *blk).agg(F.sum("_pv").alias("_bt"))
    before = Window.partitionBy(*part).orderBy(*blk).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*part, *blk, F.coalesce(F.sum("_bt").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*part, *blk).orderBy(*_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    run = tmp.withColumn("_in", F.sum("_pv").over(inside))
    res = run.join(offsets, on=[*part, *blk], how="inner")
    total = F.col("_off") + F.col("_in")
    if not inclusive:
        total = total - F.col("_pv")
    return res.withColumn(out, total).drop("_pv", "_off", "_in")


def rank_in_order(df: DataFrame, order: Sequence[str], blocks: Sequence[str], partition: Sequence[str] = (), out: str = "rank") -> DataFrame:
    """1-based position of each row within ``partition`` in ``(blocks, order)`` order."""
    return prefix_sum(df, F.lit(1).cast("bigint"), order, blocks, partition, out)


def n_blocks(rows: int, block_rows: int = DEFAULT_BLOCK_ROWS) -> int:
    return max(1, math.ceil(max(rows, 1) / block_rows))


def _placed(df: DataFrame, order_col: str, name: str) -> DataFrame:
    """The rows in order, with their range partition ``_p`` and place ``_at``, which ascends within it.

    The sorted rows are written once (a range partitioning recomputed after a loss could differ).
    """
    at = F.monotonically_increasing_id()  # partition number << 33, then the row's place in it
    return cut_lineage(df.orderBy(order_col).withColumn("_at", at), name).withColumn("_p", F.shiftright("_at", 33))


def dense_ids(df: DataFrame, order_col: str, id_col: str, start: int = 1, bounds: tuple[int, int] | None = None,
              block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` following a sortable column (2.6.4).

    ``bounds`` (first, last), for a caller whose order column holds distinct whole numbers of that range, such as a spine's: blocks
    are then equal slices of it, found by arithmetic. Otherwise blocks come from the data: range partitions number their own rows, and one row per
    partition gives the offsets, so sparse or clustered keys change nothing.
    """
    if bounds is not None:
        block = F.floor((F.col(order_col) - F.lit(bounds[0])) / F.lit(block_rows)).cast("bigint")
        ranked = rank_in_order(df.withColumn("_iblk", block), [order_col], ["_iblk"], out=id_col).drop("_iblk")
        return ranked.withColumn(id_col, (F.col(id_col) + F.lit(start - 1)).cast("bigint"))
    placed = _placed(df, order_col, "dense-ids")
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    offsets = sizes.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    rank = F.col("_off") + F.col("_at").bitwiseAND((1 << 33) - 1) + F.lit(start)
    return placed.join(offsets, "_p").withColumn(id_col, rank.cast("bigint")).drop("_p", "_at", "_off")


def uniform_rank(
    df: DataFrame,
    ucol: str,
    key: str,
    out: str = "rank",
    partition: Sequence[str] = (),
    expected_rows: int | None = None,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Position in ``(ucol, key)`` order, ``ucol`` uniform in [0, 1).

    Blocks are ``floor(u * S)``: equal-width slices of a uniform, so each
    holds about rows/S rows whatever the key distribution. The block count
    only affects speed, never the ranks.
    """
    if expected_rows is None:
        expected_rows = df.count()
    s = n_blocks(expected_rows, block_rows)
    blk = df.withColumn("_ublk", F.floor(F.col(ucol) * F.lit(s)).cast("bigint"))
    return rank_in_order(blk, [ucol, key], ["_ublk"], partition, out).drop("_ublk")


_CELLS = 64  # cells of a block's slice of the draw


def sample_without_replacement(
    df: DataFrame,
    key: str,
    n: int,
    seed: int,
    label: str,
    out: str = "draw_no",
    expected_rows: int | None = None,
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """``n`` distinct rows, each with its draw number 1..n (2.4.11).

    Equivalent to drawing keys one by one without replacement: rows are
    ordered by a seeded uniform (ties by key) and the first ``n`` are kept.
    A histogram of the draw finds the cell that holds the n-th row; rows of later cells are dropped where they are read, and
    only the others are ranked, block by block.
    """
    if expected_rows is None:
        expected_rows = df.count()
    if n <= 0:
        return df.withColumn(out, F.lit(None).cast("bigint")).limit(0)
    s = n_blocks(expected_rows, block_rows)
    drawn = df.withColumn("_su", D.col(D.u(seed, label, key)))
    cell, block = F.floor(F.col("_su") * F.lit(s * _CELLS)).cast("bigint"), F.floor(F.col("_su") * F.lit(s)).cast("bigint")
    cells = cut_lineage(drawn.groupBy(block.alias("_ublk"), cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n")), "draw-histogram")
    blocks = cells.groupBy("_ublk").agg(F.sum("_n").alias("_bt"))  # a row per block
    offsets = blocks.withColumn("_off", F.coalesce(F.sum("_bt").over(Window.orderBy("_ublk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    upto = F.col("_off") + F.sum("_n").over(Window.partitionBy("_ublk").orderBy("_cell"))
    cut = cells.join(offsets.select("_ublk", "_off"), "_ublk").withColumn("_upto", upto).where(F.col("_upto") >= n).agg(F.min("_cell")).first()[0]
    if cut is not None:  # the cell that holds the n-th row
        drawn = drawn.where(cell <= cut)
    rank = F.row_number().over(Window.partitionBy("_ublk").orderBy("_su", key))
    ranked = drawn.withColumn("_ublk", block).withColumn("_in", rank).join(offsets.select("_ublk", "_off"), "_ublk")
    return ranked.withColumn(out, F.col("_off") + F.col("_in")).where(F.col(out) <= n).drop("_su", "_ublk", "_in", "_off")


_RUN_LENGTH = 100_000  # copies unfolded from one row


def shuffle_multiset(
    counts: DataFrame,
    n: int,
    seed: int,
    label: str,
    pos_col: str = "pos",
    value_col: str = "value",
    order_col: str = "value",
    block_rows: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """A seeded shuffle of each ``value`` repeated ``n`` times, as (pos 1..n, value) (2.4.12).

    ``counts`` has (value, n), one row per value; the multiset must have exactly ``n`` elements,
    which is checked first. Elements are numbered in ``order_col`` order and take their shuffled position from
    the rank of their uniform draw; a value's copies unfold in runs, never as one large array.
    """
    placed = _placed(counts.select("value", F.col(order_col).alias("_ord"), F.col("n").cast("bigint").alias("n")), "_ord", "multiset")
    parts = placed.groupBy("_p").agg(F.sum("n").alias("_pn"), F.min("n").alias("_least"))  # a row per range partition
    total, least = parts.agg(F.sum("_pn"), F.min("_least")).first()
    if (total or 0) != n or (least or 0) < 0:
        raise ValueError(f"multiset has {total or 0} elements (least count {least}), expected {n}")
    offsets = parts.select("_p", F.coalesce(F.sum("_pn").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    inside = F.sum("n").over(Window.partitionBy("_p").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    laid = placed.withColumn("_in", inside).join(offsets, "_p").withColumn("_hi", F.col("_off") + F.col("_in")).where("n > 0")
    runs = laid.select("value", (F.col("_hi") - F.col("n")).alias("_lo"), "_hi").withColumn(
        "_s", F.explode(F.expr(f"sequence(_lo, _hi - 1, {_RUN_LENGTH}L)")))
    runs = spread(runs, "value", "_s")
    elems = runs.select(F.col("value").alias(value_col), F.explode(F.expr(f"sequence(_s, least(_s + {_RUN_LENGTH - 1}, _hi - 1))")).alias("_e"))
    elems = elems.withColumn("_mu", D.col(D.u(seed, label, "_e")))
    ranked = uniform_rank(elems, "_mu", "_e", out=pos_col, expected_rows=n, block_rows=block_rows)
    return ranked.select(F.col(pos_col).cast("bigint"), F.col(value_col))
