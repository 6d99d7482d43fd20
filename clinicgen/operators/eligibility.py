"""Range-join picks and accept/reject to a target.

``eligible_pick`` answers, for every left row, "a uniformly random pool row
whose date is <= (or >=) mine" without a theta join. The pool is ranked once
in date order (``rank_pool``; ties broken by a seeded uniform, then the id), so
the eligible pool of any left date is a *prefix* of that order whose length k
comes from a calendar of running counts. The pick is rank ``1 + floor(u * k)``:
an equi-join on rank.

Work: one aggregate of the pool down to a calendar (one row per day of the date
range), a block-wise rank of the pool (see ``ordinals``), and one equi-join. A
date holding a third of the pool is split into many rank blocks. Left rows
with a small pool share few ranks: the first ``HOT_RANKS`` pool rows are
replicated ``SALTS`` times and their left rows salted. Left rows without a pool
get a key of their own instead of NULL, so they don't share a partition.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicgen.functions import draws as D
from clinicgen.operators.ordinals import DEFAULT_BLOCK_ROWS, dense_ids, rank_in_order
from clinicgen.session import cut_lineage

CALENDAR_BROADCAST_DAYS = 1_000_000  # 16 bytes a day; longer calendars are joined as AQE finds best
HOT_RANKS, SALTS = 1024, 32  # replicated pool rows: their product at most, whatever the data


def epoch_day(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01").cast("date"))


class RankedPool(NamedTuple):
    """A pool in eligibility order, ready to be picked from by any number of left sides."""
    ranked: DataFrame      # (_prank, _ok, id, other columns)
    calendar: DataFrame    # (_lk, _k): eligible rows per order key
    pool_id: str
    sign: int              # order key = epoch day * sign; eligible for key L: _ok <= L
    first_key: int
    last_key: int


def rank_pool(
    pool: DataFrame,
    pool_date: str,
    pool_id: str,
    seed: int,
    label: str,
    direction: str = "le",
    date_range: tuple[dt.date, dt.date] | None = None,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    keep: bool = False,
) -> RankedPool:
    """Rank the pool in eligibility order and count it per day.

    ``date_range``: proven first and last pool date (asked of the pool where not given). ``keep`` writes the ranked
    pool once, for pools that several plans pick from.
    """
    if direction not in ("le", "ge"):
        raise ValueError("direction must be 'le' or 'ge'")
    sign = 1 if direction == "le" else -1
    if date_range is None:
        row = pool.agg(F.min(pool_date), F.max(pool_date)).first()
        date_range = (row[0] or dt.date(1970, 1, 1), row[1] or dt.date(1970, 1, 1))
    days = sorted(sign * (d - dt.date(1970, 1, 1)).days for d in date_range)
    p = pool.withColumn("_ok", epoch_day(F.col(pool_date)) * F.lit(sign)).withColumn("_tb", D.col(D.u(seed, f"{label}.tb", pool_id)))
    counts = p.groupBy("_ok").agg(F.count(F.lit(1)).alias("_cnt"))
    # blocks inside one date: floor(tb * S_d), S_d = ceil(cnt / block_rows)
    sub = counts.select("_ok", F.greatest(F.lit(1), F.ceil(F.col("_cnt") / F.lit(block_rows))).cast("bigint").alias("_s"))
    p = p.join(_calendar_join(sub, days), on="_ok").withColumn("_sb", F.floor(F.col("_tb") * F.col("_s")).cast("bigint")).drop("_s")
    ranked = rank_in_order(p, ["_tb", pool_id], ["_ok", "_sb"], out="_prank").drop("_sb", "_tb")
    # a row per day of the range, and one before it for left dates that precede the whole pool
    every = pool.sparkSession.range(days[0] - 1, days[1] + 1, 1, 1).select(F.col("id").alias("_lk"))
    upto = Window.orderBy("_lk").rowsBetween(Window.unboundedPreceding, 0)
    calendar = (every.join(counts.select(F.col("_ok").cast("bigint").alias("_lk"), "_cnt"), "_lk", "left")
                .select("_lk", F.sum(F.coalesce("_cnt", F.lit(0))).over(upto).alias("_k")))
    if keep:
        ranked, calendar = cut_lineage(ranked, "ranked-pool"), cut_lineage(calendar, "pool-calendar")
    return RankedPool(ranked, calendar, pool_id, sign, days[0], days[1])


def _calendar_join(df: DataFrame, days: list[int]) -> DataFrame:
    return F.broadcast(df) if days[1] - days[0] < CALENDAR_BROADCAST_DAYS else df


def eligible_pick(left: DataFrame, left_date: str, u_pick: Column | str, pool: RankedPool, pool_cols: list[str] = (), size_col: str = "pool_size") -> DataFrame:
    """Left rows plus ``size_col`` (k), the picked pool row's id and ``pool_cols``.

    With an empty pool (k = 0, also for a NULL date) the pool columns are NULL; callers reject or raise.
    """
    u_pick = D.col(u_pick) if isinstance(u_pick, str) else u_pick
    key = epoch_day(F.col(left_date)) * F.lit(pool.sign)
    near = F.when(key.isNotNull(), F.greatest(F.lit(pool.first_key - 1), F.least(F.lit(pool.last_key), key))).cast("bigint")
    l = left.withColumn("_lk", near).withColumn("_pu", u_pick)
    l = l.join(_calendar_join(pool.calendar, [pool.first_key, pool.last_key]), on="_lk", how="left")
    k, spare = F.coalesce("_k", F.lit(0)).cast("bigint"), F.pmod(F.xxhash64("_pu"), F.lit(1 << 30))
    l = l.withColumn(size_col, k).withColumn(
        "_r", F.when(F.col(size_col) > 0, F.floor(F.col("_pu") * F.col(size_col)) + 1).otherwise(-1 - spare).cast("bigint"))
    l = l.withColumn("_salt", F.when(F.col("_r").between(1, HOT_RANKS), F.pmod(spare, F.lit(SALTS))).otherwise(0).cast("int"))
    salts = F.when(F.col("_prank") <= HOT_RANKS, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    picked = pool.ranked.select(F.col("_prank").alias("_r"), F.explode(salts).alias("_salt"), pool.pool_id, *pool_cols)
    return l.join(picked, on=["_r", "_salt"], how="left").drop("_lk", "_pu", "_k", "_r", "_salt")


def reject_cut(attempts: DataFrame, accepted: str, order_col: str, max_rejects: int | None) -> int | None:
    """Attempt number at which the ``max_rejects``-th reject happens (2.4.17).

    A distributed top-k (``orderBy().limit()``) of rejected attempt numbers;
    only the k-th value reaches the driver. None = no cap reached.
    """
    if max_rejects is None:
        return None
    top = attempts.filter(~F.col(accepted)).select(order_col).orderBy(order_col).limit(max_rejects)
    agg = top.agg(F.count(F.lit(1)).alias("n"), F.max(order_col).alias("cut")).collect()[0]
    return int(agg["cut"]) if agg["n"] == max_rejects else None


def accept_first(
    attempts: DataFrame,
    accepted: str,
    order_col: str,
    target: int,
    id_col: str,
    start: int = 1,
    max_rejects: int | None = None,
    cut: int | None = None,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """The first ``target`` accepted attempts in attempt order, with dense ids (2.4.16).

    Attempts after the ``max_rejects``-th reject are dropped (the loop would
    have stopped there), so fewer than ``target`` rows may come back. A caller
    that already has the cut (``reject_cut``) passes it as ``cut``; ``bounds``: see ``dense_ids``.
    """
    if cut is None:
        cut = reject_cut(attempts, accepted, order_col, max_rejects)
    acc = attempts.filter(F.col(accepted))
    if cut is not None:
        acc = acc.filter(F.col(order_col) < F.lit(cut))
    return dense_ids(acc, order_col, id_col, start=start, bounds=bounds).filter(F.col(id_col) < F.lit(start + target))


def attempts_needed(target: int, p_accept: float, slack: float = 1.05) -> int:
    """Attempts to generate for ``target`` accepts at acceptance rate ``p``."""
    if target <= 0:
        return 0
    if p_accept <= 0:
        raise ValueError("acceptance rate is 0: no attempt can be accepted")
    return int(math.ceil(slack * target / p_accept + 10 * math.sqrt(target) + 16))


def accept_stream(block: Callable[[int, int], DataFrame], target: int, p: float, id_col: str, start: int, max_rejects: int | None = None) -> DataFrame:
    """Attempts until ``target`` accepts or the reject cap (2.4.16-17), as blocks that are appended; each attempt is evaluated once.

    ``block(lo, hi)`` gives attempts lo..hi-1 with ``t`` and ``accepted``; ``p`` is their exact acceptance rate, which sizes the
    first block, so a second one is rare. A further block begins where the last one ended: only its own attempts are evaluated, and the
    accepts and rejects so far are carried over as two numbers. A rate of 0 is refused unless the reject cap ends the loop.
    """
    if p <= 0 and max_rejects is None:
        raise ValueError("acceptance rate is 0: no attempt can be accepted")
    sizes = [attempts_needed(target, p)] if p > 0 else []
    if max_rejects is not None and p < 1:  # about so many attempts see the last reject
        sizes.append(int(math.ceil((max_rejects + 5 * math.sqrt(max_rejects)) / (1 - p))) + 1)
    lo, hi, n, rejects, kept = 0, min(sizes), 0, 0, []
    while True:
        tried = block(lo, hi)
        tried = cut_lineage(tried if max_rejects is not None else tried.filter("accepted"), "attempts")
        cut = None if max_rejects is None else reject_cut(tried, "accepted", "t", max_rejects - rejects)
        accepted = tried.filter("accepted") if cut is None else tried.filter(F.col("accepted") & (F.col("t") < F.lit(cut)))
        kept.append(accepted)
        new = accepted.count()
        n += new
        if cut is not None or n >= target:
            return accept_first(reduce(DataFrame.unionAll, kept), "accepted", "t", target, id_col, start=start, bounds=(0, hi - 1))
        if new == 0 and max_rejects is None:  # with a cap, rejects end the loop
            raise RuntimeError(f"attempts {lo} to {hi - 1} brought no further accept beyond {n} of {target}")
        if max_rejects is not None:
            rejects += hi - lo - new
        lo, hi = hi, 2 * hi


def accept_to_target(build: Callable[[int], DataFrame], target: int, p: float, id_col: str, start: int, max_rejects: int | None = None) -> DataFrame:
    """``accept_stream`` for attempts that are given from the first on: ``build(m)`` gives attempts 0..m-1."""
    return accept_stream(lambda lo, hi: build(hi).where(F.col("t") >= F.lit(lo)), target, p, id_col, start, max_rejects)


def acceptance_rate(left: DataFrame, left_date: str, pool: DataFrame, pool_date: str, last_ok: Column) -> float:
    """Exact acceptance rate of "pick a left row uniformly, then a pool row with
    ``pool_date >= left_date`` uniformly; accept if ``pool_date <= last_ok``".

    p = mean over left rows of #pool in [h, last_ok] / #pool >= h (0 if the pool
    is empty). Computed from per-date counts only (no row join); one scalar
    comes back to size the attempt spine.
    """
    pc = pool.groupBy(F.col(pool_date).alias("_d")).agg(F.count(F.lit(1)).alias("_pc"))
    lc = left.groupBy(F.col(left_date).alias("_d")).agg(F.count(F.lit(1)).alias("_lc"))
    cal = (pc.withColumn("_lc", F.lit(0).cast("bigint"))
             .unionByName(lc.withColumn("_pc", F.lit(0).cast("bigint")))
             .groupBy("_d").agg(F.sum("_pc").alias("_pc"), F.sum("_lc").alias("_lc")))
    ge = Window.orderBy(F.col("_d").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ok = F.when(F.col("_d") <= last_ok, F.col("_pc")).otherwise(F.lit(0))
    cal = cal.withColumn("_K", F.sum("_pc").over(ge)).withColumn("_A", F.sum(ok).over(ge))
    row = cal.agg(F.sum(F.when(F.col("_K") > 0, F.col("_lc") * F.col("_A") / F.col("_K")).otherwise(F.lit(0.0))).alias("s"),
                  F.sum("_lc").alias("n")).collect()[0]
    return float(row["s"] or 0.0) / float(row["n"]) if row["n"] else 0.0
