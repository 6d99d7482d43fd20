"""Allocation under budgets and capacities.

``budget_alloc`` turns the row-by-row recurrence "give each cell its draw,
at least 1, keeping 1 for every cell left; the last cell takes the rest" into
a closed form over a running sum of ``max(draw - 1, 0)`` (block-wise, see
``ordinals.prefix_sum``).

``capacity_fill`` reproduces "stays at one (hour, site), in turn, take a
uniformly random unit among those with room; once all are full the rest are
dropped". While any unit has room every stay takes a bed, so only the first
``sum(capacities)`` stays of a group in their order can matter: a group's work
is bounded by its beds, however many stays it has. One plan at every size, with one
look at the stays: a rank filter that Spark applies within each task before the exchange, then each group's
first stays meet as one short array and an ``aggregate`` walks it in order.

Stays that come a block of groups at a time (``within``) are tallied by the unit they would pick with every unit open, and only groups where
a unit fills before all do are walked: a group with as many stays as beds takes them all, and one where no unit fills has its tally, whatever the order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicgen import config as C
from clinicgen.functions import draws as D
from clinicgen.operators.ordinals import DEFAULT_BLOCK_ROWS, prefix_sum
from clinicgen.session import allow_group_limit, cut_lineage


# --------------------------------------------------------------------- budget
def budget_alloc(
    cells: DataFrame,
    order_col: str,
    draw: Column,
    limit: Column | int,
    partition: Sequence[str] = (),
    out: str = "alloc",
    block_width: int = DEFAULT_BLOCK_ROWS,
) -> DataFrame:
    """Split ``limit`` over cells in ``order_col`` order with a floor of 1 (2.7.1).

    With E = limit - cells and C_i = running sum of max(draw - 1, 0):
    cell i gets 1 + min(C_i, E) - min(C_{i-1}, E); the last cell gets
    1 + E - min(C_{n-2}, E). A budget below the number of cells is refused.
    ``limit`` may be a column (one budget per ``partition``).
    """
    part = list(partition)
    lim = limit if isinstance(limit, Column) else F.lit(int(limit))
    c = cells.withColumn("_lim", lim.cast("bigint")).withColumn("_extra", F.greatest(draw.cast("bigint") - 1, F.lit(0)))
    per = c.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"), F.max(order_col).alias("_last"), F.max("_lim").alias("_limit"))
    if part:
        c = c.drop("_lim").join(per, on=part, how="inner")
    else:  # one budget: its three scalars come back as one row (no constant-key join)
        row = per.first()
        if row is None:
            return cells.withColumn(out, F.lit(None).cast("bigint"))
        c = c.drop("_lim").withColumn("_n", F.lit(int(row["_n"]))).withColumn("_last", F.lit(row["_last"])).withColumn(
            "_limit", F.lit(int(row["_limit"])).cast("bigint"))
    c = c.withColumn("_blk", F.floor(F.col(order_col) / F.lit(block_width)).cast("bigint"))
    c = prefix_sum(c, F.col("_extra"), [order_col], ["_blk"], part, out="_C")
    e = F.col("_limit") - F.col("_n")
    cprev = F.col("_C") - F.col("_extra")
    alloc = F.when(F.col(order_col) == F.col("_last"), F.lit(1) + e - F.least(cprev, e)).otherwise(
        F.lit(1) + F.least(F.col("_C"), e) - F.least(cprev, e))
    checked = F.when(e < 0, F.raise_error(F.lit("budget_alloc: budget below the number of cells")).cast("bigint")).otherwise(alloc)
    return c.withColumn(out, checked.cast("bigint")).drop("_extra", "_n", "_last", "_limit", "_blk", "_C")


def bed_draw(seed: int, label: str, key: str, mean: str | int) -> Column:
    """|int(N(mean, 500))| per cell (2.4.7); ``key`` / ``mean`` are SQL snippets."""
    return D.col(D.folded_normal_int(D.u(seed, label, key, slot=0), D.u(seed, label, key, slot=1), mean, C.BED_SD))


# ------------------------------------------------------------ capacity fill
def _seat(rem: Column, v: Column) -> Column:
    """Beds left after one stay with pick draw ``v`` (unchanged when all units are full)."""
    free = F.filter(F.transform(rem, lambda r, i: F.when(r > 0, i)), lambda i: i.isNotNull())
    pick = F.transform(F.array(free), lambda a: F.when(F.size(a) > 0, F.element_at(a, (F.floor(v * F.size(a)) + 1).cast("int"))))
    return F.element_at(F.transform(pick, lambda p: F.transform(rem, lambda r, i: F.when(i == p, r - 1).otherwise(r))), 1)


def capacity_fill(
    stays: DataFrame,
    group: Sequence[str],
    stay_id: str,
    capacities: DataFrame,
    on: Sequence[str],
    caps: Sequence[str],
    seed: int,
    label: str,
    unit_col: str = "unit_pos",
    out: str = "occupied",
    within: Sequence[str] = (),
    again: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Occupied beds per (group, unit) after the sequential fill (2.7.2).

    ``stays``: one row per (group, stay). ``capacities``: one row per ``on`` (columns of the
    group) with a capacity per unit in ``caps``; stays of groups without a row find no bed. Stays are
    taken in order of a seeded uniform (ties by ``stay_id``); each picks uniformly among
    units with room. Order and pick are slots 0 and 1 of one digest of ``(label, stay, group)``.
    Rows come back only for (group, unit) with at least one bed taken.

    Every task cuts its part of a group down to the largest number of beds before the exchange (a group limit on the order),
    so a group with a third of all stays sends that many per task.

    ``again``, for stays far more numerous than what they are made of: gives the stays of some groups (rows of ``within`` and the group) once more. ``within``
    are columns of the stays that follow from the group and by which, with ``on``, they are partitioned, so that no stay is exchanged; ``capacities`` are then
    few enough for every task.
    """
    g = list(group)
    rem = F.array(*[F.greatest(F.col(c).cast("bigint"), F.lit(0)) for c in caps])
    beds = capacities.select(*on, rem.alias("_rem")).withColumn("_beds", F.aggregate("_rem", F.lit(0).cast("bigint"), lambda a, r: a + r)).where("_beds > 0")
    beds = cut_lineage(beds, "beds")  # read for its largest number, then joined
    most = beds.agg(F.max("_beds")).first()[0] or 0
    allow_group_limit(stays.sparkSession, most)

    def walk(some: DataFrame) -> DataFrame:
        drawn = some.selectExpr(*within, *g, stay_id, f"{D.u(seed, label, stay_id, *g, slot=0)} AS _o", f"{D.u(seed, label, stay_id, *g, slot=1)} AS _v")
        turn = F.row_number().over(Window.partitionBy(*within, *g).orderBy("_o", stay_id))
        turns = drawn.withColumn("_turn", turn).where(F.col("_turn") <= F.lit(most)).groupBy(*within, *g).agg(
            F.array_sort(F.collect_list(F.struct("_turn", "_v"))).alias("_turns"))
        # stays past the last bed change nothing
        filled = turns.join(F.broadcast(beds) if within else beds, list(on)).withColumn(
            "_left", F.aggregate(F.slice("_turns", F.lit(1), F.col("_beds").cast("int")), F.col("_rem"), lambda r, t: _seat(r, t["_v"])))
        return filled.select(*g, F.zip_with("_rem", "_left", lambda a, b: a - b).alias("_taken"))

    if again is None:
        taken = walk(stays)
    else:
        tally = cut_lineage(_tally(stays, [*within, *g], F.broadcast(beds), on, len(caps), D.u(seed, label, stay_id, *g, slot=1)), "tally")
        taken, undecided = tally.where("_taken IS NOT NULL").select(*g, "_taken"), tally.where("_taken IS NULL").select(*within, *g)
        if not undecided.isEmpty():
            taken = taken.unionByName(walk(again(undecided)))
    return taken.select(*g, F.posexplode("_taken").alias(unit_col, out)).where(F.col(out) > 0)


def _tally(stays: DataFrame, keys: Sequence[str], beds: DataFrame, on: Sequence[str], units: int, v: str) -> DataFrame:
    """Beds taken per group (``_taken``, by unit) where that does not depend on the order; NULL where it does.

    Stays are counted by their pick among the units with beds. With as many stays as beds all are taken; with fewer picks than beds in
    each of these units none ever fills, so every stay has picked among the same ones.
    """
    free = F.size(F.filter("_rem", lambda r: r > 0))
    pick = F.floor(D.col(v) * F.col("_free")).cast("int")
    drawn = stays.join(beds.select(*on, free.alias("_free")), list(on)).select(*keys, pick.alias("_pick"))
    counts = drawn.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.array(*[F.count(F.when(F.col("_pick") == i, 1)) for i in range(units)]).alias("_c"))
    nth = F.transform("_rem", lambda r, i: F.when(r > 0, F.size(F.filter(F.slice("_rem", F.lit(1), i + 1), lambda x: x > 0)) - 1))  # a unit's number among those with beds
    counts = counts.join(beds, list(on)).withColumn("_nth", nth).withColumn("_picked", F.transform("_nth", lambda k: F.coalesce(F.get("_c", k), F.lit(0))))
    open_ = F.forall(F.zip_with("_picked", "_rem", lambda p, r: (r == 0) | (p < r)), lambda x: x)
    return counts.select(*keys, F.when(F.col("_n") >= F.col("_beds"), F.col("_rem")).when(open_, F.col("_picked")).alias("_taken"))


# ---------------------------------------------------------- availability
def bed_availability(cells: DataFrame, cap: Column, occupied: Column, u_maint: str) -> DataFrame:
    """Available, maintenance and reason columns for bed cells (2.7.3).

    Available = capacity - occupied (maintenance is drawn afterwards and not
    subtracted); maintenance uniform in [0, int(0.10 * available)].
    """
    disp = (cap - occupied).cast("bigint")
    cells = cells.withColumn("num_camas_disp", disp)
    maint = D.draw_int(u_maint, 0, f"CAST(floor(num_camas_disp * {D.s(C.PCT_MAINTENANCE)}) AS BIGINT)")
    cells = cells.withColumn("num_camas_mant", D.col(maint))
    return cells.withColumn("motivo_indisponibilidad",
                            F.when(F.col("num_camas_mant") > 0, F.lit(C.MAINTENANCE_REASON)).otherwise(F.lit("")))
