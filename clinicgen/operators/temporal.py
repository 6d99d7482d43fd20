"""Hour grid and interval (stabbing) joins.

"How many stays cover hour h" (``start <= h < end``) is answered by boundary events: two rows per stay, added up by
(site, hour) and summed along the grid. Where the stays themselves are needed (the capacity fill), each is exploded into the
grid hours it covers: at most (stay length in hours + 1) rows, clipped to the grid. Neither is a theta join of stays x hours.
Where the hours of long stays are many times the stays, only the stays are exchanged, a row per block of grid hours
(``hours_by_block``): all rows of a site's hour are then made in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinicgen.operators.ordinals import prefix_sum
from clinicgen.session import parallelism, spread

BLOCK_HOURS = 168  # stays of days to weeks fall in two or three blocks; a site's block is a small part of its hours


def ceil_hour(ts: Column) -> Column:
    """Smallest whole hour >= ts."""
    t = F.date_trunc("hour", ts).cast("timestamp_ntz")
    return F.when(t == ts, t).otherwise(F.timestamp_add("HOUR", F.lit(1), t))


def hour_grid(spark: SparkSession, last_hour: Column | str, hours: int, idx_col: str = "hour_idx", ts_col: str = "hour") -> DataFrame:
    """``hours`` consecutive whole hours ending at ``last_hour`` (2.6.5)."""
    last = F.lit(last_hour).cast("timestamp_ntz") if isinstance(last_hour, str) else last_hour
    n_parts = max(1, hours // 100_000 + 1)
    return spark.range(0, hours, 1, n_parts).select(
        F.col("id").alias(idx_col),
        F.timestamp_add("HOUR", F.col("id") - F.lit(hours - 1), last).alias(ts_col))


def _covered(stays: DataFrame, start: str, end: str, grid_start: Column, grid_end: Column) -> DataFrame:
    """Stays that cover an hour of the grid, with the first (``_lo``) and the last (``_hi``) they cover."""
    lo = F.greatest(ceil_hour(F.col(start)), grid_start)
    hi = F.least(F.timestamp_add("HOUR", F.lit(-1), ceil_hour(F.col(end))), grid_end)
    return stays.withColumn("_lo", lo).withColumn("_hi", hi).filter(F.col("_lo") <= F.col("_hi"))


def explode_hours(stays: DataFrame, start: str, end: str, grid_start: Column, grid_end: Column, out: str = "hour",
                  spread_by: str | None = None) -> DataFrame:
    """One row per (stay, grid hour h) with ``start <= h < end`` and h in the grid.

    Reversed or empty ranges are filtered out *before* ``sequence`` (which
    raises on reversed bounds). ``spread_by`` (a unique stay key), for a caller whose input is
    narrow, spreads the surviving stays over all task slots before they fan out into hours.
    """
    s = _covered(stays, start, end, grid_start, grid_end)
    if spread_by is not None:
        s = spread(s, spread_by)
    return s.withColumn(out, F.explode(F.sequence(F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 HOUR")))).drop("_lo", "_hi")


def hours_by_block(stays: DataFrame, site: str, stay_id: str, start: str, end: str, grid_start: Column, grid_end: Column, out: str = "hour_idx",
                   block: str = "block", rows_per_part: int = 2_000_000) -> Callable[[DataFrame | None], DataFrame]:
    """The rows of ``explode_hours`` as (site, stay, block, index of the hour in the grid), all rows of a (site, block) in one task.

    A stay is exchanged as one row per block of ``BLOCK_HOURS`` grid hours and becomes hours after that, so a grouping by site, block and hour needs no
    exchange of hours. Partitions are counted by the hours they unfold to, about ``rows_per_part`` each. The result, called with None, gives all
    rows; called with (site, block, hour index) rows, those of these hours.
    """
    index = lambda ts: F.timestamp_diff("HOUR", grid_start, F.col(ts))
    covered = _covered(stays, start, end, grid_start, grid_end).select(site, stay_id, index("_lo").alias("_from"), index("_hi").alias("_to"))
    hours = covered.agg(F.sum(F.col("_to") - F.col("_from") + 1)).first()[0] or 0
    parts = max(parallelism(stays.sparkSession), -(-hours // rows_per_part))
    blocks = covered.withColumn(block, F.explode(F.expr(f"sequence(_from div {BLOCK_HOURS}, _to div {BLOCK_HOURS})"))).select(
        site, stay_id, block, F.greatest(F.col("_from"), F.col(block) * BLOCK_HOURS).alias("_from"),
        F.least(F.col("_to"), (F.col(block) + 1) * BLOCK_HOURS - 1).alias("_to")).repartition(parts, site, block)

    def unfold(only: DataFrame | None = None) -> DataFrame:
        if only is None:
            return blocks.select(site, stay_id, block, F.explode(F.sequence("_from", "_to")).alias(out))
        wanted = only.repartition(parts, site, block).groupBy(site, block).agg(F.collect_list(out).alias("_hours"))  # a block's hours at most
        return blocks.join(wanted, [site, block]).select(site, stay_id, block, F.explode(F.filter("_hours", lambda h: h.between(F.col("_from"), F.col("_to")))).alias(out))
    return unfold


def hourly_occupancy(stays: DataFrame, site: str, start: str, end: str, grid_start: Column, grid_end: Column,
                     out: str = "active", hour_col: str = "hour") -> DataFrame:
    """Stays active per (site, hour) over the grid; hours with none are absent (2.5.6).

    A stay is two boundary events, +1 at its first grid hour and -1 after its last, however long it is. Events are added up by
    (site, hour) before they are shuffled; their running sum per site, which has a row per grid hour at most, holds until the next event.
    """
    hours = lambda ts: F.timestamp_diff("HOUR", grid_start, ts)
    lo, hi = F.greatest(hours(ceil_hour(F.col(start))), F.lit(0)), F.least(hours(ceil_hour(F.col(end))), hours(grid_end) + 1)
    inside = stays.select(F.col(site), lo.alias("_lo"), hi.alias("_hi")).where("_lo < _hi")
    events = inside.select(site, F.explode(F.array(F.struct(F.col("_lo").alias("_h"), F.lit(1).cast("bigint").alias("_d")),
                                                   F.struct(F.col("_hi").alias("_h"), F.lit(-1).cast("bigint").alias("_d")))).alias("_e")).select(site, "_e.*")
    changes = events.groupBy(site, "_h").agg(F.sum("_d").alias("_d"))
    running = prefix_sum(changes, F.col("_d"), ["_h"], (), [site], out=out)
    steps = running.withColumn("_next", F.lead("_h").over(Window.partitionBy(site).orderBy("_h"))).where(F.col(out) > 0)  # the last one of a site leaves 0
    return steps.select(F.col(site), F.explode(F.sequence(F.col("_h"), F.col("_next") - 1)).alias("_h"), F.col(out)).select(
        site, F.timestamp_add("HOUR", F.col("_h"), grid_start).alias(hour_col), out)


def dense_grid(spark: SparkSession, hours: int, n_sites: int, units: Sequence[str], last_hour: Column,
               hour_col: str = "hour", site_col: str = "id_sede", unit_col: str = "tip_unidad",
               pos_col: str = "unit_pos", id_col: str = "cell_id", hour_idx_col: str | None = None) -> DataFrame:
    """Every (hour, site 1..n, unit) cell, decoded from one ``spark.range`` (2.5.8).

    Row-major ids (hour, then site, then unit) give the loop's record numbers
    directly, with no join and no window.
    """
    n_units = len(units)
    total = hours * n_sites * n_units
    i = F.col("id")
    unit_name = F.element_at(F.array(*[F.lit(x) for x in units]), (i % n_units + 1).cast("int"))
    hour_no = F.floor(i / (n_sites * n_units)).cast("bigint")
    extra = [hour_no.alias(hour_idx_col)] if hour_idx_col else []
    return spark.range(0, total, 1, max(1, total // 1_000_000 + 1)).select(
        (i + 1).alias(id_col),
        F.timestamp_add("HOUR", hour_no - F.lit(hours - 1), last_hour).alias(hour_col),
        ((F.floor(i / n_units) % n_sites) + 1).cast("bigint").alias(site_col),
        (i % n_units).cast("int").alias(pos_col),
        unit_name.alias(unit_col), *extra)
