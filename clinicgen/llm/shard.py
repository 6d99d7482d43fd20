"""Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

The rows lie in blocks (hash partitions). How many rows of block ``b`` go to shard
``s`` in a uniform random permutation follows the multivariate hypergeometric law with
the block sizes and the shard sizes as margins. The matrix is drawn exactly, down a
binary tree over the blocks: a node's quota vector (rows it owes to each shard) is split
between its two children by hypergeometric draws, one conditional draw per shard. Every
row then takes a random rank inside its block (local permutation), the rank picks the shard
from the block's quotas (exchange), and a second independent random order inside each
shard gives the slot (second permutation), numbered over sub-ranges of the order so
that no task holds a whole shard.

Everything is DataFrame and SQL functions; the draws invert the exact probability
function with ``aggregate`` walks from its mode, as far as a double can tell.

Cases: null columns are carried as they are; repeated rows are rows of their own; an empty
table gives an empty result; columns named like an output are replaced by it. A rerun over the
same files with the same split settings gives the same placement.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicgen.llm.common import cut, without


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _unit(seed: int, *keys: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 11).cast("double") * F.lit(2.0 ** -53)


def hypergeometric(draws: Column, good: Column, total: Column, u: Column) -> Column:
    """How many of ``draws`` items taken without replacement from ``total`` are among the ``good``.

    Inversion of the exact law by the uniform ``u``, in the order mode, upwards, downwards.
    Values over ten standard deviations (and 20) from the mode have less mass than the
    resolution of ``u``.
    """
    args = F.struct(draws.cast("double").alias("n"), good.cast("double").alias("k"), total.cast("double").alias("t"), u.alias("u"))

    def bounds(a: Column) -> Column:
        share = a["k"] / F.greatest(a["t"], F.lit(1.0))
        var = a["n"] * share * (1 - share) * (a["t"] - a["n"]) / F.greatest(a["t"] - 1, F.lit(1.0))
        lo = F.greatest(F.lit(0.0), a["n"] + a["k"] - a["t"])
        hi = F.least(a["n"], a["k"])
        mode = F.greatest(lo, F.least(hi, F.floor((a["n"] + 1) * (a["k"] + 1) / (a["t"] + 2)).cast("double")))
        width = F.ceil(10 * F.sqrt(F.greatest(var, F.lit(0.0)))).cast("double") + 20
        return F.struct(a["n"].alias("n"), a["k"].alias("k"), a["t"].alias("t"), a["u"].alias("u"), mode.alias("m"),
                        F.greatest(lo, mode - width).cast("bigint").alias("lo"), F.least(hi, mode + width).cast("bigint").alias("hi"))

    def steps(b: Column) -> tuple[Column, Column]:
        m, none = b["m"].cast("bigint"), F.array().cast("array<bigint>")
        up = F.when(b["hi"] > m, F.sequence(m + 1, b["hi"])).otherwise(none)
        down = F.when(b["lo"] < m, F.sequence(m - 1, b["lo"], F.lit(-1).cast("bigint"))).otherwise(none)
        return up, down

    def rise(b: Column, j: Column) -> Column:  # p(j) / p(j - 1)
        return (b["k"] - j + 1) * (b["n"] - j + 1) / (j * (b["t"] - b["k"] - b["n"] + j))

    def fall(b: Column, j: Column) -> Column:  # p(j) / p(j + 1)
        return (j + 1) * (b["t"] - b["k"] - b["n"] + j + 1) / ((b["k"] - j) * (b["n"] - j))

    def mass(b: Column, js: Column, ratio: Callable) -> Column:
        zero = F.struct(F.lit(1.0).alias("r"), F.lit(0.0).alias("sum"))

        def add(s: Column, j: Column) -> Column:
            return _let(s["r"] * ratio(b, j.cast("double")), lambda r: F.struct(r.alias("r"), (s["sum"] + r).alias("sum")))
        return F.aggregate(js, zero, add)["sum"]

    def walk(b: Column, js: Column, ratio: Callable, left: Column) -> Column:
        """(mass still left, the value picked or null)"""
        zero = F.struct(F.lit(1.0).alias("r"), left.alias("left"), F.lit(None).cast("bigint").alias("pick"))

        def step(s: Column, j: Column) -> Column:
            return _let(s["r"] * ratio(b, j.cast("double")), lambda r: F.struct(
                r.alias("r"), (s["left"] - r).alias("left"),
                F.coalesce(s["pick"], F.when(s["left"] < r, j)).alias("pick")))
        return F.aggregate(js, zero, step)

    def pick(b: Column) -> Column:
        up, down = steps(b)
        target = b["u"] * (1 + mass(b, up, rise) + mass(b, down, fall)) - 1
        return _let(target, lambda left: F.when(left < 0, b["m"].cast("bigint")).otherwise(
            _let(walk(b, up, rise, left), lambda w: F.coalesce(w["pick"], walk(b, down, fall, w["left"])["pick"], b["m"].cast("bigint")))))

    return _let(_let(args, bounds), pick)


def _split(quota: Column, draws: Column, seed: int, node: Column, level: int) -> Column:
    """Quota vector of the left child: ``draws`` rows taken from the node's quotas, shard by shard."""
    zero = F.struct(draws.alias("n"), F.aggregate(quota, F.lit(0).cast("bigint"), lambda a, q: a + q).alias("t"),
                    F.lit(0).alias("s"), F.array().cast("array<bigint>").alias("out"))

    def one(acc: Column, q: Column) -> Column:
        drawn = hypergeometric(acc["n"], q, acc["t"], _unit(seed, F.lit(level), node, acc["s"]))
        return _let(drawn, lambda x: F.struct((acc["n"] - x).alias("n"), (acc["t"] - q).alias("t"), (acc["s"] + 1).alias("s"),
                                              F.concat(acc["out"], F.array(x)).alias("out")))
    return F.aggregate(quota, zero, one)["out"]


def communication_matrix(counts: DataFrame, depth: int, sizes: list[int], seed: int) -> DataFrame:
    """(block, quota): rows that each of ``2**depth`` blocks sends to each shard.

    ``counts`` has (block, n); blocks without rows may be missing. Margins are exact.
    """
    spark = counts.sparkSession
    nodes = spark.range(1).select(F.col("id").alias("block"), F.array(*[F.lit(int(s)).cast("bigint") for s in sizes]).alias("quota"))
    for level in range(1, depth + 1):
        child = F.shiftright("block", depth - level)
        left = (counts.where(child % 2 == 0).groupBy(F.shiftright(child, 1).alias("block")).agg(F.sum("n").alias("left")))
        drawn = nodes.join(left, "block", "left").withColumn(
            "l", _split(F.col("quota"), F.coalesce("left", F.lit(0)).cast("bigint"), seed, F.col("block"), level))
        nodes = drawn.select(F.inline(F.array(
            F.struct((F.col("block") * 2).alias("block"), F.col("l").alias("quota")),
            F.struct((F.col("block") * 2 + 1).alias("block"), F.zip_with("quota", "l", lambda q, x: q - x).alias("quota")))))
        if level % 4 == 0 and level < depth:
            nodes = cut(nodes, "shard-quota")
    return nodes


def hypergeometric_shards(df: DataFrame, shards: int = 16, seed: int = 7, rows_per_block: int = 4096) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard); sizes differ by one at most.

    ``rows_per_block`` sets how many rows a task permutes; the number of blocks follows the row count.
    """
    if shards < 1 or rows_per_block < 1:
        raise ValueError("shards and rows_per_block must be positive")
    keep = without(df, "shard", "slot")
    rows = cut(df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.monotonically_increasing_id().alias("rid")), "shard-rows")
    total = rows.count()
    depth = max(0, math.ceil(math.log2(max(1, total / rows_per_block))))
    sizes = [total // shards + (s < total % shards) for s in range(shards)]

    placed = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), F.col("rid")), F.lit(1 << depth)).cast("bigint"))
    counts = cut(placed.groupBy("block").agg(F.count(F.lit(1)).alias("n")), "shard-counts")
    matrix = communication_matrix(counts, depth, sizes, seed)
    ends = F.aggregate("quota", F.array(F.lit(0).cast("bigint")), lambda a, q: F.concat(a, F.array(F.element_at(a, -1) + q)))
    local = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed + 1), F.col("rid")), "rid")
    ranked = placed.withColumn("r", F.row_number().over(local))
    sent = (ranked.join(matrix.select("block", ends.alias("ends")), "block", "left")
            .withColumn("shard", (F.size(F.filter("ends", lambda e: e < F.col("r"))) - 1).cast("int")))

    # second permutation: the order is cut into equal ranges of its random key
    ranges = max(1, math.ceil(total / shards / rows_per_block))
    key = F.shiftrightunsigned(F.xxhash64(F.lit(seed + 2), F.col("rid")), 32)
    sent = cut(sent.select("row", "rid", "shard", F.shiftrightunsigned(key * ranges, 32).cast("bigint").alias("part")), "shard-sent")
    parts = sent.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "part").orderBy(F.xxhash64(F.lit(seed + 2), F.col("rid")), "rid")
    return (sent.withColumn("i", F.row_number().over(within)).join(starts, ["shard", "part"])
            .select(*[F.col(f"row.`{c}`") for c in keep], "shard", (F.col("start") + F.col("i") - 1).cast("bigint").alias("slot")))


def op2_hypergeometric_shards(spark, sf_dir: str) -> DataFrame:
    from clinicgen.llm.common import read

    return shard_documents(read(spark, sf_dir, "documents"))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Placement of every document by the law ``rows``; texts stay where they are, only their size and CRC travel."""
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    narrow = docs.select("doc_id", (F.octet_length(raw) + 1).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"))
    return hypergeometric_shards(narrow, shards).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
