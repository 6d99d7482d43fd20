"""Mix of sources to target weights by per-document repetition.

Sizes are summed per source; the sources, in code point order (null last), weigh
``weights`` in turn and share the whole size by weight. A target stops at ``max_rate``
times its source's size; what is over is shared again by weight among the others until none
is above. With ``rate = target / source size`` a document is emitted ``floor(rate)`` times,
plus once more when its hash-seeded uniform falls below the fraction.

Cases: null text or no words has size 0; a source of size 0 has rate 0; null sources
form one source; rows equal in the key columns draw alike (rerun-stable); an empty
table gives an empty mix; a column named like an output is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinicgen.llm.common import TOKEN, cut, unit, without


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(TOKEN)), F.lit(0)).cast("bigint")


def _ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 in code point order, null last, without one global window:
    range partitions number their own rows and the few partition sizes give the offsets."""
    sorted_ = cut(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    sizes = sorted(sorted_.groupBy(F.shiftright("at", 33).alias("p")).count().collect())  # a row per partition
    start, offsets = 0, []
    for p, n in sizes:
        offsets.append((p, start))
        start += n
    table = sorted_.sparkSession.createDataFrame(offsets, "p bigint, start bigint")
    return (sorted_.join(F.broadcast(table), F.shiftright("at", 33) == F.col("p"))
            .select("source", "source_size", (F.col("start") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("rank")))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_rate: float = 3.0) -> DataFrame:
    """(source, source_size, weight, target) of rows (source, size)."""
    sources = _ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    state = cut(sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_rate).alias("cap")), "mix-weights")
    total = float(state.agg(F.sum("source_size")).first()[0] or 0)
    # a source is full when its share of what the others leave exceeds its cap; cap / weight orders
    # them, so the full ones are those under a level that only rises from round to round
    level, over = -1.0, F.col("cap") / F.col("weight")
    while True:
        full, open_ = state.agg(F.sum(F.when(over < level, F.col("cap"))), F.sum(F.when(over >= level, F.col("weight")))).first()
        new = (total - (full or 0.0)) / open_ if open_ else level
        if new <= level or not open_:
            break
        level = new
    return state.select("source", "source_size", "weight", F.least("cap", F.col("weight") * F.lit(max(level, 0.0))).alias("target"))


def repetitions(docs: DataFrame, key: list[str], weights: tuple[int, ...] = (1, 2, 3), max_rate: float = 3.0, seed: int = 11) -> DataFrame:
    """``docs`` (with ``source`` and ``size``) plus ``source_size``, ``target``, ``copies``."""
    targets = source_targets(docs.select("source", "size"), weights, max_rate)
    keep = without(docs, "source_size", "target", "copies")
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    right = targets.select(F.col("source").alias("s"), "source_size", "target",
                           F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))
    once = unit(str(seed), *[F.col(f"row.`{k}`") for k in key]) < F.col("rate") - F.floor("rate")
    return (left.join(right, F.col("row.source").eqNullSafe(F.col("s")))
            .select(*[F.col(f"row.`{c}`") for c in keep], "source_size", "target", (F.floor("rate") + once.cast("bigint")).alias("copies")))


def mix_documents(docs: DataFrame, key: tuple[str, ...] = ("doc_id",), text: str = "text", **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    cols = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("doc"))
    sized = row.select("doc", F.col("doc.source").alias("source"), word_count(f"doc.{text}").alias("size"),
                       *[F.col(f"doc.`{k}`").alias(f"key{i}") for i, k in enumerate(key)])
    taken = repetitions(sized, [f"key{i}" for i in range(len(key))], **how)
    return (taken.where("copies > 0").select("doc", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
            .select(*[F.col(f"doc.`{c}`") for c in cols]))


def op4_mix_sources(spark, sf_dir: str) -> DataFrame:
    from clinicgen.llm.common import cut, read

    docs = cut(read(spark, sf_dir, "documents").select("doc_id", "source", word_count().alias("size")), "mix-sizes")  # texts are looked at once
    return repetitions(docs, ["doc_id"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s),
o AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / weight AS ratio FROM w),
-- the level is that of the first prefix of full sources (by ratio) after which nobody else is above
p AS (SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(weight) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM o),
l AS (SELECT rest / open_weight AS level FROM p WHERE rest / open_weight <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, least(cap, weight * greatest((SELECT level FROM l), 0)) AS target FROM o),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t),
u AS (SELECT d.*, r.source_size, r.target, r.rate,
             ('0x' || substr(md5(concat('11|', coalesce(doc_id::VARCHAR, chr(0)))), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM u
"""
