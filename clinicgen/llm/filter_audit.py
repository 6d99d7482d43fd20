"""Filter interaction audit: what each filter removes at each place of every order, from Lehmer-rank difference arrays.

A document fails a set of the k filters, its mask. In an order, it is removed at the first step whose filter
is in the mask. All orders that begin with the same letters are neighbours in lexicographic order: a prefix of ``s`` letters
starts at its Lehmer rank and covers ``(k - s)!`` ranks. So the orders in which step ``s`` removes a mask are intervals of
ranks, one per prefix that ends with its first failing letter. Documents are counted by part and mask; every
interval adds the count at its first rank and takes it off after its last; the prefix sum over the k! ranks gives
what is removed at that step of each order. No document is looked at per order.

On Spark: texts are scanned once, for four filters and a digest; copies are found by the least id of a digest (joined by
digest and id, so that no group of copies meets in one task); the counts have at most 2**k rows a part, whatever the part holds.

Cases: null texts are empty; a null source is the part ''; null ids are copies of nothing and have no labels; rows that
share the least id of their text are no copies; an id with several label rows is good (toxic) if one of
them says so; parts without documents have no rows, so an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clinicgen.llm.common import TOKEN, cut, read

LETTERS = "ABCDE"


def orders(k: int) -> list[tuple[int, ...]]:
    """All orders of k filters in lexicographic order; the index is the Lehmer rank."""
    return list(permutations(range(k)))


def lehmer_start(prefix: tuple[int, ...], k: int) -> int:
    """Rank of the first order that begins with ``prefix``."""
    return sum(sum(x < p and x not in prefix[:i] for x in range(k)) * factorial(k - 1 - i) for i, p in enumerate(prefix))


def intervals(k: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of the orders whose ``step`` removes ``mask``; neighbours are joined."""
    out: list[tuple[int, int, int, int]] = []
    for mask in range(1, 1 << k):
        inside = [i for i in range(k) if mask >> i & 1]
        outside = [i for i in range(k) if not mask >> i & 1]
        for step in range(1, len(outside) + 2):
            starts = sorted(lehmer_start((*p, x), k) for p in permutations(outside, step - 1) for x in inside)
            width, spans = factorial(k - step), []
            for s in starts:
                if spans and spans[-1][1] == s:
                    spans[-1][1] = s + width
                else:
                    spans.append([s, s + width])
            out += [(mask, step, lo, hi) for lo, hi in spans]
    return out


def text_failures(text: str = "text") -> list[Column]:
    """The filters that look at one text, in the order of their letters."""
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(f"({TOKEN})"), F.lit(1))
    n = F.size(words)
    capitals = F.length(t) - F.length(F.translate(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return [n < 50, F.size(F.array_distinct(words)) * 100 < n * 65, capitals * 100 > F.length(t) * 5, t.rlike("[#$%&*|]")]


def marked(docs: DataFrame, labels: DataFrame, text: str = "text", part: str = "source") -> DataFrame:
    """(part, mask, good, toxic) of every document; the last filter is: a smaller id has the same text."""
    own = text_failures(text)
    scanned = cut(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(own)), F.lit(0)).alias("own"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest")), "audit-texts")
    first = scanned.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return scanned.join(first, ["digest", "doc_id"], "left").join(said, "doc_id", "left").select(
        "part", (F.col("own") + F.when(copy, 1 << len(own)).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def _interval_table(spark: SparkSession, k: int) -> DataFrame:
    rows = ", ".join(map(str, intervals(k)))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(mask, step, lo, hi)")


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley), a row for every part, order and step.

    ``masks``: (part, mask, good, toxic) per document, bit i of the mask for the filter ``letters[i]``; at most six filters.
    """
    k, spark = len(letters), masks.sparkSession
    if not 1 <= k <= 6 or len(set(letters)) != k or list(letters) != sorted(letters):
        raise ValueError("letters: one to six different ones in ascending order")
    names = ["".join(letters[i] for i in o) for o in orders(k)]
    counts = cut(masks.groupBy("part", "mask").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("g"), F.count_if("toxic").alias("x")), "audit-counts")
    parts = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(F.col("mask").bitwiseAND(1 << i) != 0, F.col("n")).otherwise(0)).alias(f"fails{i}") for i in range(k)],
        *[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)).alias(f"alone{i}") for i in range(k)])
    covered = counts.join(F.broadcast(_interval_table(spark, k)), "mask")  # a fixed table of the rule
    ends = covered.select("part", "step", F.explode(F.array(
        F.struct(F.col("lo").alias("rank"), "n", "g", "x"),
        F.struct(F.col("hi").alias("rank"), (-F.col("n")).alias("n"), (-F.col("g")).alias("g"), (-F.col("x")).alias("x")))).alias("e")).select("part", "step", "e.*")
    zero = F.lit(0).cast("bigint")
    grid = parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("step")).select(
        "part", "step", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("rank"), zero.alias("n"), zero.alias("g"), zero.alias("x"))
    difference = ends.where(F.col("rank") < len(names)).union(grid).groupBy("part", "step", "rank").agg(*[F.sum(c).alias(c) for c in "ngx"])
    by_rank = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    removed = difference.select("part", "step", "rank", *[F.sum(c).over(by_rank).alias(o) for c, o in zip("ngx", ("removed", "good_lost", "toxic_lost"), strict=True)])
    named = removed.withColumn("filter_order", F.element_at(F.array(*map(F.lit, names)), F.col("rank") + 1)).withColumn("letter", F.expr("substring(filter_order, step, 1)"))
    by_step = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    summed = named.withColumn("gone", F.sum("removed").over(by_step)).withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter")))
    pick = lambda stem: F.coalesce(*[F.when(F.col("letter") == x, F.col(f"{stem}{i}")) for i, x in enumerate(letters)])
    return summed.join(parts, "part").select(
        "part", "filter_order", "step", (F.col("total") - F.col("gone")).alias("kept"), "removed", (pick("fails") - F.col("removed")).alias("redundant"),
        pick("alone").alias("unique_fails"), "good_lost", "toxic_lost", "shapley")


def op13_filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(marked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
              100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text),
              regexp_matches(text, '[#$%&*|]'), coalesce(doc_id > least, false)] AS fail
      FROM w LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fail, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY part, fail),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || d.c || e.c || h.c AS filter_order FROM s a, s b, s d, s e, s h
      WHERE len(list_distinct([a.c, b.c, d.c, e.c, h.c])) = 5),
-- each mask in each order: the step that removes it (null: none does)
r AS (SELECT m.*, filter_order, list_position([fail[ascii(substr(filter_order, i, 1)) - 64] FOR i IN range(1, 6)], true) AS hit FROM m, o),
p AS (SELECT r.*, step, substr(filter_order, step, 1) AS letter FROM r, (SELECT unnest(range(1, 6)) AS step)),
a AS (SELECT part, filter_order, step, letter,
             (sum(n) FILTER (hit IS NULL OR hit > step)) AS kept, sum(n) FILTER (hit = step) AS removed,
             sum(n) FILTER (hit < step AND fail[ascii(letter) - 64]) AS redundant,
             sum(n) FILTER (fail[ascii(letter) - 64] AND len(list_filter(fail, lambda v: v)) = 1) AS unique_fails,
             sum(g) FILTER (hit = step) AS good_lost, sum(x) FILTER (hit = step) AS toxic_lost
      FROM p GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM a
"""
