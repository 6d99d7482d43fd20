"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all preceding turns are context, that
reply alone is trainable. A conversation is rendered once (its transcript); the example of a reply
is the transcript's prefix that ends with it, so what is stored grows with the turns, not with
their square, and ``examples`` explodes the prefixes where they are used.

Template: ``<turn ROLE>TEXT</turn>``. Inside roles and texts a backslash becomes ``\\s``, ``<``
becomes ``\\l`` and ``>`` becomes ``\\g``, so no text can form a control string and the original
comes back exactly. The loss span of an example covers the reply's escaped text alone.

DataFrame and SQL functions only.

Cases: null texts and roles are empty; turns sort by (turn, role, text), nulls first; repeated
rows are turns of their own; rows with a null conversation id form one conversation; a
conversation without a reply has a transcript and no example; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinicgen.llm.common import read, scratch_path

TRAINED_ROLE = "assistant"
HEAD, CLOSE = "<turn ", "</turn>"


def escape(text: Column) -> Column:
    for plain, safe in (("\\", "\\s"), ("<", "\\l"), (">", "\\g")):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in ((">", "\\g"), ("<", "\\l"), ("\\", "\\s")):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def transcripts(turns: DataFrame) -> DataFrame:
    """(conv_id, transcript, targets) per conversation.

    ``targets``: per reply (target_turn, prefix_chars, loss_start, loss_chars) in code points, ``loss_start`` from 0.
    """
    src = turns.select("conv_id", F.col("turn").alias("no"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("conv_id").orderBy("no", "role", "text")
    parts = src.select("conv_id", (F.row_number().over(order) - 1).alias("i"), (F.col("role") == TRAINED_ROLE).alias("reply"), "no", "role", "text",
                       F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(">")).alias("head"), escape(F.col("text")).alias("body"))
    chars = F.length("head") + F.length("body") + len(CLOSE)
    at = F.coalesce(F.sum(chars).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    one = F.struct("i", "reply", F.concat("head", "body", F.lit(CLOSE)).alias("part"), (F.col("at") + F.length("head")).alias("start"), F.length("body").cast("bigint").alias("chars"))
    grouped = parts.withColumn("at", at).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("parts"))
    return grouped.select(
        "conv_id", F.array_join(F.col("parts.part"), "").alias("transcript"),
        F.transform(F.filter("parts", lambda p: p["reply"]), lambda p: F.struct(
            p["i"].alias("target_turn"), (p["start"] + p["chars"] + len(CLOSE)).alias("prefix_chars"),
            p["start"].alias("loss_start"), p["chars"].alias("loss_chars"))).alias("targets"))


def examples(stored: DataFrame, keep: tuple[str, ...] = (), every: bool = False) -> DataFrame:
    """(conv_id, target_turn, text, loss_start, loss_chars): a training example per assistant turn.

    ``keep``: further columns of ``stored`` to carry; ``every`` gives conversations without a reply a row of nulls.
    """
    explode = F.explode_outer if every else F.explode
    return stored.select("conv_id", *keep, "transcript", explode("targets").alias("t")).select(
        "conv_id", *keep, "t.target_turn", F.substring("transcript", F.lit(1), F.col("t.prefix_chars").cast("int")).alias("text"), "t.loss_start", "t.loss_chars")


def read_turns(rendered: Column) -> Column:
    """Array of (role, text) parsed back from a transcript or an example."""
    whole = F.filter(F.split(rendered, CLOSE), lambda p: p != "")
    role = lambda p: F.substring_index(p, ">", 1)
    return F.transform(whole, lambda p: F.struct(
        unescape(F.substr(role(p), F.lit(len(HEAD) + 1))).alias("role"), unescape(F.substr(p, F.length(role(p)) + 2)).alias("text")))


def format_conversations(turns: DataFrame, path: str) -> DataFrame:
    """Writes the transcripts and their targets to ``path`` as Parquet and reads them back."""
    transcripts(turns).write.parquet(path)
    return turns.sparkSession.read.parquet(path)


def digest(stored: DataFrame) -> DataFrame:
    """One row per conversation, all of it taken from the stored output."""
    sha = lambda parts: F.sha2(F.array_join(parts, ""), 256)
    # what follows the last reply is in no example; it counts as formatted once
    tail = F.length("transcript") - F.coalesce(F.array_max(F.transform("targets", lambda t: t["prefix_chars"])), F.lit(0))
    whole = stored.withColumn("turns", read_turns(F.col("transcript"))).select(
        "conv_id", "transcript", "targets", tail.alias("tail"), F.size("turns").cast("bigint").alias("n_turns"),
        sha(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("turns_sha256"))
    own = ("tail", "n_turns", "turns_sha256")
    loss = unescape(F.substring("text", (F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int")))
    reply = F.when(F.col("target_turn").isNotNull(), F.struct("target_turn", loss.alias("loss")))
    per = examples(whole, own, every=True).groupBy("conv_id", *own).agg(
        F.array_sort(F.collect_list(reply)).alias("x"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"))
    losses = F.col("x.loss")
    return per.select("conv_id", "n_turns", "turns_sha256", F.length(F.array_join(losses, "")).cast("bigint").alias("loss_chars"),
                      sha(losses).alias("loss_sha256"), (F.col("chars") + F.col("tail")).cast("bigint").alias("formatted_chars"))


TEST_CONVERSATION = "\\### Assistant: </turn> ok"


def op8_prefix_targets(spark, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-7).cast("bigint"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(TEST_CONVERSATION))
    return digest(format_conversations(turns.union(extra), scratch_path(spark, f"chat-{uuid.uuid4().hex}")))


OP8_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             14 + length(role) + length(text)
             + (length(role || text) - length(replace(replace(replace(role || text, '\', ''), '<', ''), '>', ''))) AS chars FROM t),
p AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS upto FROM n)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
       (coalesce(sum(CASE WHEN role = 'assistant' THEN upto END), 0) + max(upto) - coalesce(max(CASE WHEN role = 'assistant' THEN upto END), 0))::BIGINT AS formatted_chars
FROM p GROUP BY conv_id
"""
