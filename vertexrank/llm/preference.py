"""Preference formatting: one prompt and two masked completions per pair.

A pair is a chosen and a rejected conversation. Their longest common prefix of
turns is rendered once as the prompt; what follows in either is its completion,
with the spans a model is trained on: the text and end marker of assistant
turns, as ``start:end`` code point offsets into the completion.

A message is rendered as ``<|role|>\\ntext<|end|>\\n``; ``<|`` inside a role or
text becomes ``< |``, so no content can forge a marker.

Turns are compared by number, so the common prefix comes from aggregates over
(pair, turn) and a very long conversation is spread over tasks until it becomes
one rendered row. Defined cases: a turn number that repeats in a conversation
holds its messages in order of role and text, and compares as a whole; a null
turn comes first; null role or text is empty; a conversation without its
partner is all completion, the other side null; equal conversations give two
empty completions; rows without pair or side are left out, rows repeated in
full count as messages of their turn; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.succession import successor_pairs
from .common import cut

END = "<|end|>\n"


def _safe(c: str) -> Column:
    return F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|"), F.lit("< |"))


def format_preferences(turns: DataFrame) -> DataFrame:
    """``turns``: ``pair_id, chosen`` (boolean), ``conv_id, turn, role, text``.
    One row per pair: ``pair_id, chosen_id, rejected_id, n_prompt, n_chosen,
    n_rejected, prompt, chosen, rejected, chosen_mask, rejected_mask``."""
    rows = turns.where("pair_id is not null and chosen is not null").select(
        "pair_id", "chosen", "conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"), _safe("role").alias("role"), _safe("text").alias("text")
    )
    said = F.struct("role", "text")
    each = rows.groupBy("pair_id", "turn").agg(
        F.sort_array(F.collect_list(F.when(F.col("chosen"), said))).alias("yes"),
        F.sort_array(F.collect_list(F.when(~F.col("chosen"), said))).alias("no"),
    )
    first = each.groupBy("pair_id").agg(F.min(F.when(F.col("yes") != F.col("no"), F.col("turn"))).alias("first"))
    # a common turn is kept once, the others under their own side
    parts = each.join(first, "pair_id").where("first is null or turn < first").select("pair_id", "turn", F.lit("prompt").alias("part"), F.explode("yes").alias("m"))
    tail = each.join(first, "pair_id").where("turn >= first")
    for part, column in (("chosen", "yes"), ("rejected", "no")):
        parts = parts.unionByName(tail.select("pair_id", "turn", F.lit(part).alias("part"), F.explode(column).alias("m")))
    parts = parts.select(
        "pair_id", "part", "turn", "m.role", "m.text", F.concat(F.lit("<|"), "m.role", F.lit("|>\n"), "m.text", F.lit(END)).alias("shown")
    )
    order = Window.partitionBy("pair_id", "part").orderBy("turn", "role", "text")
    parts = parts.withColumn("k", F.row_number().over(order)).withColumn(
        "at", F.coalesce(F.sum(F.length("shown")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    begin = F.col("at") + F.length("role") + 5
    span = F.when(F.col("role") == "assistant", F.concat_ws(":", begin, F.col("at") + F.length("shown")))
    lists = parts.groupBy("pair_id", "part").agg(
        F.sort_array(F.collect_list(F.struct("k", "shown"))).alias("shown"),
        F.sort_array(F.collect_list(F.when(span.isNotNull(), F.struct("k", span.alias("span"))))).alias("spans"),
        F.count("*").alias("n"),
    )
    pick = lambda part, value: F.max(F.when(F.col("part") == part, value))
    text = F.array_join("shown.shown", "")
    mask = F.array_join("spans.span", ",")
    shown = lists.groupBy("pair_id").agg(
        pick("prompt", F.col("n")).alias("n_prompt"),
        pick("chosen", F.col("n")).alias("n_chosen"),
        pick("rejected", F.col("n")).alias("n_rejected"),
        pick("prompt", text).alias("prompt"),
        pick("chosen", text).alias("chosen"),
        pick("rejected", text).alias("rejected"),
        pick("chosen", mask).alias("chosen_mask"),
        pick("rejected", mask).alias("rejected_mask"),
    )
    ids = rows.groupBy("pair_id").agg(
        F.min(F.when(F.col("chosen"), F.col("conv_id"))).alias("chosen_id"), F.min(F.when(~F.col("chosen"), F.col("conv_id"))).alias("rejected_id")
    )
    whole = lambda c, there: F.when(F.col(there).isNotNull(), F.coalesce(c, F.lit("")))
    return ids.join(shown, "pair_id").select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_prompt", "n_chosen", "n_rejected")],
        F.coalesce("prompt", F.lit("")).alias("prompt"),
        whole("chosen", "chosen_id").alias("chosen"),
        whole("rejected", "rejected_id").alias("rejected"),
        whole("chosen_mask", "chosen_id").alias("chosen_mask"),
        whole("rejected_mask", "rejected_id").alias("rejected_mask"),
    )


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of conversations 2k (chosen) and 2k + 1 (rejected) as pair k."""
    return conversations.where("conv_id is not null").select(
        F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id"), (F.pmod("conv_id", F.lit(2)) == 0).alias("chosen"), "conv_id", "turn", "role", "text"
    )


def shared_prompt_pairs(conversations: DataFrame) -> DataFrame:
    """Turns of every conversation as chosen (``pair_id`` is its ``conv_id``) and, as
    rejected, its turns before the last assistant turn followed by the last
    assistant turn of the next conversation by id that has one (the last takes the
    first's; ``rejected_id`` names it). The turns before the reply are shared, so
    they are the prompt. A conversation without assistant turn, or the only one
    with such a turn, has no rejected side."""
    rows = conversations.where("conv_id is not null").select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-(1 << 62))).alias("turn"), "role", "text")
    last = cut(rows.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("last")))
    following = successor_pairs(last.withColumn("all", F.lit(0)), "all", ["conv_id"], "conv_id").toDF("conv_id", "donor")
    wrap = last.agg(F.max("conv_id").alias("conv_id"), F.min("conv_id").alias("donor")).where("conv_id <> donor")
    pairs = cut(last.join(following.unionByName(wrap), "conv_id"))
    head = rows.join(pairs, "conv_id").where("turn < last").select(F.col("conv_id").alias("pair_id"), F.lit(False).alias("chosen"), F.col("donor").alias("conv_id"), "turn", "role", "text")
    reply = rows.join(last, "conv_id").where("turn = last").select(F.col("conv_id").alias("donor"), "role", "text")
    tail = reply.join(pairs, "donor").select(F.col("conv_id").alias("pair_id"), F.lit(False).alias("chosen"), F.col("donor").alias("conv_id"), F.col("last").alias("turn"), "role", "text")
    own = rows.select(F.col("conv_id").alias("pair_id"), F.lit(True).alias("chosen"), "conv_id", "turn", "role", "text")
    return own.unionByName(head).unionByName(tail)
