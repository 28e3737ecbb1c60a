"""Preference formatting: a shared prompt and two masked completions.

A pair is a chosen and a rejected conversation (arrays of role/text turns).
The longest common prefix of whole turns is rendered once as the prompt; each
side's remaining turns are rendered as its completion, with the spans on
which training has loss (what the assistant says, with its end mark) and
everything else masked.  All of it is DataFrame functions over arrays;
building the turn arrays is the only shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"  # fixed values: the ChatML marks


def _head(turn: Column) -> Column:
    return F.concat(F.lit(TURN_START), F.coalesce(turn["role"], F.lit("")), F.lit("\n"))


def _body(turn: Column) -> Column:
    return F.concat(F.coalesce(turn["text"], F.lit("")), F.lit(TURN_END))


def render(turns: Column) -> Column:
    """The turns in the chat template; no turns give an empty string, null roles and texts are empty."""
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), _body(t), F.lit("\n"))), "")


def common_turns(a: Column, b: Column) -> Column:
    """Number of leading turns that are equal in role and text (null equals null)."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x.isNotNull() & y.isNotNull() & x["role"].eqNullSafe(y["role"])
                                                    & x["text"].eqNullSafe(y["text"]), F.lit(False)))
    first = F.array_position(same, F.lit(False))
    return F.when(first > 0, first - 1).otherwise(F.size(same).cast("long"))


def loss_spans(turns: Column, role: str = "assistant") -> Column:
    """``start:end`` (code points, end exclusive) of the trained parts of ``render(turns)``, comma-joined."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(t))
        end = begin + F.length(_body(t))
        span = F.concat_ws(":", begin.cast("string"), end.cast("string"))
        return F.struct((end + 1).cast("long").alias("at"),
                        F.when(t["role"].eqNullSafe(F.lit(role)), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda acc: F.array_join(acc["spans"], ","))


def format_pairs(pairs: DataFrame, chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """Replaces the two turn arrays (``array<struct<role, text>>``) by ``prompt,
    prompt_turns, chosen, chosen_loss, rejected, rejected_loss``, where ``chosen`` and ``rejected``
    are the rendered completions; other columns stay.

    Null arrays count as empty; equal conversations leave two empty completions.
    Other columns with an output's name are replaced by it."""
    a = F.coalesce(F.col("__a"), F.array().cast(pairs.schema[chosen].dataType))
    b = F.coalesce(F.col("__b"), F.array().cast(pairs.schema[rejected].dataType))
    n, rest = F.col("__n"), lambda x: F.slice(x, F.col("__n").cast("int") + 1, F.greatest(F.size(x) - F.col("__n").cast("int"), F.lit(0)))
    outputs = {"prompt", "prompt_turns", "chosen", "chosen_loss", "rejected", "rejected_loss"}
    others = [c for c in pairs.columns if c not in outputs | {chosen, rejected}]
    return (pairs.select(*others, F.col(chosen).alias("__a"), F.col(rejected).alias("__b"))
            .withColumn("__n", common_turns(a, b))
            .select(*others, render(F.slice(a, 1, n.cast("int"))).alias("prompt"), n.alias("prompt_turns"),
                    render(rest(a)).alias("chosen"), loss_spans(rest(a)).alias("chosen_loss"),
                    render(rest(b)).alias("rejected"), loss_spans(rest(b)).alias("rejected_loss")))


def contrast_pairs(conversations: DataFrame, role: str = "assistant") -> DataFrame:
    """``conv_id, chosen, rejected``: one pair for each conversation.

    ``chosen`` is the conversation up to its last answer (a turn of ``role``; trailing
    turns without an answer are left out); ``rejected`` has in place of that
    answer the last answer of the conversation's neighbour (``conv_id`` with its last
    bit flipped). Without a neighbour that answers, ``rejected`` stops before the answer; a conversation
    without any answer is whole on both sides.  Turns are ordered by number,
    ties by role, then text; null ids form one conversation without a neighbour.
    One shuffle, by pair of neighbours; a row holds one conversation, as its output must.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    conv = F.col("conv_id").cast("long")
    grouped = (conversations.select(conv.alias("conv_id"), turn.alias("t"))
               .groupBy(F.shiftright("conv_id", 1).alias("pair"))
               .agg(F.sort_array(F.collect_list(F.when(F.col("conv_id").isNull() | (F.col("conv_id").bitwiseAND(1) == 0), F.col("t")))).alias("even"),
                    F.sort_array(F.collect_list(F.when(F.col("conv_id").bitwiseAND(1) == 1, F.col("t")))).alias("odd")))
    two = grouped.select(F.explode(F.array(
        F.struct((F.col("pair") * 2).alias("conv_id"), F.col("even").alias("own"), F.col("odd").alias("other")),
        F.struct((F.col("pair") * 2 + 1).alias("conv_id"), F.col("odd").alias("own"), F.col("even").alias("other")))).alias("s")).select("s.*")
    turns = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    is_answer = lambda c: F.transform(c, lambda t: t["role"].eqNullSafe(F.lit(role)))
    last = lambda c: F.size(c) - F.array_position(F.reverse(is_answer(c)), F.lit(True)).cast("int") + 1  # noqa: E731  size + 1 if none
    return (two.where(F.size("own") > 0)
            .select("conv_id", turns(F.col("own")).alias("own"), turns(F.col("other")).alias("other"))
            .select("*", last(F.col("own")).alias("at"), last(F.col("other")).alias("other_at"))
            .select("conv_id", F.slice("own", F.lit(1), F.least(F.col("at"), F.size("own"))).alias("chosen"),
                    F.when(F.col("at") > F.size("own"), F.col("own"))
                    .otherwise(F.concat(F.slice("own", F.lit(1), F.col("at") - 1),
                                        F.slice("other", F.least(F.col("other_at"), F.size("other") + 1),
                                                F.when(F.col("other_at") <= F.size("other"), 1).otherwise(0)))).alias("rejected")))
