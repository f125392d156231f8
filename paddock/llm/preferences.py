"""Preference formatting of chat conversations.

Of a chosen and a rejected conversation the longest common prefix of turns is
rendered once, as the prompt; what follows it in either is a completion, with the
spans of the assistant's own words as its mask. Expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def turns_of(conversations: DataFrame, key: str) -> DataFrame:
    """One row per conversation: its turns in order. A null role counts as user, a
    null text as empty; turns of one number are ordered by role and text."""
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return conversations.groupBy(key).agg(F.sort_array(F.collect_list(turn)).cast(TURNS).alias("turns"))


def clean(text: Column) -> Column:
    """Text in which nothing looks like a mark of the template."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def opening(turn: Column) -> Column:
    return F.concat(F.lit("<|"), clean(turn["role"]), F.lit("|>\n"))


CLOSING = "<|end|>\n"


def rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(opening(t), clean(t["text"]), F.lit(CLOSING))), "")


def mask(turns: Column) -> Column:
    """Spans ``start-end`` in characters of the rendered turns that are to be
    learned, space-joined: the assistant's texts with their closing mark."""

    def extend(a: Column, t: Column) -> Column:
        start = a["at"] + F.length(opening(t))
        end = start + F.length(clean(t["text"])) + F.lit(len(CLOSING) - 1)
        span = F.concat(F.when(a["spans"] == "", "").otherwise(" "), start.cast("string"), F.lit("-"), end.cast("string"))
        spans = F.concat(a["spans"], F.when(t["role"] == "assistant", span).otherwise(""))
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), F.lit("").alias("spans")), extend, lambda a: a["spans"])


def formatted(pairs: DataFrame) -> DataFrame:
    """Format rows with the turn arrays ``chosen`` and ``rejected``; other columns
    are kept. Added: n_prompt_turns, prompt, the completions ``chosen_text`` and
    ``rejected_text``, their masks, and ``differs`` (false if the conversations
    are equal, so that both completions are empty). Null turns are no turns.
    """
    none = F.array().cast(TURNS)
    rows = pairs.withColumns({"chosen": F.coalesce("chosen", none), "rejected": F.coalesce("rejected", none)})
    shorter = F.least(F.size("chosen"), F.size("rejected"))
    same = F.transform(F.slice("chosen", 1, shorter), lambda t, i: _same(t, F.get("rejected", i)))
    first = F.array_position(same, F.lit(False))
    rows = rows.withColumn("n_prompt_turns", F.when(first == 0, shorter).otherwise(first - 1).cast("long"))
    n = F.col("n_prompt_turns").cast("int")
    rest = {x: F.slice(x, n + 1, F.size(x)) for x in ("chosen", "rejected")}
    return rows.withColumns(
        {
            "prompt": rendered(F.slice("chosen", F.lit(1), n)),
            "chosen_text": rendered(rest["chosen"]),
            "rejected_text": rendered(rest["rejected"]),
            "chosen_mask": mask(rest["chosen"]),
            "rejected_mask": mask(rest["rejected"]),
            "differs": (F.size("chosen") > n) | (F.size("rejected") > n),
        }
    ).drop("chosen", "rejected")


def _same(a: Column, b: Column) -> Column:
    return (a["role"] == b["role"]) & (a["text"] == b["text"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame, key: str = "pair_id") -> DataFrame:
    """Format two tables of turns (key, turn, role, text). A pair found in one
    table only is kept, with an empty other side; a null key is one pair."""
    left = turns_of(chosen, key).withColumnRenamed("turns", "chosen")
    right = turns_of(rejected, key).select(F.col(key).alias("_key"), F.col("turns").alias("rejected"))
    joined = left.join(right, left[key].eqNullSafe(right["_key"]), "full")
    return formatted(joined.withColumn(key, F.coalesce(key, "_key")).drop("_key"))


def with_borrowed_replies(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """Pairs made from plain conversations: chosen is the whole conversation, rejected
    the same with the text of its last assistant turn taken from its neighbour (the key
    with its lowest bit flipped; without one: empty). What follows that turn is kept on
    both sides; it holds no assistant's words, so no mask covers it. Without an
    assistant turn both are alike. Nulls, ties and repeated rows as in ``turns_of``; a
    null key is one conversation without a neighbour, an empty table has no pairs, and
    other columns are not kept."""
    rows = turns_of(conversations.select(key, "turn", "role", "text"), key)
    last = F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: t["role"] == "assistant")), F.lit(True)) + 1
    rows = rows.withColumn("_last", F.when(last <= F.size("turns"), last).otherwise(0).cast("int"))
    reply = F.when(F.col("_last") > 0, F.get("turns", F.col("_last") - 1)["text"])
    replies = rows.select(F.col(key).bitwiseXOR(F.lit(1)).alias("_for"), reply.alias("_reply"))
    joined = rows.join(replies, rows[key] == replies["_for"], "left")
    borrowed = F.transform(
        "turns", lambda t, i: F.struct(t["turn"], t["role"], F.when(i + 1 == F.col("_last"), F.coalesce("_reply", F.lit(""))).otherwise(t["text"]))
    )
    return joined.select(key, F.col("turns").alias("chosen"), borrowed.cast(TURNS).alias("rejected"))
