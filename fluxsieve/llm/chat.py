"""Preference formatting (operator 6): shared prompt and paired masked completions.

A pair is two conversations, chosen and rejected. Their turns meet in one row per pair; the longest common
prefix of turns (equal role and text) is rendered once as the prompt, the rest of each side as its completion,
with the spans (code points, end exclusive) of the completion that count for the loss: what assistants say,
with their end mark. Everything else is masked.

All of it is DataFrame expressions. One conversation becomes one row; a common conversation or first turn is
never a key, since pairs are keyed by ids.

Defined results: turns are ordered by turn, role and text, nulls first; rows repeated whole count once; null
roles read ``unknown`` and null texts are empty; rows with a null conv_id are in no conversation; marks inside
a text are broken by a space after ``<``, so that a text cannot open or close a turn; a pair with one side only
has an empty prompt and nulls for the other side; two equal conversations are all prompt, both completions empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The marks around a turn and the roles that are trained on.
OPEN, CLOSE, TRAINED = "<|im_start|>", "<|im_end|>\n", "assistant"
SIDES = ("chosen", "rejected")


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs by id: conversation 2k is the chosen side of pair k, 2k + 1 the rejected one."""
    own = turns.where(F.col("conv_id").isNotNull())
    return own.select(F.shiftright(F.col("conv_id").cast("long"), 1).alias("pair_id"), F.pmod("conv_id", F.lit(2)).cast("int").alias("side"),
                      "conv_id", "turn", "role", "text")


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(CLOSE))), "")


def _mask(turns: Column) -> Column:
    """Spans of the trained turns within the rendered text."""
    def step(state, t):
        start = state["at"] + F.length(_head(t))
        end = start + F.length(t["text"]) + len(CLOSE)
        return F.struct(end.alias("at"), F.when(t["role"] == TRAINED, F.concat(state["spans"], F.array(
            F.struct(start.alias("start"), end.alias("end"))))).otherwise(state["spans"]).alias("spans"))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    return F.aggregate(turns, begin, step)["spans"]


def preferences(sides: DataFrame) -> DataFrame:
    """One row per pair_id: ids, n_shared, prompt, and completion and mask of each side.

    ``sides``: pair_id, side (0 chosen, 1 rejected), conv_id, turn, role, text.
    """
    clean = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit("<|"), F.lit("< |"))
    turn = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), clean.alias("text"))
    groups = sides.groupBy("pair_id").agg(
        *[F.array_distinct(F.sort_array(F.collect_list(F.when(F.col("side") == i, turn)))).alias(s)
          for i, s in enumerate(SIDES)],
        *[F.max(F.when(F.col("side") == i, F.col("conv_id"))).alias(f"{s}_id") for i, s in enumerate(SIDES)])
    both = F.least(F.size("chosen"), F.size("rejected"))
    differs = lambda i: ((F.get("chosen", i)["role"] != F.get("rejected", i)["role"])
                         | (F.get("chosen", i)["text"] != F.get("rejected", i)["text"]))
    first = F.get(F.filter(F.transform(F.sequence(F.lit(0), both - 1), lambda i: F.when(differs(i), i)),
                           lambda i: i.isNotNull()), F.lit(0))
    shared = groups.withColumn("n_shared", F.when(both > 0, F.coalesce(first, both)).otherwise(0))
    rest = shared.select("pair_id", "chosen_id", "rejected_id", "n_shared", F.slice(
        "chosen", F.lit(1), F.col("n_shared")).alias("prompt_turns"), *[
        F.when(F.col(f"{s}_id").isNotNull(), F.slice(s, F.col("n_shared") + 1, F.size(s))).alias(s) for s in SIDES])
    return rest.select("pair_id", "chosen_id", "rejected_id", "n_shared", _render(F.col("prompt_turns")).alias("prompt"),
                       *[f(F.col(s)).alias(f"{s}{suffix}") for s in SIDES for f, suffix in ((_render, ""), (_mask, "_mask"))])
