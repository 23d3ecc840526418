"""Preference formatting: one prompt from the longest common turn prefix, and two masked completions.

Column functions only. A conversation is one array of turns, gathered once by its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a turn is written, and whose turns are trained on.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"


def conversations(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """`key`, turns: a row per conversation, its turns in order of (turn, role, text).

    Null turns come first, null roles and texts are empty. Rows without an id form one conversation.
    """
    row = F.struct(
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    ordered = F.array_sort(F.collect_list(row), _by_turn)
    plain = F.transform(ordered, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return turns.groupBy(key).agg(plain.alias("turns"))


def _by_turn(a: Column, b: Column) -> Column:
    turn = lambda t: F.struct(t["turn"].isNotNull().alias("known"), t["turn"], t["role"], t["text"])
    return F.when(turn(a) < turn(b), -1).when(turn(a) > turn(b), 1).otherwise(0)


def common_turns(chosen: Column, rejected: Column) -> Column:
    """Length of the longest prefix of equal turns."""
    same = F.zip_with(chosen, rejected, lambda a, b: F.coalesce(a == b, F.lit(False)))
    differs = F.array_position(same, F.lit(False))
    return F.when(differs == 0, F.size(same)).otherwise(differs - 1).cast("bigint")


def segments(turns: Column) -> Column:
    """Pieces of the written turns, in order, each with whether it is trained on.

    What a trained turn says and its end mark are; headers and all other turns are not.
    """
    head = lambda t: F.concat(F.lit(TURN_START), t["role"], F.lit("\n"))
    body = lambda t: F.concat(t["text"], F.lit(TURN_END))
    piece = lambda text, trained: F.struct(text.alias("text"), F.lit(trained).alias("trained"))
    return F.flatten(
        F.transform(
            turns,
            lambda t: F.when(
                t["role"] == TRAINED_ROLE, F.array(piece(head(t), False), piece(body(t), True))
            ).otherwise(F.array(piece(F.concat(head(t), body(t)), False))),
        )
    )


def written(pieces: Column) -> Column:
    return F.array_join(F.transform(pieces, lambda s: s["text"]), "")


def mask(pieces: Column) -> Column:
    """Characters of each piece and 1 where it is trained on, as `21:0,118:1`."""
    return F.array_join(
        F.transform(pieces, lambda s: F.concat_ws(":", F.length(s["text"]), s["trained"].cast("int"))), ","
    )


def examples(pairs: DataFrame) -> DataFrame:
    """Training examples from a frame with `chosen` and `rejected` arrays of turns.

    Adds n_prompt_turns, prompt, and per side the completion, its pieces and its mask. A null side is
    an empty conversation. Equal sides give empty completions and `differs` false; nothing is dropped.
    """
    sides = {side: F.coalesce(F.col(side), F.array().cast(TURNS)) for side in ("chosen", "rejected")}
    counted = pairs.withColumns(sides)
    counted = counted.withColumn("n_prompt_turns", common_turns(F.col("chosen"), F.col("rejected")))
    shared = F.col("n_prompt_turns").cast("int")
    cut = counted.withColumns(
        {"prompt": written(segments(F.slice("chosen", 1, shared)))}
        | {
            f"{side}_segments": segments(F.slice(side, shared + 1, F.size(side)))
            for side in ("chosen", "rejected")
        }
    )
    return cut.withColumns(
        {side: written(F.col(f"{side}_segments")) for side in ("chosen", "rejected")}
        | {f"{side}_mask": mask(F.col(f"{side}_segments")) for side in ("chosen", "rejected")}
        | {"differs": (F.size("chosen_segments") > 0) | (F.size("rejected_segments") > 0)}
    )


def with_foreign_reply(turns: DataFrame) -> DataFrame:
    """Pairs conv_id, chosen, rejected from plain conversations.

    The conversation as it is, against the same one ending in its neighbour's last reply (ids pair up
    as 0 and 1, 2 and 3, ...) in place of its own. Without a neighbour that replies, the rejected side
    ends before the reply; without a reply of its own, both sides are the same.
    """
    whole = conversations(turns)
    marks = F.transform("turns", lambda t: t["role"] == TRAINED_ROLE)
    at = F.size(marks) - F.array_position(F.reverse(marks), F.lit(True)).cast("int") + 1
    own = whole.withColumn("at", F.when(F.array_contains(marks, True), at))
    replies = own.filter("at IS NOT NULL").select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("of"), F.col("turns")[F.col("at") - 1].alias("reply")
    )
    paired = own.join(replies, F.col("conv_id") == F.col("of"), "left")
    before = F.slice("turns", 1, F.col("at") - 1)
    swapped = F.when(F.col("reply").isNull(), before).otherwise(F.concat(before, F.array("reply")))
    return paired.select(
        "conv_id",
        F.col("turns").alias("chosen"),
        F.when(F.col("at").isNull(), F.col("turns")).otherwise(swapped).alias("rejected"),
    )
