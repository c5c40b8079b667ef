"""Chat formatting by perspective rotation: every participant of a dialogue once as the assistant.

For each dialogue and each of its participants there is one rendering: turns of that speaker are the assistant's and are
trained on (``mask``, and ``train_from`` to ``train_to`` in code points of ``rendered``: the text and its end mark, not the header), turns of all
others are users' and carry the speaker's name; system turns are no participant's and stay system turns. A rendering is its rows in the order of ``turn`` and ``tie``: one row per turn, so a dialogue of any
length is never gathered in one place; written in that order, the ``rendered`` texts one after the other are the rendering.

Null texts count as empty, a null speaker as ``unknown``, rows with a null conversation are one conversation. Turns with the
same number keep an order of their own by speaker and text (``tie``, a hash); rows that repeat are all rendered. A mark
``<|`` inside a text gets a blank, and in a name ``|>`` and control characters too, so that neither can forge the frame. Very long texts are
rendered as they are. A conversation of system turns only has no
participant and no rendering. Extra columns are not touched; empty tables give empty results.

Only built-in functions: the participants are combined before the shuffle, and the one join has a side that is unique by
conversation and participant; adaptive execution splits a conversation that holds very many turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SYSTEM = "system"


END = "<|end|>\n"


def _head(kind: Column, name: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"[\x00-\x1F\x7F]+", " "), r"<\|", "< |"), r"\|>", "| >")
    return F.concat(F.lit("<|"), kind, F.when(name.isNotNull(), F.concat(F.lit(" name="), plain)).otherwise(""), F.lit("|>\n"))


def rotated(turns: DataFrame, speaker: str = "role", system: str = SYSTEM) -> DataFrame:
    """One row per perspective and turn of ``turns(conv_id, turn, text)`` and the speaker's column."""
    said = turns.select(
        "conv_id", "turn", F.coalesce(F.col(speaker), F.lit("unknown")).alias("speaker"),
        F.regexp_replace(F.coalesce("text", F.lit("")), r"<\|", "< |").alias("text"),
    )
    who = said.filter(F.col("speaker") != system).select(
        F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")
    ).distinct()
    own = F.col("speaker") == F.col("perspective")
    kind = F.when(own, "assistant").when(F.col("speaker") == system, "system").otherwise("user")
    name = F.when((F.col("speaker") != system) & ~own, F.col("speaker"))
    tie = F.md5(F.concat(F.char_length("speaker").cast("string"), F.lit(":"), "speaker", "text"))
    framed = said.join(who, F.col("conv_id").eqNullSafe(F.col("_conv"))).withColumns({"kind": kind, "mask": own, "_head": _head(kind, name)})
    return framed.select(
        "conv_id", "perspective", "turn", "speaker", "kind", "mask", F.concat("_head", "text", F.lit(END)).alias("rendered"),
        F.when(own, F.char_length("_head")).alias("train_from"),
        F.when(own, F.char_length("_head") + F.char_length("text") + len(END)).alias("train_to"), tie.alias("tie"),
    )


def coverage(rotations: DataFrame) -> DataFrame:
    """Per perspective: turns and characters, all and trained on."""
    return rotations.groupBy("conv_id", "perspective").agg(
        F.count(F.lit(1)).alias("n_turns"), F.count_if("mask").alias("n_trained_turns"),
        F.sum(F.char_length("rendered")).alias("n_chars"),
        F.sum(F.coalesce(F.col("train_to") - F.col("train_from"), F.lit(0))).alias("n_trained_chars"),
    )
