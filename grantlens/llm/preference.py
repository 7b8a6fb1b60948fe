"""Pairs of a chosen and a rejected conversation, formatted for preference training.

Both conversations are compared turn by turn.  The turns up to the first that differs are
rendered once, as the prompt; what follows on each side is a completion, with a mask of
the stretches to train on: the assistant's words and the end mark after them.

Turns meet by pair and turn number, so no task needs a whole conversation until its
rendered text is made, which holds all of it anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRAINED_ROLE = "assistant"
OPENING = ("<|im_start|>", "\n")
CLOSING = "<|im_end|>\n"


def _head(turn: Column) -> Column:
    return F.concat(F.lit(OPENING[0]), turn["role"], F.lit(OPENING[1]))


def render(turns: Column) -> Column:
    """Text of an array of (role, text)."""
    return F.array_join(
        F.transform(turns, lambda turn: F.concat(_head(turn), turn["text"], F.lit(CLOSING))), ""
    )


def trained_stretches(turns: Column, role: str = TRAINED_ROLE) -> Column:
    """(start, end) of the trained stretches in the rendered text of an array of (role, text)."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("found"))

    def add(state, turn):
        begin = state["at"] + F.length(_head(turn))
        end = begin + F.length(turn["text"]) + len(CLOSING)
        one = F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))
        found = F.when(turn["role"] == role, F.concat(state["found"], one)).otherwise(state["found"])
        return F.struct(end.cast("long").alias("at"), found.alias("found"))

    return F.aggregate(turns, start, add, lambda state: state["found"])


def preference_pairs(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """One row per pair: pair_id, n_common, prompt, chosen, rejected, chosen_mask, rejected_mask.

    ``turns`` has pair_id, side ('chosen' or 'rejected'), turn, role and text.  Masks are
    (start, end) in code points of the completion.  NULL roles and texts count as empty.  Rows without
    a pair, a side or a turn number belong to no conversation and are left out.  A turn given more than once
    counts once, with its smallest (role, text).  A missing turn differs from any turn, so if
    one side ends first its completion is empty; if both are alike both are; a pair with
    one side only has an empty prompt.  An empty table gives an empty result; other columns are not read.
    """
    said = F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )

    def of(side):
        return F.min(F.when(F.col("side") == side, said))

    met = (
        turns.where("pair_id is not null and turn is not null and side in ('chosen', 'rejected')")
        .groupBy("pair_id", "turn")
        .agg(of("chosen").alias("c"), of("rejected").alias("r"))
        .withColumn("differs", ~F.col("c").eqNullSafe(F.col("r")))
    )
    pairs = met.groupBy("pair_id").agg(
        F.min(F.when(F.col("differs"), F.col("turn"))).alias("first"),
        F.sort_array(F.collect_list(F.struct("turn", "c", "r"))).alias("turns"),
    )
    common = F.filter(
        "turns", lambda t: F.col("first").isNull() | (t["turn"] < F.col("first"))
    )

    def rest(side):
        own = F.filter("turns", lambda t: (t["turn"] >= F.col("first")) & t[side].isNotNull())
        return F.transform(own, lambda t: t[side])

    parts = pairs.select(
        "pair_id",
        F.transform(common, lambda t: t["c"]).alias("common"),
        rest("c").alias("c"),
        rest("r").alias("r"),
    )
    return parts.select(
        "pair_id",
        F.size("common").cast("long").alias("n_common"),
        render(F.col("common")).alias("prompt"),
        render(F.col("c")).alias("chosen"),
        render(F.col("r")).alias("rejected"),
        trained_stretches(F.col("c"), trained_role).alias("chosen_mask"),
        trained_stretches(F.col("r"), trained_role).alias("rejected_mask"),
    )


def answer_pairs(
    conversations: DataFrame, conv: str = "conv_id", role: str = TRAINED_ROLE
) -> DataFrame:
    """Turns of every conversation as a pair: its own last answer chosen, that of the next one rejected.

    Both sides share the turns before the last answer; the rejected side then has the last answer of
    conversation ``conv + 1`` in its place.  Where there is no such answer the rejected side ends with the
    shared turns; a conversation without an answer is the same on both sides.  Turns after the last answer
    are no part of a pair, as no answer to them can be chosen.  NULL roles and texts count as empty, rows
    without a conversation or a turn number are left out, a turn given more than once counts once, with its
    smallest (role, text).  Gives pair_id (the conversation), side, turn, role and text.

    The answers meet the turns by conversation, so that a third of all turns in one conversation stay rows.
    """
    said = F.struct(
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = (
        conversations.where(F.col(conv).isNotNull() & F.col("turn").isNotNull())
        .groupBy(F.col(conv).cast("long").alias("pair_id"), "turn")
        .agg(F.min(said).alias("said"))
    )
    answers = turns.where(F.col("said.role") == role).groupBy("pair_id").agg(
        F.max("turn").alias("last"), F.max_by("said.text", "turn").alias("answer")
    )
    # Answers of the next conversation, and where the own last one stands, as one row a conversation.
    ends = (
        answers.select("pair_id", "last", F.lit(None).cast("string").alias("other"))
        .unionByName(
            answers.select(
                F.try_subtract("pair_id", F.lit(1).cast("long")).alias("pair_id"),
                F.lit(None).cast(turns.schema["turn"].dataType).alias("last"),
                F.col("answer").alias("other"),
            )
        )
        .groupBy("pair_id")
        .agg(F.max("last").alias("last"), F.max("other").alias("other"))
    )
    chosen = F.struct(F.lit("chosen").alias("side"), F.col("said.role").alias("role"), F.col("said.text").alias("text"))
    own = F.col("last").isNull() | (F.col("turn") < F.col("last"))
    rejected = F.when(
        own | F.col("other").isNotNull(),
        F.struct(
            F.lit("rejected").alias("side"),
            F.col("said.role").alias("role"),
            F.when(own, F.col("said.text")).otherwise(F.col("other")).alias("text"),
        ),
    )
    return (
        turns.join(ends, "pair_id", "left")
        .where(own | (F.col("turn") == F.col("last")))
        .select("pair_id", "turn", F.explode(F.array_compact(F.array(chosen, rejected))).alias("one"))
        .select("pair_id", "one.side", "turn", "one.role", "one.text")
    )


def pair_digests(pairs: DataFrame) -> DataFrame:
    """Pairs with checksums instead of texts, and masks as ``start:end`` joined by commas."""

    def mask(column):
        return F.array_join(
            F.transform(
                column,
                lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")),
            ),
            ",",
        )

    return pairs.select(
        "pair_id",
        "n_common",
        *[F.sha2(name, 256).alias(f"{name}_sha256") for name in ("prompt", "chosen", "rejected")],
        mask("chosen_mask").alias("chosen_mask"),
        mask("rejected_mask").alias("rejected_mask"),
    )
