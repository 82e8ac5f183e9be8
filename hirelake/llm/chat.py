"""Chat formatting by perspective rotation.

A conversation of several speakers is rendered once for each of them: the speaker is the assistant,
whose turns are to be learnt, the others are named users. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm.common import prefix_sums, stored

START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM = ("system",)
# A rendering is one row per block: the messages that begin within so many characters. Only very long
# conversations have more than one; a message counts as a little longer than its text.
BLOCK_CHARS, PER_MESSAGE = 1 << 18, 256


def _header(own: Column, system: Column) -> Column:
    """What comes before a message's text."""
    name = F.when(F.col("speaker").isNull(), F.lit("user")).otherwise(F.concat(F.lit("user name="), F.col("speaker")))
    role = F.when(system, F.lit("system")).when(own, F.lit("assistant")).otherwise(name)
    return F.concat(F.lit(START), role, F.lit("\n"))


def rotated(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system: Sequence[str] = SYSTEM,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per conversation, participant and block: the dialogue with that participant as assistant.

    Columns: the conversation, ``assistant``, ``block`` (0, 1, ... in order; texts of a conversation's
    blocks follow each other without a gap), ``n_messages``, ``text``, and ``spans``: start and length,
    in characters of this text, of what is to be learnt, which is the assistant's texts, each with the
    end mark. Every conversation's participants are its distinct speakers, but those in ``system``,
    whose messages everybody sees as they are.

    Messages go by turn, those without one last, then by speaker, none last, then by a hash of the text.
    A message that is repeated in all four columns is rendered as often as it comes. A NULL text is empty; a message without a speaker is an unnamed
    user's in all perspectives and nobody's own. Rows without a conversation number form one
    conversation. One without participants gives no rows, as no messages do. Other columns are ignored.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(conversation).cast("string")), F.lit("-"))
    rows = messages.select(
        key.alias("conversation"), F.col(conversation).alias("number"), F.col(turn).alias("turn"),
        F.col(speaker).alias("speaker"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # Repeats are one row with their number until they have their places.
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("times"))
    rows = stored(rows.withColumn("hash", F.xxhash64("text")), "messages")
    # Where every message begins, found without moving its text; ties go by the text's hash.
    order = [F.coalesce(F.col("turn"), F.lit(0)), F.col("turn").isNull(), F.coalesce("speaker", F.lit("")), F.col("speaker").isNull()]
    slim = rows.select(
        "conversation", order[1].alias("no_turn"), order[0].alias("at_turn"), order[3].alias("no_speaker"),
        order[2].alias("by"), "hash", (F.col("times") * (F.length("text") + PER_MESSAGE)).alias("chars"),
    )
    names = ["no_turn", "at_turn", "no_speaker", "by", "hash"]
    begun = prefix_sums(slim, "conversation", names, "chars").select("conversation", *names, "before")
    keyed = rows.withColumns(
        {"no_turn": order[1], "at_turn": order[0], "no_speaker": order[3], "by": order[2]}
    )
    placed = keyed.join(begun, ["conversation", *names]).withColumn("repeat", F.explode(F.sequence(F.lit(1), F.col("times"))))
    place = F.col("before") + (F.col("repeat") - 1) * (F.length("text") + PER_MESSAGE)
    placed = placed.withColumn("before", place).withColumn("block", F.floor(F.col("before") / block_chars))
    is_system = F.coalesce(F.col("speaker").isin(*system), F.lit(False))
    people = rows.where(F.col("speaker").isNotNull() & ~is_system)
    people = people.select("conversation", F.col("speaker").alias("assistant")).distinct()
    own = F.coalesce(F.col("speaker") == F.col("assistant"), F.lit(False)) & ~is_system
    seen = placed.join(people, "conversation").select(
        "conversation", "number", "assistant", "block",
        F.struct("before", own.alias("own"), _header(own, is_system).alias("header"), "text").alias("message"),
    )
    grouped = seen.groupBy("conversation", "assistant", "block").agg(
        F.first("number").alias(conversation), F.array_sort(F.collect_list("message")).alias("messages")
    )
    whole = F.transform("messages", lambda m: F.concat(m["header"], m["text"], F.lit(END)))
    nothing = F.array().cast("array<struct<start:int,length:int>>")

    def walked(state: Column, m: Column) -> Column:
        begins = state["at"] + F.length(m["header"])
        learnt = F.length(m["text"]) + len(END)
        span = F.array(F.struct(begins.alias("start"), learnt.alias("length")))
        spans = F.when(m["own"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((begins + learnt).alias("at"), spans.alias("spans"))

    state = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    return grouped.select(
        conversation,
        "assistant",
        F.col("block").cast("long").alias("block"),
        F.size("messages").cast("long").alias("n_messages"),
        F.array_join(whole, "").alias("text"),
        F.aggregate("messages", state, walked, lambda s: s["spans"]).alias("spans"),
    )


def mask_text(spans: Column | str) -> Column:
    """Spans as text: start and length of each, as in "31+20 90+5"."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["start"], F.lit("+"), s["length"])), " ")
