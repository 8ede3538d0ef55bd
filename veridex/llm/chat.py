"""Multi-party perspective rotation of conversations.

For every participant of a conversation the dialogue is rendered once with that speaker as the assistant and all other
speakers as named users; only the assistant's turns are to be learnt (mask 1).  Turns of ``CONTEXT`` roles are rendered
as themselves in every perspective and are nobody's perspective.  The result has a row for each perspective and turn, in
the order of ``turn``, so a conversation of any length is never gathered into one task; ``dialogues`` makes one row of each
dialogue, which is then one value of one task.

A text or name cannot forge a role: each "<|" in it is written "<\\|".  A null text is empty; a null role is the speaker
"unknown"; rows without a conversation id form one conversation of their own; rows that repeat are turns of their own.  A
conversation of context turns alone has no perspective and no rows.  Texts of any length are kept whole.  An empty table
gives an empty result, and other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTEXT = ("system",)
UNKNOWN = "unknown"


def escaped(text):
    """A text without the mark that opens a header."""
    return F.replace(text, F.lit("<|"), F.lit("<\\|"))


def perspectives(turns: DataFrame, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """conv_id, perspective, turn, speaker, message_role, message_name, rendered, mask."""
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    people = turns.where(~F.col("speaker").isin(*context)).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    own, aside = F.col("speaker") == F.col("perspective"), F.col("speaker").isin(*context)
    role = F.when(aside, escaped(F.col("speaker"))).when(own, F.lit("assistant")).otherwise(F.lit("user"))
    name = F.when(~aside & ~own, F.col("speaker"))
    header = F.concat(F.lit("<|"), role, F.coalesce(F.concat(F.lit(" name="), escaped(name)), F.lit("")), F.lit("|>"))
    return turns.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "perspective", "turn", "speaker", role.alias("message_role"), name.alias("message_name"),
        F.concat(header, escaped(F.col("text")), F.lit("<|end|>")).alias("rendered"), F.when(own & ~aside, 1).otherwise(0).alias("mask"),
    )


def assemble(rendered: DataFrame) -> DataFrame:
    """One row per conversation and perspective: the dialogue and its learnt spans (start, end); ties of a turn go by speaker, then text."""
    rows = F.array_sort(F.collect_list(F.struct(F.col("turn").isNull().alias("last"), "turn", "speaker", "rendered", "mask")))
    grouped = rendered.groupBy("conv_id", "perspective").agg(rows.alias("t"))
    ends = F.aggregate("t", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")), lambda acc, x: F.struct((acc["at"] + F.length(x["rendered"])).alias("at"), F.when(x["mask"] == 1, F.concat(acc["spans"], F.array(F.struct(acc["at"].alias("start"), (acc["at"] + F.length(x["rendered"])).alias("end"))))).otherwise(acc["spans"]).alias("spans")))
    return grouped.select("conv_id", "perspective", F.array_join(F.transform("t", lambda x: x["rendered"]), "").alias("dialogue"), ends["spans"].alias("spans"))


def dialogues(turns: DataFrame, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """conv_id, perspective, dialogue, learnt: the rendered dialogue and its learnt spans as start:end, joined by commas."""
    spans = F.array_join(F.transform("spans", lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"))), ",")
    return assemble(perspectives(turns, context)).select("conv_id", "perspective", "dialogue", spans.alias("learnt"))
