"""Chat formatting: one rendering of a dialogue for every participant, who speaks as the assistant in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART_TURNS = 256
CONTEXT = ("system",)  # roles that give context and are nobody's perspective


def perspectives(turns: DataFrame, part_turns: int = PART_TURNS, context: tuple[str, ...] = CONTEXT) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) as rows (conv_id, speaker, part, text, spans, n_turns, n_masked).

    For every participant of a conversation (its distinct roles but those in ``context`` and null) the whole dialogue is
    rendered in turn order: the speaker's turns as ``<|assistant|>``, context as ``<|system|>``, others as
    ``<|user name=ROLE|>`` (a null role is ``unknown``); each turn ends with ``<|end|>`` and a line feed. ``spans`` are the
    parts to train on as (start, end) in characters of ``text``: what the speaker says, and its end mark. ``n_masked``
    counts the characters outside. Turns of equal number come in order of role and text, repeated ones stay; null texts
    are empty; a null conv_id is a conversation; a conversation without participants has no row.

    Long dialogues are split by turn number into parts of ``part_turns``, so a row is bounded by what stands in so many
    turns; the parts in order are the whole dialogue. No window runs over a conversation.
    """
    role = F.coalesce("role", F.lit("unknown"))
    part = F.coalesce(F.floor(F.col("turn") / part_turns), F.lit(-1)).cast("long")
    line = F.struct(
        F.coalesce("turn", F.lit(-(2**62))).cast("long").alias("turn"), role.alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    parts = turns.groupBy("conv_id", part.alias("part")).agg(F.array_sort(F.collect_list(line)).alias("lines"))
    speakers = turns.where(F.col("role").isNotNull() & ~F.col("role").isin(*context)).select("conv_id", F.col("role").alias("speaker"))
    pairs = parts.alias("p").join(speakers.distinct().alias("s"), F.col("p.conv_id").eqNullSafe(F.col("s.conv_id")))

    def head(x: Column) -> Column:
        own = F.when(x["role"] == F.col("speaker"), F.lit("<|assistant|>\n"))
        other = F.concat(F.lit("<|user name="), x["role"], F.lit("|>\n"))
        return own.when(x["role"].isin(*context), F.concat(F.lit("<|"), x["role"], F.lit("|>\n"))).otherwise(other)

    end = F.lit("<|end|>")
    shown = F.transform(
        "lines", lambda x: F.struct(head(x).alias("head"), F.concat(x["text"], end).alias("body"), (x["role"] == F.col("speaker")).alias("own"))
    )
    sizes = F.transform("shown", lambda x: F.length(x["head"]) + F.length(x["body"]) + 1)
    offsets = F.aggregate(
        "sizes", F.array(F.lit(0)), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n)
    )
    spans = F.filter(
        F.transform(
            "shown",
            lambda x, k: F.struct(
                (F.get("offsets", k) + F.length(x["head"])).alias("start"),
                (F.get("offsets", k) + F.length(x["head"]) + F.length(x["body"])).alias("end"),
                x["own"].alias("own"),
            ),
        ),
        lambda x: x["own"],
    )
    return (
        pairs.select("p.conv_id", "speaker", "part", "lines")
        .withColumn("shown", shown)
        .withColumn("sizes", sizes)
        .withColumn("offsets", offsets)
        .withColumn("spans", F.transform(spans, lambda x: F.struct(x["start"], x["end"])))
        .withColumn("text", F.concat_ws("", F.transform("shown", lambda x: F.concat(x["head"], x["body"], F.lit("\n")))))
        .withColumn("n_turns", F.size("lines"))
        .withColumn("n_masked", F.length("text") - F.aggregate("spans", F.lit(0), lambda n, x: n + x["end"] - x["start"]))
        .select("conv_id", "speaker", "part", "text", "spans", "n_turns", "n_masked")
    )
