"""Multi-party dialogues seen by each participant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.shared import whole_text

# The marks of the rendered format, and the role that frames a dialogue without taking part in it.
OPEN, CLOSE, END = "<|", "|>", "<|end|>"
NARRATOR = "system"
#: Messages that are rendered into one row at most; longer dialogues go on in further rows.
SEGMENT = 256


def _safe(text: Column) -> Column:
    """Text that can't be taken for a mark."""
    return F.replace(text, F.lit(OPEN), F.lit("< |"))


def perspectives(conversations: DataFrame, narrator: str = NARRATOR, segment: int = SEGMENT) -> DataFrame:
    """Every dialogue once for each of its participants, rendered with that speaker as the assistant and the others as
    named users: conv_id, perspective, segment, part, n_turns, rendered and mask.

    mask lists start:end (code points of `rendered`, end exclusive) of what the assistant says with the end mark after
    it, comma-joined: the only stretches to learn from. Messages with the narrator's role frame the dialogue as system
    messages. Messages stand in the order of turn, role and text; those of turns segment * n to segment * (n + 1) - 1 are
    segment n, cut into parts of `segment` messages where turns repeat, so a row is of bounded size whatever a
    conversation holds. A null or empty role is a speaker named unknown, a null text an empty one; null conv_ids are one
    conversation; a null turn comes first; rows alike are all rendered. A dialogue of narrators alone, or an empty
    table, gives no row.
    """
    named = F.when(F.length("role") > 0, F.col("role").cast("string")).otherwise(F.lit("unknown"))
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        _safe(named).alias("speaker"),
        _safe(whole_text()).alias("text"),
        F.coalesce(F.floor(F.col("turn") / segment), F.lit(0)).cast("long").alias("segment"),
    )
    speakers = rows.where(F.col("speaker") != narrator).select(F.col("conv_id").alias("own_conv"), F.col("speaker").alias("perspective")).distinct()
    place = Window.partitionBy("conv_id", "segment").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text")
    message = F.struct(F.col("place"), "speaker", "text")
    segments = (
        rows.withColumn("place", F.row_number().over(place) - 1)
        .withColumn("part", F.floor(F.col("place") / segment).cast("long"))
        .groupBy("conv_id", "segment", "part")
        .agg(F.sort_array(F.collect_list(message)).alias("messages"))
    )
    seen = segments.join(speakers, F.col("conv_id").eqNullSafe(F.col("own_conv")))

    def head(m: Column) -> Column:
        role = (
            F.when(m["speaker"] == narrator, F.lit("system"))
            .when(m["speaker"] == F.col("perspective"), F.lit("assistant"))
            .otherwise(F.concat(F.lit("user name="), m["speaker"]))
        )
        return F.concat(F.lit(OPEN), role, F.lit(CLOSE + "\n"))

    def rendered(m: Column) -> Column:
        body = F.concat(m["text"], F.lit(END))
        return F.struct(
            F.concat(head(m), body, F.lit("\n")).alias("piece"),
            F.char_length(head(m)).alias("before"),
            F.char_length(body).alias("size"),
            (m["speaker"] == F.col("perspective")).alias("own"),
        )

    # one row after the other holds the pieces as a column, so that they are rendered once
    pieces = seen.select("conv_id", "perspective", "segment", "part", F.explode(F.array(F.transform("messages", rendered))).alias("pieces"))

    def span(x: Column, i: Column) -> Column:
        earlier = F.aggregate(F.slice("pieces", 1, i), F.lit(0), lambda a, y: a + F.char_length(y["piece"]))
        return F.when(x["own"], F.concat_ws(":", earlier + x["before"], earlier + x["before"] + x["size"]))

    return pieces.select(
        "conv_id",
        "perspective",
        "segment",
        "part",
        F.size("pieces").cast("long").alias("n_turns"),
        F.array_join(F.transform("pieces", lambda x: x["piece"]), "").alias("rendered"),
        F.array_join(F.transform("pieces", span), ",").alias("mask"),
    )
