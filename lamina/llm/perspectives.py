"""Dialogues rendered once for every participant: that speaker as assistant, all others as named users.

DataFrame functions only. A rendering is given message by message with its place in the whole, so that long dialogues
are never gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYSTEM, NAMELESS = "system", "unknown"
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
# Turns whose lengths are summed at once; a long dialogue is many blocks, and sums of blocks are summed.
BLOCK_TURNS = 256


def _head(role: Column, name: Column) -> Column:
    title = F.when(name.isNull(), role).otherwise(F.concat(role, F.lit(" name="), name))
    return F.concat(F.lit(BEGIN), title, F.lit("\n"))


def perspectives(turns: DataFrame) -> DataFrame:
    """(conv_id, perspective, turn, role, name, message, start, end, train_start, train_end), a row per message.

    `turns` is (conv_id, turn, role, text); the role is the speaker. Every speaker but the system has a rendering of the
    whole dialogue: own messages as `assistant`, the system's as `system`, all others as `user` with their name. start and
    end are code points in the rendering, which is the messages in order. Own messages are trained on, from the first
    character of the text through the end mark; elsewhere train_start and train_end are NULL.

    Messages are ordered by turn (NULL first), speaker and text; equal rows follow each other. A NULL speaker is `unknown`,
    a NULL text is empty, a NULL conv_id is a dialogue of its own. A dialogue of the system alone has no rendering. Other
    columns are not read; an empty table gives an empty one.
    """
    speaker = F.coalesce(F.col("role"), F.lit(NAMELESS))
    rows = turns.select("conv_id", "turn", speaker.alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    people = rows.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    name = F.when(~own & (F.col("speaker") != SYSTEM), F.col("speaker"))
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(None).cast("long"))
    shown = (
        rows.join(people, F.col("conv_id").eqNullSafe(F.col("of"))).withColumn("own", own).withColumn("role", role).withColumn("name", name)
        .withColumn("head", _head(F.col("role"), F.col("name")))
        .select("conv_id", "perspective", "turn", "speaker", "text", "own", "role", "name", block.alias("block"),
                F.concat("head", "text", F.lit(END)).alias("message"), F.length("head").cast("long").alias("lead"))
        .withColumn("size", F.length("message").cast("long"))
    )
    inside = Window.partitionBy("conv_id", "perspective", "block").orderBy("turn", "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    blocks = shown.groupBy("conv_id", "perspective", "block").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("block").alias("b"),
        F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & F.col("block").eqNullSafe(F.col("b"))
    placed = shown.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(blocks, same)
    start = F.col("before") + F.col("within")
    return placed.select(
        "conv_id", "perspective", "turn", "role", "name", "message", start.alias("start"), (start + F.col("size")).alias("end"),
        F.when(F.col("own"), start + F.col("lead")).alias("train_start"), F.when(F.col("own"), start + F.col("size")).alias("train_end"),
    )
