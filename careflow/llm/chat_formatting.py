"""Multi-party dialogues, rendered once for every participant's point of view; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from careflow.llm.shared import text_of

#: Turn numbers of one block. Places are summed within blocks and over blocks, so a long dialogue is not one group.
BLOCK = 1024

OWN_HEADER = "<|assistant|>\n"
OTHER_HEADER = "<|user name={}|>\n"
CLOSING = "<|end|>\n"


def rotate(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """Every dialogue from the point of view of each of its speakers, one row for each view and turn.

    In a view, the turns of its ``perspective`` are the assistant's and are learned; all others are named users and
    masked. ``rendered`` holds header, text and closing mark; put end to end by ``start_char`` the rows of a view
    are the rendered dialogue. ``learn_from`` and ``learn_to`` bound the learned characters (text and closing mark)
    in it and are null for masked turns. ``position`` counts a dialogue's turns from 0.

    Turns are ordered by number, speaker and text, null numbers first; turns that tie in all three are equal, so
    their order does not matter, and repeated rows are each rendered. A null role speaks as "unknown", a null text is
    empty, a null conv_id is a dialogue like others. Texts may have any length. Other columns of the input are left
    out. An empty table gives an empty result.
    """
    rows = turns.select(
        F.col("conv_id"), F.col("turn"), F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"), text_of().alias("_text"), F.floor(F.col("turn") / block).alias("_block")
    )
    views = rows.select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seen = rows.join(views, rows["conv_id"].eqNullSafe(views["_conv"]))
    own = F.col("speaker") == F.col("perspective")
    before, after = OTHER_HEADER.split("{}")
    header = F.when(own, F.lit(OWN_HEADER)).otherwise(F.concat(F.lit(before), "speaker", F.lit(after)))
    seen = seen.select("conv_id", "perspective", "_block", "turn", "speaker", "_text", own.alias("is_learned"), header.alias("_header"))
    seen = seen.withColumn("rendered", F.concat("_header", "_text", F.lit(CLOSING))).withColumn("_size", F.char_length("rendered").cast("long"))

    place = ("conv_id", "perspective", "_block")
    within = Window.partitionBy(*place).orderBy("turn", "speaker", "_text").rowsBetween(Window.unboundedPreceding, 0)
    placed = seen.withColumn("_end", F.sum("_size").over(within)).withColumn("_nth", F.count(F.lit(1)).over(within))
    blocks = seen.groupBy(*place).agg(F.sum("_size").alias("_chars"), F.count(F.lit(1)).alias("_turns"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("conv_id").alias("_c"), F.col("perspective").alias("_p"), F.col("_block").alias("_b"), F.coalesce(F.sum("_chars").over(earlier), F.lit(0)).alias("_chars_before"), F.coalesce(F.sum("_turns").over(earlier), F.lit(0)).alias("_turns_before")
    )
    joined = placed.join(blocks, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("perspective") == F.col("_p")) & F.col("_block").eqNullSafe(F.col("_b")))
    end = F.col("_chars_before") + F.col("_end")
    return joined.select(
        "conv_id",
        "perspective",
        (F.col("_turns_before") + F.col("_nth") - 1).alias("position"),
        "turn",
        "speaker",
        F.when(F.col("is_learned"), F.lit("assistant")).otherwise("user").alias("chat_role"),
        "rendered",
        (end - F.col("_size")).alias("start_char"),
        end.alias("end_char"),
        "is_learned",
        F.when(F.col("is_learned"), end - F.col("_size") + F.char_length("_header")).alias("learn_from"),
        F.when(F.col("is_learned"), end).alias("learn_to"),
    )
