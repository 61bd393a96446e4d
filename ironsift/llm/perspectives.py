"""Chat formatting: every dialogue rendered once from each participant's view, with DataFrame functions only.

Method: multi-party perspective rotation. For each participant, their turns become the assistant's, all others
become named users, system turns stay; the loss mask covers what the participant says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SYSTEM = "system"
END = "<|end|>\n"


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, speaker, n_turns, n_target_turns, text, mask and n_target_chars of every dialogue and participant.

    A participant is a distinct role other than system. mask lists the half-open character ranges of text to learn,
    "start-end" joined by commas: what the speaker says and its end mark. Turns stand by turn number (nulls first), ties
    by role and text; repeated rows are repeated turns. A null text counts as empty; a null role is a user named
    unknown and no participant; turns of a null dialogue belong to none and aren't rendered. A dialogue with no
    participant has no row. Other columns are ignored. Each record is as long as its dialogue.
    """
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("body"))
    rows = rows.filter(F.col("conv_id").isNotNull())
    speakers = rows.filter(F.col("role").isNotNull() & (F.col("role") != SYSTEM)).select("conv_id", F.col("role").alias("speaker")).distinct()
    rows = rows.join(speakers, "conv_id")
    target = F.coalesce(F.col("role") == F.col("speaker"), F.lit(False))
    head = F.when(target, "<|assistant|>\n").when(F.col("role") == SYSTEM, "<|system|>\n").otherwise(F.concat(F.lit("<|user name="), F.coalesce("role", F.lit("unknown")), F.lit("|>\n")))
    rows = rows.withColumns({"target": target, "head": head}).withColumn("segment", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id", "speaker").orderBy("turn", "role", "body")
    rows = rows.withColumn("place", F.row_number().over(order))
    rows = rows.withColumn("end", F.sum(F.char_length("segment")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    start = F.col("end") - F.char_length("segment") + F.char_length("head")
    span = F.when(F.col("target"), F.concat_ws("-", start.cast("string"), F.col("end").cast("string")))
    out = rows.groupBy("conv_id", "speaker").agg(
        F.count("*").alias("n_turns"),
        F.count_if("target").alias("n_target_turns"),
        F.array_sort(F.collect_list(F.struct("place", "segment", span.alias("span")))).alias("parts"),
        F.sum(F.when(F.col("target"), F.col("end") - start).otherwise(0)).alias("n_target_chars"),
    )
    return out.select("conv_id", "speaker", "n_turns", "n_target_turns", F.array_join("parts.segment", "").alias("text"), F.array_join("parts.span", ",").alias("mask"), "n_target_chars")
