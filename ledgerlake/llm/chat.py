"""Multi-party perspective rotation: a dialogue rendered once for each of its participants.

In the rendering for participant p, p's turns are the assistant's, every other participant's are
named users', and system turns (they speak for no participant) stay system turns.  A rendering
consists of segments, one per turn, in the order of ``position``:

    <|im_start|>assistant\\n{text}<|im_end|>\\n
    <|im_start|>user name={speaker}\\n{text}<|im_end|>\\n
    <|im_start|>system\\n{text}<|im_end|>\\n

The mask says which code points of a segment are trained on: text and end marker of p's own turns
([mask_start, mask_end)), nothing of the others.  ``start`` is the segment's offset in the whole
rendering.  Segments are rows, not one string per dialogue, so a dialogue that holds a third of all
turns is still dealt over many tasks: positions and offsets are running sums within slices of
consecutive turns, to which the totals of the slices before are added.

Markers that occur in a text or a speaker's name are escaped with a zero-width joiner after their
first character, so a text cannot open or close a turn.

Only DataFrame functions are used.

Defined cases: a null text is empty; a null conversation id is a conversation of its own kind
(all such rows together); a null or empty speaker is the participant ``unknown``; turns are
ordered by turn (nulls first), then speaker, then text; repeated rows are repeated turns; a
dialogue of system turns only has no participant and no rows; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def escaped(c: Column) -> Column:
    return F.replace(c, F.lit("<|im_"), F.lit("<\u200d|im_"))


def _turns(talk: DataFrame, conv_col: str, turn_col: str, speaker_col: str, text_col: str, system: str) -> DataFrame:
    speaker = F.coalesce(F.nullif(F.col(speaker_col).cast("string"), F.lit("")), F.lit("unknown"))
    return talk.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                       speaker.alias("speaker"), escaped(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("text"),
                       (speaker == system).alias("system"))


def participants(turns: DataFrame) -> DataFrame:
    return turns.filter(~F.col("system")).select("conv_id", F.col("speaker").alias("perspective")).distinct()


def rotate(talk: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", system: str = "system", slice_turns: int = 256) -> DataFrame:
    """(conv_id, perspective, position, turn, segment, start, mask_start, mask_end) per turn and participant.

    slice_turns is the number of consecutive turn numbers in a slice.
    """
    turns = _turns(talk, conv_col, turn_col, speaker_col, text_col, system).withColumn(
        "slice", F.coalesce(F.expr(f"turn div {slice_turns}"), F.lit(-2**62)))  # nulls come first
    who = participants(turns).withColumnRenamed("conv_id", "c")
    each = turns.join(who, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    mine = ~F.col("system") & (F.col("speaker") == F.col("perspective"))
    head = F.concat(F.lit(OPEN), F.when(F.col("system"), F.lit("system")).when(mine, F.lit("assistant"))
                    .otherwise(F.concat(F.lit("user name="), F.regexp_replace(escaped(F.col("speaker")), r"[\r\n]", " "))), F.lit("\n"))
    each = each.withColumn("mine", mine).withColumn("head", F.length(head)).withColumn(
        "segment", F.concat(head, F.col("text"), F.lit(CLOSE), F.lit("\n"))).withColumn("size", F.length("segment").cast("long"))

    # totals of the slices before, from one row per slice
    dialogue = ["conv_id", "perspective"]
    before = Window.partitionBy(*dialogue).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = (each.groupBy(*dialogue, "slice").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("length"))
              .select(F.col("conv_id").alias("c"), F.col("perspective").alias("p"), F.col("slice").alias("s"),
                      F.coalesce(F.sum("n").over(before), F.lit(0)).alias("turns_before"),
                      F.coalesce(F.sum("length").over(before), F.lit(0)).alias("chars_before")))
    inside = Window.partitionBy(*dialogue, "slice").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text")
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (each.withColumn("nth", F.row_number().over(inside)).withColumn("until", F.sum("size").over(so_far))
              .join(slices, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("perspective") == F.col("p")) & (F.col("slice") == F.col("s"))))
    return placed.select(
        "conv_id", "perspective", (F.col("turns_before") + F.col("nth") - 1).alias("position"), "turn", "segment",
        (F.col("chars_before") + F.col("until") - F.col("size")).alias("start"),
        F.when(F.col("mine"), F.col("head")).otherwise(0).cast("long").alias("mask_start"),
        F.when(F.col("mine"), F.col("size") - 1).otherwise(0).cast("long").alias("mask_end"))
