"""Dialogues as seen by each of their participants.

For every participant the dialogue is written once with that speaker as assistant and all
others as named users; only the assistant's words and their end marks are learned. A
dialogue is kept as its pieces in order, one row per turn, with the place of each piece in
the whole text, so that no dialogue has to fit into one row.

Places are running totals. Rows are range-partitioned by conversation and turn, totals of
each conversation are added up over partitions, and only within a partition row by row: a
conversation with a third of all turns spreads over a third of the partitions.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberwatch.llm.common import kept, sized

#: Fixed marks of the format.
BEGIN, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
UNKNOWN = "unknown"


def speaker(role):
    """Name of a speaker: the role, with anything but letters, digits and ``_.-`` as ``_``."""
    name = F.regexp_replace(F.coalesce(role, F.lit("")), "[^A-Za-z0-9_.-]", "_")
    return F.when(name == "", UNKNOWN).otherwise(name)


def _escaped(text):
    """Marks inside a text must not end or begin a turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def perspectives(turns):
    """One row per turn and participant of its conversation, from ``turns`` (conv_id, turn, role, text).

    Gives conv_id, perspective (the participant who is the assistant), position (from 0),
    turn, speaker, piece (the text of the turn with its marks), start and end of the piece in
    the whole dialogue, and learn_start and learn_end, the part of it that is learned (null
    in turns of others). Counted in code points, ends exclusive.

    Turns of the system are no participant's; a conversation of only such turns gives no
    rows. Roles that differ only in signs that names cannot have are one speaker; a null or
    empty role is ``unknown``. A null text is empty. Null turns come first, equal turns are
    ordered by speaker and text; repeated rows stay repeated. A null conv_id is one
    conversation. An empty table gives no rows; other columns are ignored.
    """
    rows = turns.select("conv_id", "turn", speaker(F.col("role")).alias("speaker"), _escaped(F.col("text")).alias("body"))
    rows = rows.withColumn("tie", F.xxhash64("body")).withColumn("copy", F.monotonically_increasing_id())
    order = ["turn", "speaker", "tie", "copy"]
    rows = kept(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()))
    casts = rows.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("cast_id"), F.col("speaker").alias("perspective")).distinct()
    seen = rows.join(sized(kept(casts)), F.col("conv_id").eqNullSafe(F.col("cast_id"))).drop("cast_id")
    own = F.col("speaker") == F.col("perspective")
    head = (
        F.when(F.col("speaker") == SYSTEM, F.lit(f"{BEGIN}{SYSTEM}\n"))
        .when(own, F.lit(f"{BEGIN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{BEGIN}user name="), "speaker", F.lit("\n")))
    )
    seen = seen.withColumn("head", head).withColumn("size", F.length("head") + F.length("body") + len(END) + 1)

    totals = seen.groupBy("conv_id", "perspective", "part").agg(F.sum("size").alias("chars"), F.count("*").alias("pieces"))
    earlier = Window.partitionBy("conv_id", "perspective").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("conv_id").alias("t_conv"),
        F.col("perspective").alias("t_perspective"),
        F.col("part").alias("t_part"),
        F.coalesce(F.sum("chars").over(earlier), F.lit(0)).alias("chars_before"),
        F.coalesce(F.sum("pieces").over(earlier), F.lit(0)).alias("pieces_before"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("t_conv")) & (F.col("perspective") == F.col("t_perspective")) & (F.col("part") == F.col("t_part"))
    placed = seen.join(sized(kept(totals)), same)
    within = Window.partitionBy("conv_id", "perspective", "part").orderBy(*order)
    start = F.col("chars_before") + F.coalesce(F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    position = F.col("pieces_before") + F.row_number().over(within) - 1
    placed = placed.withColumn("start", start.cast("long")).withColumn("position", position.cast("long"))
    learned = F.col("start") + F.length("head")
    return placed.select(
        "conv_id",
        "perspective",
        "position",
        "turn",
        "speaker",
        F.concat("head", "body", F.lit(f"{END}\n")).alias("piece"),
        "start",
        (F.col("start") + F.col("size")).alias("end"),
        F.when(own, learned).alias("learn_start"),
        F.when(own, learned + F.length("body") + len(END)).alias("learn_end"),
    )
