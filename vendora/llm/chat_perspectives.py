"""Multi-party chat rendered once from every participant's side.

Whoever takes part in a conversation (system turns are nobody's) is the assistant of
one rendering; all others are users with their names, and system turns open as
system.  The result has one row for each turn and side: the segment of the rendered
dialogue, where it begins and ends in it (in characters), and the part of it that
is trained on, which is what the assistant of that side says, with the end mark.
Segments in order of ``position`` make up the dialogue; none is ever built whole, so
a conversation may be as long as it likes.

Positions and offsets are running sums within a conversation and side, taken by
slices (``vendora.functions.grouping.running``), so that one conversation may hold a
third of all turns.  The sides of a conversation are its different speakers; a
turn is repeated once for each, as the result requires.

Order is by turn, then speaker, then text; null turns come last.  Rows equal in all of these stand in
the order of the table read, so that copies of one turn lie in several slices too, however many
they are; ``turns`` should be a stored table, which gives them the same places when a task is run
again.  Defined results: a null speaker is named ``unknown``; a null text is empty; turns of a null conversation
are one conversation; repeated rows are rendered each; a conversation of system
turns only has no sides and no rows; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendora.functions.grouping import running

START, END = "<|im_start|>", "<|im_end|>\n"
SYSTEM = "system"
UNKNOWN = "unknown"


def rotate(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text"
) -> DataFrame:
    """Rows ``(conv, side, position, turn, role, name, segment, begins, ends, mask_begins, mask_ends)``."""
    given = turns.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(speaker).cast("string"), F.lit(UNKNOWN)).alias("name"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("place"),
    )
    # One row for each speaker of a conversation, however many turns they have.
    sides = given.filter(F.col("name") != SYSTEM).select(F.col("conv").alias("in_conv"), F.col("name").alias("side")).distinct()
    seen = given.join(sides, F.col("conv").eqNullSafe(F.col("in_conv"))).drop("in_conv")
    role = (
        F.when(F.col("name") == SYSTEM, SYSTEM).when(F.col("name") == F.col("side"), "assistant").otherwise("user")
    )
    seen = seen.withColumn("role", role)
    head = F.concat(
        F.lit(START), "role", F.when(F.col("role") == "user", F.concat(F.lit(" name="), "name")).otherwise(""), F.lit("\n")
    )
    seen = seen.withColumn("segment", F.concat(head, "text", F.lit(END)))
    order = [F.col("turn").asc_nulls_last(), F.col("name").asc(), F.col("text").asc(), F.col("place").asc()]
    placed = running(seen, ["conv", "side"], order, {"position": F.lit(1), "begins": F.length("segment")})
    ends = F.col("begins") + F.length("segment")
    trained = F.col("role") == "assistant"
    return placed.select(
        F.col("conv").alias(conv),
        "side",
        "position",
        F.col("turn").alias(turn),
        "role",
        F.when(F.col("role") == "user", F.col("name")).alias("name"),
        "segment",
        "begins",
        ends.alias("ends"),
        F.when(trained, ends - F.length("text") - len(END)).alias("mask_begins"),
        F.when(trained, ends - 1).alias("mask_ends"),
    )
