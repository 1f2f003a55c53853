"""Chat formatting by perspective rotation.

For every participant of a dialogue the dialogue is rendered once more: that
speaker's turns are the assistant's, the others' are a user's who is named,
system turns stay, and the mask says which characters are to be learned.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estatelens.llm.shared import cut, small_or_shuffled

#: Turn numbers that a rendered part spans at most: a row's size is bounded
#: whatever the dialogue's length.
PART_TURNS = 256
#: Rows a part holds at most; parts with more (turn numbers that repeat) are
#: cut into lanes, which are consecutive in the dialogue's order.
PART_ROWS = 4096
SYSTEM = "system"


def _laned(rows: DataFrame, part_rows: int) -> DataFrame:
    """``rows`` with ``lane``: the row's number in its part, in order of turn,
    role and text, divided by ``part_rows``.

    The rows are sorted over all tasks; a row's number is its place in its
    task plus the rows that earlier tasks hold of the part.  Equal rows may
    be split between tasks, by a number of their own."""
    order = [F.col(c) for c in ("conv_id", "part", "turn", "role", "text")]
    spread = rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*order, F.col("tie"))
    placed = cut(spread.sortWithinPartitions(*order, "tie").drop("tie").withColumn("at", F.monotonically_increasing_id())
                 .withColumn("task", F.shiftright("at", 33)))
    held = placed.groupBy("conv_id", "part", "task").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = F.sum("n").over(Window.partitionBy("conv_id", "part").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    start = cut(held.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.col("task").alias("t"),
                            (F.coalesce(earlier, F.lit(0)) - F.col("first")).alias("add")))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p")) & (F.col("task") == F.col("t"))
    return (placed.join(small_or_shuffled(start, 64), same)
            .withColumn("lane", F.floor((F.col("at") + F.col("add")) / part_rows).cast("long"))
            .drop("c", "p", "t", "add", "at", "task"))


def rotate(turns: DataFrame, part_turns: int = PART_TURNS, part_rows: int = PART_ROWS) -> DataFrame:
    """One row a dialogue, participant and part: conv_id, speaker, part,
    lane, n_turns, text, and ``mask``: (first, length) character ranges of ``text``
    to be learned, which are the speaker's words and the end marks.

    A turn is ``<|role|>`` and a line feed, for a user the name and a colon,
    the text, and ``<|end|>`` with a line feed.  Participants are the
    distinct roles of a dialogue but ``system``; a dialogue of system turns
    alone yields nothing.  Turns are in order of turn, role and text; null
    text is empty, a null role is the participant ``unknown``, a null turn
    counts as -1, and null conv_ids are one dialogue.  Repeated rows are
    rendered as often as they occur.  A part holds the turns of
    ``part_turns`` consecutive turn numbers, so long dialogues are split and
    nothing is dropped; one with more than ``part_rows`` rows is cut every
    ``part_rows`` rows, in order, into lanes, which are rows of their own.  Parts and lanes joined in order
    are the whole rendering.  Extra columns are ignored; an empty table gives
    an empty result.
    """
    role = F.coalesce(F.col("`role`").cast("string"), F.lit("unknown"))
    turn = F.coalesce(F.col("`turn`").cast("long"), F.lit(-1).cast("long"))
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    rows = turns.select(F.col("`conv_id`").alias("conv_id"), turn.alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("part", F.floor(F.col("turn") / part_turns))
    crowded = cut(rows.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_rows)
                  .select(F.col("conv_id").alias("c"), F.col("part").alias("p")))
    if crowded.count():
        keys = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))
        few = rows.join(small_or_shuffled(crowded, 64), keys, "left_anti").withColumn("lane", F.lit(0).cast("long"))
        rows = few.unionByName(_laned(rows.join(small_or_shuffled(crowded, 64), keys, "left_semi"), part_rows))
    else:
        rows = rows.withColumn("lane", F.lit(0).cast("long"))
    speakers = (rows.where(F.col("role") != SYSTEM).groupBy("conv_id", "role").agg(F.lit(1).alias("one"))
                .select(F.col("conv_id").alias("__conv"), F.col("role").alias("speaker")))
    pairs = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("__conv"))).drop("__conv")
    own = F.col("role") == F.col("speaker")
    head = F.when(own, F.lit("<|assistant|>\n")).when(F.col("role") == SYSTEM, F.lit("<|system|>\n")).otherwise(
        F.concat(F.lit("<|user|>\n"), F.col("role"), F.lit(": ")))
    end = F.lit("<|end|>")
    item = F.struct("turn", "role", "text", head.alias("head"), own.alias("own"))
    grouped = pairs.groupBy("conv_id", "speaker", "part", "lane").agg(F.array_sort(F.collect_list(item)).alias("items"))
    rendered = F.transform("items", lambda x: F.concat(x["head"], x["text"], end, F.lit("\n")))
    at = F.aggregate(
        "items", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<first:bigint,length:bigint>>").alias("mask")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["head"]) + F.length(x["text"]) + 8).alias("at"),
            F.when(x["own"], F.concat(s["mask"], F.array(F.struct(
                (s["at"] + F.length(x["head"])).alias("first"), (F.length(x["text"]) + 7).cast("long").alias("length")))))
            .otherwise(s["mask"]).alias("mask")))
    return grouped.select("conv_id", "speaker", "part", "lane", F.size("items").cast("long").alias("n_turns"),
                          F.array_join(rendered, "").alias("text"), at["mask"].alias("mask"))
