"""Chat formatting by perspective rotation: every participant of a dialogue in turn is the assistant.

A dialogue is rendered once for each participant: that speaker's turns as the assistant's, all others' as those of named users,
and the mask covers what the assistant says. Long dialogues come in parts of ``PART`` turns, so no conversation, however long, is
ever gathered in one row or task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = 256
_SPANS = "array<struct<start:bigint,stop:bigint>>"


def _positions(turns: DataFrame) -> DataFrame:
    """conv_id, turn, speaker, text, pos: the place of a turn in its dialogue.

    Rows of one turn number are told apart first, by speaker and text; the counts of turn numbers, a row for each, are then
    summed along the dialogue. No window holds a dialogue's texts.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("unknown")).alias("speaker"), F.coalesce("text", F.lit("")).alias("text"))
    within = rows.withColumn("rn", F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("speaker", "text")))
    counts = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    before = counts.withColumn("base", F.coalesce(F.sum("n").over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "base")
    return within.join(before, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))).select("conv_id", "turn", "speaker", "text", (F.col("base") + F.col("rn") - 1).alias("pos"))


def _head(me: Column, speaker: Column) -> Column:
    return F.when(speaker == me, F.lit("<|assistant|>\n")).when(speaker == "system", F.lit("<|system|>\n")).otherwise(F.concat(F.lit("<|user name="), speaker, F.lit("|>\n")))


def perspectives(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) to one row for each dialogue, participant and part: conv_id, perspective, part, n_turns, text,
    mask (start:stop in code points of the part, stops exclusive, joined by commas), n_masked.

    Participants are all speakers but ``system``, whose turns every rendering shows as the system's. The mask covers what the
    assistant says and the mark that ends it. Defined results: null role is the speaker ``unknown``, null text empty, null turn
    before all others, and null conv_id a dialogue of its own; turns with one number follow by speaker and text; repeated rows
    are repeated turns; a dialogue without participants gives no row, an empty table none; extra columns are ignored.
    """
    placed = _positions(turns)
    gathered = placed.groupBy("conv_id", F.floor(F.col("pos") / PART).alias("part")).agg(F.array_sort(F.collect_list(F.struct("pos", "speaker", "text"))).alias("turns"))
    me = placed.where("speaker <> 'system'").select(F.col("conv_id").alias("_c"), F.col("speaker").alias("perspective")).distinct()
    both = gathered.join(me, F.col("conv_id").eqNullSafe(F.col("_c")))
    end = "<|end|>\n"
    p = F.col("perspective")
    text = F.array_join(F.transform("turns", lambda t: F.concat(_head(p, t["speaker"]), t["text"], F.lit(end))), "")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        begin = acc["at"] + F.length(_head(p, t["speaker"]))
        stop = begin + F.length(t["text"]) + len(end)
        span = F.struct(begin.cast("long").alias("start"), (stop - 1).cast("long").alias("stop"))
        return F.struct(stop.cast("long").alias("at"), F.when(t["speaker"] == p, F.concat(acc["spans"], F.array(span).cast(_SPANS))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate("turns", start, step, lambda a: a["spans"])
    out = both.select("conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), spans.alias("spans"))
    return out.select(
        "conv_id",
        "perspective",
        "part",
        "n_turns",
        "text",
        F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias("mask"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("n_masked"),
    )
