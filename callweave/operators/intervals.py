"""Interval joins between segments and speaker turns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET = "_bucket"


def _in_buckets(df: DataFrame, start: str, end: str, width: float) -> DataFrame:
    first, last = (F.floor(F.col(c) / F.lit(width)).cast("long") for c in (start, end))
    return df.withColumn("_first", first).withColumn(BUCKET, F.explode(F.sequence(first, F.greatest(first, last))))


def overlapping(left: DataFrame, right: DataFrame, width: float, bounds=("start", "end", "turn_start", "turn_end")) -> DataFrame:
    """All overlapping pairs per call.  Both sides are cut into time buckets so the join key is (call, bucket): a long
    or hot call spreads over many tasks.  A pair is reported in the one bucket where its later member begins."""
    ls, le, rs, re = bounds
    a = _in_buckets(left, ls, le, width).withColumnRenamed("_first", "_lf")
    b = _in_buckets(right, rs, re, width).withColumnRenamed("_first", "_rf")
    meet = (F.col(ls) < F.col(re)) & (F.col(rs) < F.col(le)) & (F.col(BUCKET) == F.greatest("_lf", "_rf"))
    return a.join(b, ["call_id", BUCKET]).where(meet).drop(BUCKET, "_lf", "_rf")


def assign_speakers(segments: DataFrame, turns: DataFrame, width: float) -> DataFrame:
    """Gives every segment the speaker of the turn it overlaps longest; ties and no overlap go to the earliest turn,
    calls without turns to ``UNDIARIZED``.

    segments: call_id, seg_id, start, end.  turns: call_id, turn_id (list order), turn_start, turn_end, speaker_id."""
    shared = F.least("end", "turn_end") - F.greatest("start", "turn_start")
    pairs = overlapping(segments.select("call_id", "seg_id", "start", "end"), turns, width)
    best = pairs.groupBy("call_id", "seg_id").agg(
        F.max_by("speaker_id", F.struct(shared, -F.col("turn_id"))).alias("_best"),
        F.max(shared).alias("overlap"),
    )
    first = turns.groupBy("call_id").agg(
        F.min_by("speaker_id", "turn_id").alias("_first_speaker"), F.lit(True).alias("_known")
    )
    speaker = F.when(F.col("_known").isNull(), "UNDIARIZED").otherwise(
        F.coalesce(F.nullif(F.coalesce("_best", "_first_speaker"), F.lit("")), F.lit("SPEAKER_00"))
    )
    return (
        segments.join(best, ["call_id", "seg_id"], "left")
        .join(first, "call_id", "left")
        .withColumn("speaker_id", speaker)
        .withColumn("overlap", F.coalesce("overlap", F.lit(0)))
        .drop("_best", "_first_speaker", "_known")
    )
