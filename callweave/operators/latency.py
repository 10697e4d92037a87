"""Chunk timing: per-call rollups, real-time factors, service level, cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv


def chunk_rollup(chunks: DataFrame) -> DataFrame:
    """Per call: total, last and slowest chunk time, chunk count, and whether every chunk beat real time."""
    return chunks.groupBy("call_id").agg(
        F.sum("proc_time_sec").alias("asr_sec"),
        F.max_by("proc_time_sec", "chunk_idx").alias("last_chunk_sec"),
        F.max("proc_time_sec").alias("max_chunk_sec"),
        F.sum("duration_sec").alias("audio_sec"),
        F.count(F.lit(1)).alias("chunk_count"),
        F.bool_and(F.col("proc_time_sec") < F.col("duration_sec")).alias("queue_drained"),
    )


def factor(seconds: Column, audio: Column) -> Column:
    """Processing seconds per audio second."""
    return F.round(seconds.cast("double") / F.greatest(F.lit(0.001), audio.cast("double")), 4)


def call_metrics(rollup: DataFrame, allowance: float = fv.PUBLISH_ALLOWANCE_SEC, sla: float = fv.SLA_SEC) -> DataFrame:
    """Adds factors, post-call latency and the service-level verdict.  Needs diar_sec and resolve_sec."""
    asr, diar, audio = F.col("asr_sec"), F.col("diar_sec"), F.col("audio_sec")
    latency = F.col("last_chunk_sec") + diar + F.col("resolve_sec") + F.lit(str(allowance)).cast("decimal(10,3)")
    return rollup.select(
        "*",
        factor(asr, audio).alias("asr_rtf"),
        factor(diar, audio).alias("diar_rtf"),
        factor(asr + diar, audio).alias("total_rtf"),
        latency.cast("double").alias("post_call_latency_sec"),
        F.when(F.col("queue_drained") & (latency <= sla), "PASS").otherwise("FAIL").alias("sla_status"),
    )


def spread(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per measure: min, max, mean (exact decimal sums)."""
    entries = [
        F.struct(
            F.lit(c).alias("measure"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"),
            (F.sum(F.col(c).cast("decimal(28,6)")).cast("double") / F.count(c)).alias("mean"),
            F.sum(F.col(c).cast("decimal(28,6)")).cast("double").alias("total"),
        )
        for c in columns
    ]
    return rows.agg(F.array(*entries).alias("_m")).select(F.inline("_m"))


def cost_per_audio_hour(rollup: DataFrame, prices: DataFrame, hours: float = 2000.0) -> DataFrame:
    """Compute seconds and dollars per audio hour and for ``hours`` audio hours, per machine type.

    rollup: asr_sec and audio_sec per call.  prices: machine, dollars_per_hour, slowdown."""
    load = rollup.agg(F.sum("asr_sec").cast("double") / (F.sum("audio_sec").cast("double") / 3600.0)).scalar()
    per_hour = F.round(load * F.col("slowdown"), 1)
    dollars = F.round(per_hour / 3600.0 * F.col("dollars_per_hour"), 4)
    return prices.select(
        "machine", per_hour.alias("sec_per_audio_hour"), dollars.alias("dollars_per_audio_hour"),
        F.round(dollars * hours, 2).alias("dollars_per_year"),
    )


def project_runtime(rollup: DataFrame, audio_sec: Column) -> DataFrame:
    """Corpus run time at the observed real-time factor."""
    rtf = F.sum("asr_sec").cast("double") / F.greatest(F.lit(0.001), F.sum("audio_sec").cast("double"))
    return rollup.agg(rtf.alias("rtf"), audio_sec.alias("corpus_sec")).select(
        "rtf", "corpus_sec", (F.col("corpus_sec") * F.col("rtf")).alias("projected_sec"),
        (F.col("corpus_sec") * F.col("rtf") / 3600.0).alias("projected_hours"),
    )


def pooled_and_macro(rows: DataFrame, keys: list[str], part: str, whole: str) -> DataFrame:
    """Ratio of sums next to the mean of ratios."""
    ratio = (F.col(part).cast("double") / F.col(whole).cast("double")).cast("decimal(28,12)")
    return rows.groupBy(*keys).agg(
        (F.sum(part).cast("double") / F.sum(whole).cast("double")).alias("pooled"),
        (F.sum(ratio).cast("double") / F.count(ratio)).alias("macro"),
    )
