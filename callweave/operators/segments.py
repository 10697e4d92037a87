"""Segment-level operators: gaps, sections, speaker runs, context, assembled text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv
from callweave.operators.ordered import SLICE, first_rows, neighbour, running, slice_by

CALL = ["call_id"]
SECTIONS = ["operator_intro", "prepared_remarks", "qa"]


def any_of(patterns: list[str]) -> str:
    """One case-insensitive alternation, so a text is scanned once per cue list."""
    return "(?i)(?:" + "|".join(patterns) + ")"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def with_next_gap(segments: DataFrame) -> DataFrame:
    """Seconds of silence to the next segment; null for the last one."""
    nxt = neighbour(slice_by(segments, "idx"), CALL, ["idx"], {"next_start": F.col("start")}, ahead=True)
    return nxt.withColumn("gap_sec", F.col("next_start") - F.col("end")).drop(SLICE)


def gap_stats(segments: DataFrame, long_gap: float = 10.0, slack: float = 0.5) -> DataFrame:
    """Per call: long gaps, missing seconds, overlapping starts, repeated neighbours of more than three words."""
    text = F.lower(stripped(F.col("text")))
    rows = neighbour(
        slice_by(segments.withColumn("_t", text), "idx"), CALL, ["idx"],
        {"_ns": F.col("start"), "_nt": F.col("_t")}, ahead=True,
    )
    gap = F.col("_ns") - F.col("end")
    long = gap > long_gap
    same = (F.col("_t") != "") & (F.col("_t") == F.col("_nt")) & (F.col("n_words") > 3)
    return rows.groupBy("call_id").agg(
        F.count_if(long).alias("gaps_count"),
        F.coalesce(F.sum(F.when(long, gap.cast("decimal(18,2)"))), F.lit(0)).cast("double").alias("missing_sec"),
        F.count_if(F.col("_ns") < F.col("end") - slack).alias("overlaps"),
        F.count_if(same).alias("duplicates"),
    )


def section_cues(
    role: str | None = "speaker_role",
    qa_cues: list[str] = fv.QA_CUES,
    disclaimers: list[str] = fv.QA_DISCLAIMER_CUES,
    remarks_cues: list[str] = fv.REMARKS_CUES,
) -> tuple[Column, Column]:
    """Whether a segment opens the Q&A, and whether it opens the prepared remarks: the rule of batch and stream."""
    text, idx = F.col("text"), F.col("idx")
    who = F.coalesce(F.col(role), F.lit("")) if role else F.lit("")
    cue = text.rlike(any_of(qa_cues)) & ~text.rlike(any_of(disclaimers)) & ((idx > 3) | (F.col("start") > 120.0))
    leader = who.isin("CEO", "CFO", "President") | who.rlike("Chief (Executive|Financial) Officer")
    host = who.isin("Operator", "IR") | who.contains("Investor Relations")
    return cue | who.rlike("^Analyst(,|$)"), (text.rlike(any_of(remarks_cues)) & (idx > 0)) | leader | ((idx >= 2) & ~host)


def label_sections(
    segments: DataFrame,
    role: str | None = "speaker_role",
    qa_cues: list[str] = fv.QA_CUES,
    disclaimers: list[str] = fv.QA_DISCLAIMER_CUES,
    remarks_cues: list[str] = fv.REMARKS_CUES,
) -> DataFrame:
    """Adds ``section``.  Sections only move forward, so two per-call minima (first Q&A row, first remarks row) decide
    every label: one map-side-combined aggregate, no per-call ordering."""
    idx = F.col("idx")
    opens_qa, opens_remarks = section_cues(role, qa_cues, disclaimers, remarks_cues)
    starts = segments.groupBy("call_id").agg(
        F.min(F.when(opens_qa, idx)).alias("_qa"), F.min(F.when(opens_remarks, idx)).alias("_remarks")
    )
    section = (
        F.when(idx >= F.col("_qa"), "qa").when(idx >= F.col("_remarks"), "prepared_remarks").otherwise("operator_intro")
    )
    return segments.join(starts, "call_id").withColumn("section", section).drop("_qa", "_remarks")


def section_totals(labelled: DataFrame) -> DataFrame:
    """Words, segments and spoken seconds per call and section."""
    return labelled.groupBy("call_id", "section").agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.sum("n_words").alias("n_words"),
        F.sum((F.col("end") - F.col("start")).cast("decimal(18,3)")).cast("double").alias("spoken_sec"),
    )


def section_counts(labelled: DataFrame) -> DataFrame:
    """One row per call: counts of all three sections as a map (zeros kept), Q&A count and its warning."""
    counts = [F.count_if(F.col("section") == s).alias(f"_{s}") for s in SECTIONS]
    entries = [x for s in SECTIONS for x in (F.lit(s), F.col(f"_{s}"))]
    return labelled.groupBy("call_id").agg(*counts).select(
        "call_id",
        F.create_map(*entries).alias("section_counts"),
        F.col("_qa").alias("qa_segments"),
        F.when(F.col("_qa") == 0, "NO_QA_DETECTED").alias("qa_warning"),
    )


def assemble_text(rows: DataFrame, keys: list[str], position: str = "idx", text: str = "text", sep: str = " ") -> DataFrame:
    """Texts of a group joined in order.  Slices are joined first, so a group's rows never meet in one task; its text, which is the result, does."""
    def ordered(pos: str, value: str) -> Column:
        return F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct(pos, value))), lambda x: x[value]), sep
        )

    pieces = slice_by(rows, position).groupBy(*keys, SLICE).agg(ordered(position, text).alias("_piece"))
    return pieces.groupBy(*keys).agg(ordered(SLICE, "_piece").alias(text))


def with_runs(segments: DataFrame, speaker: str = "speaker_id", max_gap: float | None = None) -> DataFrame:
    """Adds ``run_no``: consecutive rows of one speaker (optionally also closer than ``max_gap`` seconds)."""
    rows = neighbour(
        slice_by(segments, "idx"), CALL, ["idx"], {"_ps": F.col(speaker), "_pe": F.col("end")}, ahead=False
    )
    same = F.col(speaker).eqNullSafe(F.col("_ps"))
    if max_gap is not None:
        same = same & (F.abs(F.col("start") - F.col("_pe")) < max_gap)
    opens = F.when(F.coalesce(same & F.col("_pe").isNotNull(), F.lit(False)), 0).otherwise(1)
    return running(rows, CALL, ["idx"], {"run_no": ("sum", opens)}).drop("_ps", "_pe", SLICE)


def speaker_runs(segments: DataFrame, speaker: str = "speaker_id", max_gap: float | None = None) -> DataFrame:
    """One row per run with its extent."""
    return with_runs(segments, speaker, max_gap).groupBy("call_id", "run_no").agg(
        F.min(speaker).alias(speaker),
        F.min("idx").alias("first_idx"),
        F.max("idx").alias("last_idx"),
        F.count(F.lit(1)).alias("n_segments"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
    )


def next_other_speaker(segments: DataFrame, excluded: Column | None = None) -> DataFrame:
    """Adds ``next_speaker``: who speaks next after the current speaker, ``excluded`` rows (the operator) ignored.
    Only rows that are not excluded are returned."""
    rows = segments if excluded is None else segments.where(~F.coalesce(excluded, F.lit(False)))
    rows = with_runs(rows)
    runs = rows.groupBy("call_id", "run_no").agg(F.min("speaker_id").alias("_who"))
    after = neighbour(slice_by(runs, "run_no"), CALL, ["run_no"], {"next_speaker": F.col("_who")}, ahead=True)
    return rows.join(after.select("call_id", "run_no", "next_speaker"), ["call_id", "run_no"]).drop("run_no")


def top_speakers(segments: DataFrame, limit: int = 6) -> DataFrame:
    """Most frequent (speaker, name, role) per call; ties by first appearance."""
    names = [c for c in ("speaker_id", "speaker_name", "speaker_role") if c in segments.columns]
    counts = segments.groupBy("call_id", *names).agg(
        F.count(F.lit(1)).alias("n_segments"), F.min("idx").alias("first_idx")
    )
    return first_rows(counts, CALL, [F.desc("n_segments"), F.asc("first_idx")], limit)


def opening_text(segments: DataFrame, limit: int = 35) -> DataFrame:
    """Text of the first ``limit`` segments of a call (positions are dense from 0)."""
    return assemble_text(segments.where(F.col("idx") < limit), CALL)


def speech_only(segments: DataFrame, role: str = "speaker_role") -> DataFrame:
    """Drops the operator; rows without a role stay."""
    return segments.where(~F.col(role).eqNullSafe(F.lit("Operator")))
