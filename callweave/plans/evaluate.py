"""Scoring composites: error rates, entity recall, alignment tables, version and engine comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import editdist as ed, entities as ent, text as tx
from callweave.operators import segments as seg
from callweave.operators.ordered import first_rows, neighbour, running, slice_by, spread
from callweave.operators.piecewise import edit_scripts

CALL = ["call_id"]


def percent(rate: Column) -> Column:
    return rate * 100.0


def call_scores(reference: DataFrame, hypothesis: DataFrame) -> DataFrame:
    """Raw and normalised word and character error rates (percent) per call.  reference / hypothesis: call_id, text."""
    pairs = reference.select("call_id", F.col("text").alias("_r")).join(
        hypothesis.select("call_id", F.col("text").alias("_h")), "call_id")
    pairs = spread(pairs, "call_id").select(
        "call_id",
        tx.raw_clean(F.col("_r"), True).alias("_rr"), tx.raw_clean(F.col("_h")).alias("_rh"),
        tx.normalize(F.col("_r"), True).alias("_nr"), tx.normalize(F.col("_h")).alias("_nh"),
    )
    pairs = pairs.select(
        "call_id", ed.text_distances(F.col("_rr"), F.col("_rh")).alias("raw"), ed.text_distances(F.col("_nr"), F.col("_nh")).alias("norm"))
    (raw_wer, raw_cer), (norm_wer, norm_cer) = ed.rates(F.col("raw")), ed.rates(F.col("norm"))
    return pairs.select(
        "call_id", percent(raw_wer).alias("raw_wer"), percent(norm_wer).alias("norm_wer"),
        percent(raw_cer).alias("raw_cer"), percent(norm_cer).alias("norm_cer"))


def normal_wer(reference: DataFrame, hypothesis: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Normalised word error rate (percent) per key; 0 where the reference has no words."""
    pairs = reference.select(*keys, F.col("text").alias("_r")).join(hypothesis.select(*keys, F.col("text").alias("_h")), keys, "left")
    pairs = spread(pairs, *keys).select(*keys, ed.text_distances(
        tx.normalize(F.col("_r"), True), tx.normalize(F.col("_h")), chars=False).alias("_d"))
    rate = F.when(F.col("_d.ref_words") == 0, 0.0).otherwise(percent(ed.rates(F.col("_d"))[0]))
    return pairs.select(*keys, rate.alias(name))


def section_scores(reference: DataFrame, labelled: DataFrame) -> DataFrame:
    """Word error rate of remarks and questions and their difference."""
    remarks, questions = tx.split_reference(F.col("text"))
    ref = reference.select("call_id", F.explode(F.array(
        F.struct(F.lit("remarks").alias("part"), remarks.alias("text")),
        F.struct(F.lit("qa").alias("part"), questions.alias("text")))).alias("_p")).select("call_id", "_p.*")
    part = F.when(F.col("section") == "qa", "qa").otherwise("remarks")
    hyp = seg.assemble_text(labelled.withColumn("part", part), ["call_id", "part"])
    rates = normal_wer(ref, hyp, ["call_id", "part"], "wer")
    wide = rates.groupBy("call_id").agg(
        F.max(F.when(F.col("part") == "remarks", F.col("wer"))).alias("remarks_wer"),
        F.max(F.when(F.col("part") == "qa", F.col("wer"))).alias("qa_wer"))
    return wide.withColumn("delta", F.col("qa_wer") - F.col("remarks_wer"))


def without_operator(reference: DataFrame, segments: DataFrame) -> DataFrame:
    """Word error rate with and without the operator's segments."""
    every = normal_wer(reference, seg.assemble_text(segments, CALL), CALL, "norm_wer")
    speech = normal_wer(reference, seg.assemble_text(seg.speech_only(segments), CALL), CALL, "non_operator_wer")
    return every.join(speech, "call_id").withColumn("reduction", F.col("norm_wer") - F.col("non_operator_wer"))


def entity_matches(reference: DataFrame, hypothesis: DataFrame, keys: list[str], **lists) -> DataFrame:
    """Count-limited entity matches; the reference's speaker headers are dropped first."""
    spoken = spread(reference, *keys).select(*keys, tx.drop_headers(F.col("text")).alias("text"))
    found = spoken.select(*keys, ent.entities_6(F.col("text"), **lists).alias("entities"))
    # Both sides do their text work before the join, on the spread rows.
    ref = found.select(*keys, ent.normal_counts(F.col("entities")).alias("counts"))
    hyp = spread(hypothesis, *keys).select(*keys, tx.normalize(F.col("text")).alias("hyp_norm"))
    return ent.limited_matches(ref.join(hyp, keys), keys)


def total_recall(matches: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Recall over all classes but tickers."""
    rows = ent.recall(matches.where(F.col("class") != "tickers"), keys)
    return rows.select(*keys, F.coalesce("recall_pct", F.lit(0.0)).alias(name))


def compare_versions(reference: DataFrame, new: DataFrame, old: DataFrame) -> DataFrame:
    """Missing seconds, error rates and recall of two transcript versions; an absent old version counts as 0.
    new / old: segments with call_id, idx, start, end, text, n_words."""
    def side(segments: DataFrame, tag: str) -> DataFrame:
        text = seg.assemble_text(segments, CALL)
        scores = call_scores(reference, text).select("call_id", F.col("norm_wer").alias(f"{tag}_wer"), F.col("norm_cer").alias(f"{tag}_cer"))
        gaps = seg.gap_stats(segments).select("call_id", F.col("missing_sec").alias(f"{tag}_missing_sec"))
        recall = total_recall(entity_matches(reference, text, CALL), CALL, f"{tag}_recall")
        return scores.join(gaps, "call_id", "left").join(recall, "call_id", "left")

    joined = side(new, "new").join(side(old, "old"), "call_id", "left")
    return joined.select("call_id", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in joined.columns if c != "call_id"])


def engine_scores(outputs: DataFrame, clips: DataFrame, keys: list[str]) -> DataFrame:
    """Scores of every engine output; null where the clip has no reference.  outputs: keys, clip, text; clips: clip, text."""
    # Both sides do their text work before the join, on the spread rows: a reference is normalised once for all engines.
    said = spread(outputs, "clip").select(*keys, "clip", tx.normalize(F.col("text")).alias("_nh"))
    right = spread(clips.where(F.col("text").isNotNull()), "clip").select("clip", tx.normalize(F.col("text"), True).alias("_nr"))
    pairs = said.join(right, "clip", "left").select(*keys, "clip", ed.text_distances(F.col("_nr"), F.col("_nh")).alias("_d"))
    wer, cer = ed.rates(F.col("_d"))
    scored = F.col("_d.ref_words").isNotNull()
    return pairs.select(*keys, "clip", F.when(scored, percent(wer)).alias("wer_pct"), F.when(scored, percent(cer)).alias("cer_pct"))


# --- alignment tables --------------------------------------------------------------------------------------------

def scripts(pairs: DataFrame) -> DataFrame:
    """pairs: call_id, ref words, hyp words -> one row per edit-script entry with its words."""
    return edit_scripts(pairs.select("call_id", "ref", "hyp"))


def substitutions(ops: DataFrame, limit: int = 20) -> DataFrame:
    """Most frequent replaced phrases per call with the context of the first one; ties by first appearance."""
    rows = ops.where(F.col("tag") == "replace").groupBy(
        "call_id", F.array_join("ref_words", " ").alias("ref_phrase"), F.array_join("hyp_words", " ").alias("hyp_phrase")
    ).agg(F.count(F.lit(1)).alias("n"), F.min_by("context", "op_no").alias("context"), F.min("op_no").alias("first_op"))
    return first_rows(rows, CALL, [F.desc("n"), F.asc("first_op")], limit)


def diff_blocks(ops: DataFrame, word_segments: DataFrame) -> DataFrame:
    """Edit-script entries grouped while they begin in the same hypothesis segment.
    word_segments: call_id, j (word position), seg_idx."""
    last = word_segments.groupBy("call_id").agg(F.max("seg_idx").alias("_last"))
    rows = (
        ops.join(word_segments.withColumnRenamed("j", "j1"), ["call_id", "j1"], "left").join(last, "call_id", "left")
        .withColumn("seg_idx", F.coalesce("seg_idx", "_last"))
    )
    rows = neighbour(slice_by(rows, "op_no"), CALL, ["op_no"], {"_prev": F.col("seg_idx"), "_seen": F.lit(True)}, ahead=False)
    opens = F.when(F.col("_seen").isNull() | ~F.col("seg_idx").eqNullSafe(F.col("_prev")), 1).otherwise(0)
    rows = running(rows, CALL, ["op_no"], {"block_no": ("sum", opens)})
    gather = lambda c: F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("op_no", c))), lambda x: x[c]))
    return rows.groupBy("call_id", "block_no").agg(
        F.min("seg_idx").alias("seg_idx"), F.count(F.lit(1)).alias("n_ops"), F.count_if(F.col("tag") != "equal").alias("n_changes"),
        F.array_join(gather("ref_words"), " ").alias("ref_text"), F.array_join(gather("hyp_words"), " ").alias("hyp_text"))


def matched_words(ops: DataFrame) -> DataFrame:
    """(call_id, i, j) of every word pair in an equal run."""
    return ops.where(F.col("tag") == "equal").select(
        "call_id", "j1", "i1", F.posexplode(F.sequence(F.col("i1"), F.col("i2") - 1)).alias("_k", "i")
    ).select("call_id", "i", (F.col("j1") + F.col("_k")).alias("j"))


def name_accuracy(matched: DataFrame, executives: Column) -> DataFrame:
    """Share of matched words with the right speaker name, overall and per speaker class.
    matched: call_id, ref_name, hyp_name."""
    ref, hyp = F.col("ref_name"), F.coalesce("hyp_name", F.lit("Unknown"))
    low = lambda c: F.lower(F.trim(c))
    hit = (low(ref) == low(hyp)) | (F.lower(ref).contains("operator") & F.lower(hyp).contains("operator"))
    kind = F.when(executives, "exec").when(ref.contains("OPERATOR"), "operator").otherwise("analyst")
    rows = matched.select("call_id", hit.alias("_hit"), kind.alias("_kind"), hyp.isin("Unknown", "UNKNOWN", "").alias("_unk"))
    share = lambda good, base: F.when(F.count_if(base) > 0, F.count_if(good & base) / F.count_if(base) * 100.0).otherwise(0.0)
    yes = F.lit(True)
    return rows.groupBy("call_id").agg(
        F.count(F.lit(1)).alias("total_words"), F.count_if("_hit").alias("correct_words"),
        share(F.col("_hit"), yes).alias("overall_acc"),
        *[share(F.col("_hit"), F.col("_kind") == k).alias(f"{k}_acc") for k in ("exec", "analyst", "operator")],
        share(F.col("_unk"), yes).alias("unknown_pct"))
