"""Validation rules as relational checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators.matching import containing
from callweave.operators.ordered import first_rows

ROOT = ["event_id", "ticker", "fiscal_period", "call_datetime_utc", "language", "sections"]
SEGMENT = ["start", "end", "speaker_id", "speaker_name", "speaker_role", "text"]
SECTIONS = ["operator_intro", "prepared_remarks", "qa"]


def document_errors(docs: DataFrame, key: str, sections: list[str] = SECTIONS, absent_is_null: bool = True) -> DataFrame:
    """One row per broken rule: (key, rule, detail).  Root fields present, required sections there, segment fields present,
    start not after end."""
    errors = [F.when(F.col(f).isNull(), F.struct(F.lit("root_field").alias("rule"), F.lit(f).alias("detail"))) for f in ROOT]
    kinds = F.transform(F.coalesce("sections", F.array().cast(dict(docs.dtypes)["sections"])), lambda s: s["type"])
    errors += [F.when(~F.array_contains(kinds, s), F.struct(F.lit("section").alias("rule"), F.lit(s).alias("detail"))) for s in sections]
    by_doc = docs.select(key, F.inline(F.filter(F.array(*errors), lambda e: e.isNotNull())))
    segs = docs.select(key, F.explode("sections").alias("_s")).select(key, F.posexplode("_s.segments").alias("pos", "g"))
    # speaker_name may be null by design; its absence shows only as a missing key, which a fixed schema cannot tell apart.
    found = [F.when(F.col(f"g.{f}").isNull(), F.struct(F.lit("segment_field").alias("rule"), F.lit(f).alias("detail")))
             for f in SEGMENT if f != "speaker_name"]
    found.append(F.when(F.col("g.start") > F.col("g.end"), F.struct(F.lit("time_order").alias("rule"), F.lit("start > end").alias("detail"))))
    by_seg = segs.select(key, F.inline(F.filter(F.array(*found), lambda e: e.isNotNull())))
    return by_doc.unionByName(by_seg)


def absent_fields(raw: Column, fields: list[str]) -> Column:
    """Required keys a raw JSON object lacks (a null value counts as present)."""
    return F.array_except(F.array(*[F.lit(f) for f in fields]), F.json_object_keys(raw))


def error_summary(errors: DataFrame, key: str, samples: int = 5) -> DataFrame:
    """Count per rule with the first few examples."""
    counts = errors.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    shown = first_rows(errors, ["rule"], [key, "detail"], samples).groupBy("rule").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.concat_ws(": ", F.col(key).cast("string"), "detail").alias("t")))),
                                 lambda x: x["t"]), "; ").alias("samples"))
    return counts.join(shown, "rule")


def phrase_presence(texts: DataFrame, key: str, text: str, phrases: DataFrame, shortest: int = 1) -> DataFrame:
    """Per phrase of ``phrases`` (phrase, required): how many texts hold it and whether the rule is kept."""
    found = containing(texts.select(key, text), [key], text, phrases.select("phrase").distinct(), "phrase", shortest)
    counts = found.groupBy("phrase").agg(F.count_distinct(key).alias("n_texts"))
    rows = phrases.join(counts, "phrase", "left").withColumn("n_texts", F.coalesce("n_texts", F.lit(0)))
    return rows.withColumn("ok", F.when(F.col("required"), F.col("n_texts") > 0).otherwise(F.col("n_texts") == 0))


def audio_standard(inventory: DataFrame, manifest_rows: Column, min_files: int, min_rows: int) -> DataFrame:
    """PASS when every file is 16 kHz mono 16 bit with sound and there are enough files and manifest rows."""
    good = F.coalesce(
        (F.col("sample_rate") == 16000) & (F.col("channels") == 1) & (F.col("bit_depth") == 16) & (F.col("duration_sec") > 0), F.lit(False))
    rows = inventory.agg(F.count(F.lit(1)).alias("total_files"), F.count_if(good).alias("valid_files")).withColumn("manifest_rows", manifest_rows)
    ok = (F.col("total_files") >= min_files) & (F.col("valid_files") == F.col("total_files")) & (F.col("manifest_rows") >= min_rows)
    return rows.withColumn("status", F.when(ok, "PASS").otherwise("FAIL"))


def checklist(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """Acceptance list: each check is a one-row frame with ``n_failed``; every status is derived."""
    out = None
    for name, frame in checks:
        row = frame.select(F.lit(name).alias("requirement"), F.when(F.col("n_failed") == 0, "PASS").otherwise("FAIL").alias("status"),
                           F.col("n_failed").cast("long").alias("n_failed"))
        out = row if out is None else out.unionByName(row)
    return out
