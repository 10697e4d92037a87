"""Sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators import relational as rel


def transcript_documents(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Nested documents from labelled, resolved segments: sections with their segments in call order, all segments, language.
    Segments are gathered per (call, section) first; a document is one row by nature."""
    entry = F.struct("start", "end", "speaker_id", "speaker_name", "speaker_role", "text", "confidence")
    by_section = segments.groupBy(*keys, "section").agg(
        F.round(F.min_by("start", "idx"), 2).alias("start"), F.round(F.max_by("end", "idx"), 2).alias("end"),
        F.min("idx").alias("_i"),
        F.transform(F.sort_array(F.collect_list(F.struct("idx", entry.alias("s")))), lambda x: x["s"]).alias("segments"))
    names = F.array(F.lit("operator_intro"), F.lit("prepared_remarks"), F.lit("qa"))
    docs = by_section.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("section", F.struct("start", "end", "segments")))).alias("_m"))
    def section(name: Column) -> Column:
        here = F.try_element_at("_m", name)
        empty = F.array().cast(dict(by_section.dtypes)["segments"])
        return F.struct(
            name.alias("type"), F.coalesce(here["start"], F.lit(0.0)).alias("start"), F.coalesce(here["end"], F.lit(0.0)).alias("end"),
            F.coalesce(here["segments"], empty).alias("segments"))

    docs = docs.withColumn("sections", F.transform(names, section)).drop("_m")
    return docs.withColumn("language", F.lit("en")).withColumn("segments", F.flatten(F.transform("sections", lambda s: s["segments"])))


def write_documents(docs: DataFrame, path: str, partition: str = "ticker") -> None:
    docs.write.mode("overwrite").partitionBy(partition).json(path)


def write_table(rows: DataFrame, name: str, bucket_by: str, buckets: int = 64) -> None:
    """Catalog table bucketed on its join key, so later joins on it need no shuffle."""
    rows.write.mode("overwrite").bucketBy(buckets, bucket_by).sortBy(bucket_by).saveAsTable(name)


def merge_into_path(changes: DataFrame, current_path: str | None, new_path: str, keys: list[str], version: Column) -> None:
    """Keyed upsert to a NEW path; readers switch paths, so a lost job never leaves half a table."""
    rows = changes
    if current_path is not None:
        rows = changes.sparkSession.read.parquet(current_path).unionByName(changes, allowMissingColumns=True)
    rel.pick_per_key(rows, keys, version, lowest=False).write.mode("errorifexists").parquet(new_path)


def write_report(lines: DataFrame, path: str) -> None:
    """Report lines as text."""
    lines.select("line").write.mode("overwrite").text(path)
