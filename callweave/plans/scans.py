"""Queries that write the tables in their file forms and read them back through the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave import schemas
from callweave.operators import segments as seg
from callweave.operators.ordered import spread
from callweave.plans.adapters import call_segments, table, with_tables
from callweave.plans.transcripts import SECTIONED
from callweave.sources import readers, writers
from callweave.streaming.live import scratch

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn
    return keep


@query("scan_csv_dimension", """
SELECT c_custkey AS company_id, trim(c_name) AS company_name, trim(c_name || ', "the" ' || c_mktsegment || chr(10) || 'second line') AS note
FROM customer WHERE c_custkey % 7 <> 0""")
def scan_csv_dimension(spark, folder):
    """Companies as a headed CSV with quotes, commas and line breaks inside a field; every seventh row lacks its key."""
    path = scratch(spark)
    rows = table(spark, folder, "customer").select(
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("company_id"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("company_name"),
        F.concat("c_name", F.lit(', "the" '), "c_mktsegment", F.lit("\nsecond line")).alias("note"))
    rows.write.csv(path, header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.csv_dimension(spark, path, "company_id long, company_name string, note string", "company_id")


@query("scan_quarantine", """
WITH m AS (SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 'unreadable' WHEN o_orderkey % 10 = 3 THEN 'no declared field' ELSE 'good' END AS kind FROM orders)
SELECT kind, count(*) AS n, CAST(sum(CASE WHEN kind = 'good' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS audio_sec,
  count(DISTINCT CASE WHEN kind = 'good' THEN o_custkey END) AS tickers FROM m GROUP BY kind""")
def scan_quarantine(spark, folder):
    """Call metrics as JSON lines, some cut off in the middle and some of another kind: the good ones go on, the others are told why not."""
    path = scratch(spark)
    whole = F.to_json(F.struct(F.col("o_custkey").cast("string").alias("ticker"), F.lit("Q1 FY2026").alias("fiscal_period"), F.col("o_totalprice").cast("double").alias("audio_duration_sec")))
    line = F.when(F.col("o_orderstatus") == "P", F.substring(whole, F.lit(1), F.length(whole) - 9)).when(F.col("o_orderkey") % 10 == 3, '{"other": 1}').otherwise(whole)
    table(spark, folder, "orders").select(line.alias("value")).write.text(path)
    good, bad = readers.quarantined(spark, path, schemas.CALL_METRICS, multi_line=False)
    good = good.select(F.lit("good").alias("kind"), F.col("audio_duration_sec").cast("decimal(18,2)").alias("sec"), "ticker")
    bad = bad.select(F.col("reason").alias("kind"), F.lit(None).cast("decimal(18,2)").alias("sec"), F.lit(None).cast("string").alias("ticker"))
    return good.unionByName(bad).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sec").cast("double").alias("audio_sec"), F.countDistinct("ticker").alias("tickers"))


@query("scan_transcripts", with_tables("segments", more=SECTIONED, query="""
SELECT call_id, section, row_number() OVER (PARTITION BY call_id, section ORDER BY idx) - 1 AS pos, round(start, 2) AS start, text FROM sectioned"""))
def scan_transcripts(spark, folder):
    """Transcript documents written as nested JSON, read back and opened into segments."""
    path = scratch(spark)
    rows = seg.label_sections(call_segments(spark, folder)).select(
        F.col("call_id").cast("string").alias("event_id"), F.lit("ACME").alias("ticker"), F.lit("Q1 FY2026").alias("fiscal_period"), "idx", "start", "end", "speaker_id",
        F.lit(None).cast("string").alias("speaker_name"), "speaker_role", "text", F.lit(1.0).alias("confidence"), "section")
    writers.write_documents(writers.transcript_documents(rows, ["event_id", "fiscal_period", "ticker"]), path)
    docs = spark.read.schema(schemas.TRANSCRIPT).json(path)
    return readers.transcript_segments(docs).select(
        F.col("event_id").cast("long").alias("call_id"), "section", F.col("pos").cast("long").alias("pos"), F.round("start", 2).alias("start"), "text")


@query("scan_failure_log", """
SELECT 'T' || user_id AS ticker, 'http://host' || user_id || '/' || event_id AS url, 'status ' || event_type || ', no stream, at all' AS reason FROM events""")
def scan_failure_log(spark, folder):
    """Failure lines with commas in the reason, blank lines between them."""
    path, s = scratch(spark), lambda c: F.col(c).cast("string")
    line = F.concat(F.lit("T"), s("user_id"), F.lit(", http://host"), s("user_id"), F.lit("/"), s("event_id"), F.lit(", status "), "event_type", F.lit(", no stream, at all\n  "))
    table(spark, folder, "events").select(line.alias("value")).write.text(path)
    return readers.failure_log(spark, path)


@query("scan_whole_texts", """
SELECT CAST(conv_id AS VARCHAR) AS call_id, string_agg(coalesce(text, ''), chr(10) ORDER BY turn) || chr(10) AS text FROM conversations GROUP BY conv_id""")
def scan_whole_texts(spark, folder):
    """One text file per call; the call's id is in the path."""
    path = scratch(spark)
    rows = table(spark, folder, "conversations").select(F.col("conv_id").alias("call_id"), F.col("turn").alias("idx"), F.coalesce("text", F.lit("")).alias("text"))
    # A file a call: writing costs the number of files, not their bytes, so the calls are spread over all tasks.
    spread(seg.assemble_text(rows, ["call_id"], sep="\n"), "call_id").withColumnRenamed("text", "value").write.partitionBy("call_id").text(path)
    return readers.whole_texts(spark, path, call=r"call_id=(-?\d+)/")
