"""Queries that publish documents, check their quality and reconcile reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import text as tx
from callweave.operators import quality as ql, relational as rel, reports as rp, segments as seg, speakers as spk
from callweave.plans.adapters import call_segments, registry, table, wide_table, with_tables, word_array, words_sql
from callweave.plans.operations import ROLLUP, rollup
from callweave.plans.transcripts import SECTIONED
from callweave.sources import readers, writers

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


def documents(spark, folder):
    """Transcript documents of all calls; some lack fields, sections or have swapped times, as real ones do."""
    rows = seg.label_sections(call_segments(spark, folder)).withColumns({
        "ticker": F.lit("ACME"), "event_id": F.col("call_id").cast("string"), "speaker_name": F.lit(None).cast("string"), "confidence": F.lit(0.92)})
    swapped = rows.withColumn("end", F.when(F.col("text").contains("and"), F.col("end")).otherwise(F.col("start") - 1))
    swapped = swapped.withColumn("speaker_id", F.when(F.col("n_words") > 5, F.col("speaker_id")))
    docs = writers.transcript_documents(swapped, ["event_id", "ticker"])
    return docs.withColumns({
        "fiscal_period": F.when(F.size("segments") > 4, "Q1 FY1998"), "call_datetime_utc": F.lit("1998-10-03T20:00:00Z")})


DOC_ERRORS = SECTIONED + """,
rows_x AS (SELECT *, CASE WHEN contains(text, 'and') THEN "end" ELSE start - 1 END AS e FROM sectioned),
errs AS (
  SELECT CAST(call_id AS VARCHAR) AS event_id, 'root_field' AS rule, 'fiscal_period' AS detail FROM rows_x GROUP BY call_id HAVING count(*) <= 4
  UNION ALL SELECT CAST(call_id AS VARCHAR), 'segment_field', 'speaker_id' FROM rows_x WHERE n_words <= 5
  UNION ALL SELECT CAST(call_id AS VARCHAR), 'time_order', 'start > end' FROM rows_x WHERE start > e)"""


@query("dq_rules", with_tables("segments", more=DOC_ERRORS, query="SELECT event_id, rule, detail, count(*) AS n FROM errs GROUP BY ALL"))
def dq_rules(spark, folder):
    return ql.document_errors(documents(spark, folder), "event_id").groupBy("event_id", "rule", "detail").agg(F.count(F.lit(1)).alias("n"))


@query("dq_summary", with_tables("segments", more=DOC_ERRORS, query="""
  SELECT rule, max(n) AS n, string_agg(event_id || ': ' || detail, '; ' ORDER BY r) FILTER (r <= 5) AS samples FROM (
    SELECT *, row_number() OVER (PARTITION BY rule ORDER BY event_id, detail) AS r, count(*) OVER (PARTITION BY rule) AS n FROM errs) GROUP BY rule"""))
def dq_summary(spark, folder):
    return ql.error_summary(ql.document_errors(documents(spark, folder), "event_id"), "event_id")


@query("acceptance_checklist", with_tables("segments", more=DOC_ERRORS, query="""
  SELECT requirement, CASE WHEN n_failed = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n_failed FROM (
    SELECT 'documents' AS requirement, (SELECT count(*) FROM errs) AS n_failed
    UNION ALL SELECT 'universe', (SELECT count(*) FROM customer WHERE c_mktsegment IS NULL)
    UNION ALL SELECT 'registry', (SELECT count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)))"""))
def acceptance_checklist(spark, folder):
    failed = F.count(F.lit(1)).alias("n_failed")
    shipped = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return ql.checklist([
        ("documents", ql.document_errors(documents(spark, folder), "event_id").agg(failed)),
        ("universe", table(spark, folder, "customer").where(F.col("c_mktsegment").isNull()).agg(failed)),
        ("registry", table(spark, folder, "orders").join(shipped, "o_orderkey", "left_anti").agg(failed))])


@query("transcript_documents", with_tables("segments", more=SECTIONED, query="""
  SELECT CAST(call_id AS VARCHAR) AS event_id, section, count(*) AS n, string_agg(text, ' ' ORDER BY idx) AS text FROM sectioned GROUP BY ALL"""))
def transcript_documents(spark, folder):
    """Nested documents built and flattened again."""
    rows = readers.transcript_segments(documents(spark, folder))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"])
    return rows.groupBy("event_id", "section").agg(F.count(F.lit(1)).alias("n"), F.array_join(ordered, " ").alias("text"))


@query("published_calls")
def published_calls(spark, folder):
    """Whole run: first sections without roles, speakers resolved, sections with roles, nested documents with their counts."""
    rows = call_segments(spark, folder).drop("speaker_role").withColumns({"ticker": F.lit("MSFT"), "confidence": F.lit(0.92)})
    named = spk.resolve_speakers(seg.label_sections(rows, role=None)).drop("section")
    final = seg.label_sections(named).withColumn("event_id", F.col("call_id").cast("string"))
    docs = writers.transcript_documents(final, ["event_id", "ticker"])
    return docs.select("event_id", "ticker", F.size("segments").alias("n_segments"),
                       F.transform("sections", lambda s: F.concat_ws(":", s["type"], F.size(s["segments"]).cast("string"))).alias("sections"))


@query("phrase_presence", f"""
WITH p AS (SELECT DISTINCT w AS phrase, length(w) % 2 = 0 AS required FROM (SELECT unnest({words_sql('text')}) AS w FROM benchmark) WHERE length(w) >= 8)
SELECT phrase, required, count(d.doc_id) AS n_texts, CASE WHEN required THEN count(d.doc_id) > 0 ELSE count(d.doc_id) = 0 END AS ok
FROM p LEFT JOIN documents d ON contains(d.text, phrase) GROUP BY phrase, required""")
def phrase_presence(spark, folder):
    """Long words of the benchmark passages: even lengths must occur in some document, odd ones must not."""
    words = table(spark, folder, "benchmark").select(F.explode(word_array(F.col("text"))).alias("phrase")).where(F.length("phrase") >= 8).distinct()
    return ql.phrase_presence(wide_table(spark, folder, "documents"), "doc_id", "text", words.withColumn("required", F.length("phrase") % 2 == 0), shortest=8)


REPORT_SQL = """
cells AS (SELECT bucket, country, count(*) AS n, CAST(sum(amount) AS VARCHAR) AS total FROM registry GROUP BY ALL)"""


@query("report_lines", with_tables("registry", more=REPORT_SQL, query="""
  SELECT bucket, 0 AS part, '## ' || bucket AS line FROM cells GROUP BY bucket UNION ALL SELECT bucket, 1, '| Country | Events | Total |' FROM cells GROUP BY bucket
  UNION ALL SELECT bucket, 2, '| :--- | :--- | :--- |' FROM cells GROUP BY bucket
  UNION ALL SELECT bucket, 3, '| ' || country || ' | ' || n || ' | ' || total || ' |' FROM cells"""))
def report_lines(spark, folder):
    rows = registry(spark, folder).groupBy("bucket", "country").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
    return rp.table_lines(rows, {"Country": F.col("country"), "Events": F.col("n"), "Total": F.col("total").cast("string")}, ["country"], "bucket")


@query("report_round_trip", with_tables("registry", more=REPORT_SQL, query="SELECT bucket, country, CAST(n AS VARCHAR) AS n, total FROM cells"))
def report_round_trip(spark, folder):
    """Reports written per bucket, read back and unpacked: every cell survives."""
    lines = report_lines(spark, folder).withColumn("_k", F.concat(F.col("part").cast("string"), "line"))
    texts = lines.groupBy("bucket").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("_k", "line"))), lambda x: x["line"]), "\n").alias("text"))
    rows = rp.parse_table(texts, "bucket", "text", "## ")
    return rows.select("bucket", F.col("cells")["Country"].alias("country"), F.col("cells")["Events"].alias("n"), F.col("cells")["Total"].alias("total"))


@query("latency_table", with_tables("chunks", more=ROLLUP, query="""
  SELECT call_id, CAST(floor(audio_sec / 60) AS BIGINT) || 'm ' || lpad(CAST(CAST(audio_sec AS BIGINT) % 60 AS VARCHAR), 2, '0') || 's' AS audio,
     lpad(CAST(CAST(floor(asr_sec / 60) AS BIGINT) AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(asr_sec AS BIGINT) % 60 AS VARCHAR), 2, '0') AS asr,
     '&lt;b&gt;' || CASE WHEN queue_drained THEN 'YES' ELSE 'NO' END || '&lt;/b&gt;' AS drained FROM rollup"""))
def latency_table(spark, folder):
    """Formatted cells of the latency report."""
    badge = F.concat(F.lit("<b>"), F.when(F.col("queue_drained"), "YES").otherwise("NO"), F.lit("</b>"))
    return rollup(spark, folder).select(
        "call_id", tx.spoken_length(F.col("audio_sec")).alias("audio"), tx.minutes_seconds(F.col("asr_sec")).alias("asr"), tx.escape_html(badge).alias("drained"))
