"""Queries over chunk metrics, the event registry, the crawl log and capture facts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv
from callweave.operators import capture as cap, latency as lat, relational as rel
from callweave.operators.ordered import first_rows
from callweave.plans.adapters import call_segments, chunk_metrics, crawl_log, diarization_turns, registry, table, with_tables

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


ROLLUP = """
rollup AS (
  SELECT call_id, sum(proc_time_sec) AS asr_sec, max_by(proc_time_sec, chunk_idx) AS last_chunk_sec, max(proc_time_sec) AS max_chunk_sec,
         sum(duration_sec) AS audio_sec, count(*) AS chunk_count, bool_and(proc_time_sec < duration_sec) AS queue_drained
  FROM (SELECT call_id, chunk_idx, max(proc_time_sec) AS proc_time_sec, max(duration_sec) AS duration_sec FROM chunks GROUP BY 1, 2)
  GROUP BY call_id)"""
METRICS = ROLLUP + """,
metrics AS (
  SELECT *, round(CAST(asr_sec AS DOUBLE) / greatest(0.001e0, CAST(audio_sec AS DOUBLE)), 4) AS asr_rtf,
         round(CAST(diar_sec AS DOUBLE) / greatest(0.001e0, CAST(audio_sec AS DOUBLE)), 4) AS diar_rtf,
         round(CAST(asr_sec + diar_sec AS DOUBLE) / greatest(0.001e0, CAST(audio_sec AS DOUBLE)), 4) AS total_rtf,
         CAST(last_chunk_sec + diar_sec + resolve_sec + 0.150 AS DOUBLE) AS post_call_latency_sec,
         CASE WHEN queue_drained AND last_chunk_sec + diar_sec + resolve_sec + 0.150 <= 300 THEN 'PASS' ELSE 'FAIL' END AS sla_status
  FROM (SELECT *, asr_sec * 2 AS diar_sec, CAST(chunk_count AS DECIMAL(10,3)) AS resolve_sec FROM rollup))"""


def one_row_per_chunk(spark, folder):
    """An order may list a line number twice; a chunk keeps its slowest pass."""
    return chunk_metrics(spark, folder).groupBy("call_id", "chunk_idx").agg(
        F.max("proc_time_sec").alias("proc_time_sec"), F.max("duration_sec").alias("duration_sec"))


def rollup(spark, folder):
    return lat.chunk_rollup(one_row_per_chunk(spark, folder))


def metrics(spark, folder):
    """Diarization is taken as twice the recognition time, resolution as a second per chunk."""
    base = rollup(spark, folder).withColumn("diar_sec", F.col("asr_sec") * 2).withColumn(
        "resolve_sec", F.col("chunk_count").cast("decimal(10,3)"))
    return lat.call_metrics(base)


SECONDS = ["asr_sec", "last_chunk_sec", "max_chunk_sec", "audio_sec"]


@query("chunk_rollup", with_tables("chunks", more=ROLLUP, query="SELECT call_id, chunk_count, queue_drained, "
       + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in SECONDS) + " FROM rollup"))
def chunk_rollup(spark, folder):
    return rollup(spark, folder).select("call_id", "chunk_count", "queue_drained", *[F.col(c).cast("double").alias(c) for c in SECONDS])


@query("sla_status", with_tables("chunks", more=METRICS, query="""
  SELECT call_id, queue_drained, asr_rtf, diar_rtf, total_rtf, post_call_latency_sec, sla_status FROM metrics"""))
def sla_status(spark, folder):
    return metrics(spark, folder).select(
        "call_id", "queue_drained", "asr_rtf", "diar_rtf", "total_rtf", "post_call_latency_sec", "sla_status")


MEASURES = ["asr_rtf", "diar_rtf", "total_rtf", "post_call_latency_sec", "asr_sec", "audio_sec"]


@query("rtf_summary", with_tables("chunks", more=METRICS, query=" UNION ALL ".join(
    f"SELECT '{m}' AS measure, CAST(min({m}) AS DOUBLE) AS min, CAST(max({m}) AS DOUBLE) AS max, "
    f"CAST(sum(CAST({m} AS DECIMAL(28,6))) AS DOUBLE) / count({m}) AS mean, "
    f"CAST(sum(CAST({m} AS DECIMAL(28,6))) AS DOUBLE) AS total FROM metrics" for m in MEASURES)))
def rtf_summary(spark, folder):
    return lat.spread(metrics(spark, folder), MEASURES)


@query("chunk_global_stats", with_tables("chunks", query="""
  SELECT CAST(min(proc_time_sec) AS DOUBLE) AS min, CAST(max(proc_time_sec) AS DOUBLE) AS max,
         CAST(sum(CAST(proc_time_sec AS DECIMAL(28,6))) AS DOUBLE) / count(*) AS mean,
         CAST(sum(CAST(proc_time_sec AS DECIMAL(28,6))) AS DOUBLE) AS total, 'proc_time_sec' AS measure FROM chunks"""))
def chunk_global_stats(spark, folder):
    """Chunk lists nested per call, unnested again and summarised over all chunks."""
    nested = chunk_metrics(spark, folder).groupBy("call_id").agg(
        F.collect_list(F.struct("chunk_idx", "proc_time_sec", "duration_sec")).alias("chunk_metrics"))
    return lat.spread(nested.select("call_id", F.inline("chunk_metrics")), ["proc_time_sec"])


@query("runtime_projection", with_tables("chunks", more=ROLLUP, query="""
  SELECT rtf, corpus_sec, corpus_sec * rtf AS projected_sec, corpus_sec * rtf / 3600 AS projected_hours
  FROM (SELECT CAST(sum(asr_sec) AS DOUBLE) / CAST(sum(audio_sec) AS DOUBLE) AS rtf, CAST(sum(audio_sec) AS DOUBLE) * 10 AS corpus_sec FROM rollup)"""))
def runtime_projection(spark, folder):
    return lat.project_runtime(rollup(spark, folder), F.sum("audio_sec").cast("double") * 10)


@query("cost_model", with_tables("chunks", more=ROLLUP, query="""
  SELECT machine, sec_per_audio_hour, d AS dollars_per_audio_hour, round(d * 2000, 2) AS dollars_per_year
  FROM (SELECT machine, h AS sec_per_audio_hour, round(h / 3600 * price, 4) AS d
        FROM (SELECT p_brand AS machine, p_price / 10000e0 AS price,
                     round((SELECT CAST(sum(asr_sec) AS DOUBLE) / (CAST(sum(audio_sec) AS DOUBLE) / 3600e0) FROM rollup) * slow, 1) AS h
              FROM (SELECT p_brand, CAST(min(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) AS p_price, CAST(max(p_size) AS DOUBLE) / 10e0 AS slow
                    FROM part GROUP BY p_brand)))"""))
def cost_model(spark, folder):
    """Machine types from part brands: hourly price and slow-down factor."""
    prices = table(spark, folder, "part").groupBy(F.col("p_brand").alias("machine")).agg(
        (F.min(F.col("p_retailprice").cast("decimal(18,2)")).cast("double") / F.lit(10000.0)).alias("dollars_per_hour"),
        (F.max("p_size").cast("double") / F.lit(10.0)).alias("slowdown"),
    )
    return lat.cost_per_audio_hour(rollup(spark, folder), prices)


@query("pooled_vs_macro", with_tables("chunks", more=ROLLUP, query="""
  SELECT queue_drained, CAST(sum(asr_sec) AS DOUBLE) / CAST(sum(audio_sec) AS DOUBLE) AS pooled,
         CAST(sum(CAST(CAST(asr_sec AS DOUBLE) / CAST(audio_sec AS DOUBLE) AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS macro
  FROM rollup GROUP BY queue_drained"""))
def pooled_vs_macro(spark, folder):
    return lat.pooled_and_macro(rollup(spark, folder), ["queue_drained"], "asr_sec", "audio_sec")


@query("totals_rollup", with_tables("chunks", query="""
  SELECT call_id, grouping(call_id) AS is_total, count(*) AS n_chunks, CAST(sum(proc_time_sec) AS DOUBLE) AS proc_sec,
         CAST(sum(proc_time_sec) AS DOUBLE) / count(*) AS mean_sec
  FROM chunks GROUP BY ROLLUP (call_id)"""))
def totals_rollup(spark, folder):
    total = F.sum("proc_time_sec").cast("double")
    return chunk_metrics(spark, folder).rollup("call_id").agg(
        F.grouping("call_id").cast("long").alias("is_total"), F.count(F.lit(1)).alias("n_chunks"),
        total.alias("proc_sec"), (total / F.count(F.lit(1))).alias("mean_sec"))


@query("cohort_averages", with_tables("chunks", "registry", more=ROLLUP + """,
bridge AS (SELECT event_id AS call_id, country AS cohort FROM registry UNION ALL SELECT event_id, bucket FROM registry
           UNION ALL SELECT event_id, 'LATE' FROM registry WHERE call_at > announced_at)""", query="""
  SELECT cohort, count(*) AS n_calls, CAST(sum(audio_sec) AS DOUBLE) AS total_sec,
         CAST(sum(asr_sec) AS DOUBLE) / count(*) AS mean_asr_sec, CAST(sum(last_chunk_sec) AS DOUBLE) / count(*) AS mean_last_sec
  FROM rollup JOIN bridge USING (call_id) GROUP BY cohort"""))
def cohort_averages(spark, folder):
    """A call belongs to several cohorts (country, market bucket, announced before the call)."""
    reg = registry(spark, folder)
    late = F.when(F.col("call_at") > F.col("announced_at"), F.lit("LATE"))
    bridge = reg.select(F.col("event_id").alias("call_id"), F.explode(F.array("country", "bucket", late)).alias("cohort"))
    rows = rollup(spark, folder).join(bridge.where(F.col("cohort").isNotNull()), "call_id")
    n = F.count(F.lit(1))
    return rows.groupBy("cohort").agg(
        n.alias("n_calls"), F.sum("audio_sec").cast("double").alias("total_sec"),
        (F.sum("asr_sec").cast("double") / n).alias("mean_asr_sec"),
        (F.sum("last_chunk_sec").cast("double") / n).alias("mean_last_sec"))


# --- registry ---------------------------------------------------------------------------------------------------

@query("vendor_share", with_tables("registry", query="""
  SELECT route, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM registry GROUP BY route"""))
def vendor_share(spark, folder):
    return rel.share_of_total(registry(spark, folder), "route")


@query("status_outcome_counts", with_tables("crawl", query="""
  SELECT http_status, CASE WHEN from_cache AND http_status IS NOT NULL THEN 'SUCCESS_CACHED' WHEN http_status IS NULL THEN 'FAILED'
           WHEN http_status IN (429, 401, 403) THEN 'BLOCKED' WHEN http_status >= 400 THEN 'FAILED' ELSE 'SUCCESS' END AS outcome, count(*) AS n
  FROM crawl GROUP BY ALL"""))
def status_outcome_counts(spark, folder):
    outcome = cap.request_outcome(F.col("http_status"), F.col("from_cache"))
    rows = crawl_log(spark, folder).groupBy("http_status", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))
    return rows.orderBy(F.desc("n"))


@query("http_outcome", with_tables("crawl", query="""
  SELECT request_id, CASE WHEN from_cache AND http_status IS NOT NULL THEN 'SUCCESS_CACHED' WHEN http_status IS NULL THEN 'FAILED'
           WHEN http_status IN (429, 401, 403) THEN 'BLOCKED' WHEN http_status >= 400 THEN 'FAILED' ELSE 'SUCCESS' END AS outcome FROM crawl"""))
def http_outcome(spark, folder):
    return crawl_log(spark, folder).select(
        "request_id", cap.request_outcome(F.col("http_status"), F.col("from_cache")).alias("outcome"))


@query("bucket_targets", """
WITH c AS (SELECT c_mktsegment AS bucket, count(*) AS n, count(*) FILTER (c_acctbal < 0) AS n_negative,
                  count(*) FILTER (c_acctbal >= 5000) AS n_large, 0.2e0 * (SELECT count(*) FROM customer) AS target
           FROM customer GROUP BY 1)
SELECT *, CASE WHEN n >= target THEN 'PASS' WHEN n >= 0.9e0 * target THEN 'PARTIAL' ELSE 'FAIL' END AS status FROM c""")
def bucket_targets(spark, folder):
    """Companies per market bucket against an equal share of the universe."""
    companies = table(spark, folder, "customer")
    target = companies.agg(F.count(F.lit(1)) * F.lit(0.2)).scalar()
    counts = companies.groupBy(F.col("c_mktsegment").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("c_acctbal") < 0).alias("n_negative"),
        F.count_if(F.col("c_acctbal") >= 5000).alias("n_large"))
    counts = counts.withColumn("target", target)
    return counts.withColumn(
        "status", F.when(F.col("n") >= F.col("target"), "PASS")
        .when(F.col("n") >= F.col("target") * 0.9, "PARTIAL").otherwise("FAIL"))


@query("null_coverage", with_tables("registry", query="""
  SELECT country, count(*) AS total, count(call_at) AS dated, count(*) - count(call_at) AS undated,
         count(*) FILTER (call_at IS NOT NULL AND status = 'F') AS complete FROM registry GROUP BY country"""))
def null_coverage(spark, folder):
    """Events with and without a call time; complete = dated and finished."""
    dated = F.col("call_at").isNotNull()
    return registry(spark, folder).groupBy("country").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(dated).alias("dated"), F.count_if(~dated).alias("undated"),
        F.count_if(dated & (F.col("status") == "F")).alias("complete"))


LEAD = "(epoch_us(call_at) - epoch_us(announced_at)) / 3600000000e0"


def lead_hours(reg):
    us = F.unix_micros(F.col("call_at").cast("timestamp")) - F.unix_micros(F.col("announced_at").cast("timestamp"))
    return reg.withColumn("lead_time_hours", us / F.lit(3_600_000_000.0))


@query("lead_time", with_tables("registry", query=f"SELECT event_id, {LEAD} AS lead_time_hours FROM registry"))
def lead_time(spark, folder):
    return lead_hours(registry(spark, folder)).select("event_id", "lead_time_hours")


@query("upper_median_route", with_tables("registry", query=f"""
  SELECT route, n, v[n // 2 + 1] AS upper_median FROM (
    SELECT route, count(*) AS n, list(h ORDER BY h) AS v FROM (SELECT route, {LEAD} AS h FROM registry) WHERE h > 0 GROUP BY route)"""))
def upper_median_route(spark, folder):
    rows = lead_hours(registry(spark, folder)).where(F.col("lead_time_hours") > 0)
    return rel.upper_median(rows, ["route"], "lead_time_hours", slice_width=720.0)


@query("earliest_route", with_tables("registry", query=f"""
  SELECT max_by(route, m) AS route, max(m) AS upper_median FROM (
    SELECT route, v[n // 2 + 1] AS m FROM (
      SELECT route, count(*) AS n, list(h ORDER BY h) AS v FROM (SELECT country AS route, {LEAD} AS h FROM registry) WHERE h > 0 GROUP BY route))"""))
def earliest_route(spark, folder):
    rows = lead_hours(registry(spark, folder)).where(F.col("lead_time_hours") > 0)
    med = rel.upper_median(rows, ["country"], "lead_time_hours", slice_width=720.0)
    return med.agg(F.max_by("country", "upper_median").alias("route"), F.max("upper_median").alias("upper_median"))


@query("priority_fallback", """
WITH a AS (SELECT o_orderkey AS event_id, o_orderdate AS call_at, 0 AS source_rank FROM orders WHERE o_orderstatus = 'F'),
b AS (SELECT l_orderkey AS event_id, max(l_shipdate) AS call_at, 1 AS source_rank FROM lineitem GROUP BY 1)
SELECT * FROM a UNION ALL SELECT * FROM b WHERE event_id NOT IN (SELECT event_id FROM a)""")
def priority_fallback(spark, folder):
    """Verified dates win, shipped dates fill the gaps."""
    verified = table(spark, folder, "orders").where("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderdate").alias("call_at"))
    derived = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("event_id")).agg(F.max("l_shipdate").alias("call_at"))
    return rel.fallback_lookup([verified, derived], ["event_id"])


@query("date_lookup", with_tables("registry", query="""
  SELECT call_id, chunk_count, route, call_at FROM (SELECT l_orderkey AS call_id, count(*) AS chunk_count FROM lineitem GROUP BY 1)
  LEFT JOIN (SELECT event_id, route, call_at FROM registry WHERE status = 'O') ON event_id = call_id"""))
def date_lookup(spark, folder):
    calls = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("call_id")).agg(F.count(F.lit(1)).alias("chunk_count"))
    dates = registry(spark, folder).where("status = 'O'").select(F.col("event_id").alias("call_id"), "route", "call_at")
    return calls.join(dates, "call_id", "left")


UPSERT = """
SELECT company_id, (r).event_id AS event_id, (r).route AS route, (r).amount AS amount FROM (
  SELECT company_id, max_by({'event_id': event_id, 'route': route, 'amount': amount}, (announced_at, event_id)) AS r FROM registry GROUP BY company_id)"""


@query("keyed_upsert", with_tables("registry", query=UPSERT))
def keyed_upsert(spark, folder):
    """Events of finished orders, updated by all others; the newest announcement of a company wins."""
    reg = registry(spark, folder).select("company_id", "event_id", "route", "amount", "announced_at", "status")
    out = rel.upsert(reg.where("status = 'F'"), reg.where("status <> 'F'"), ["company_id"], F.struct("announced_at", "event_id"))
    return out.select("company_id", "event_id", "route", "amount")


@query("insert_if_absent", """
SELECT c_custkey AS company_id, 'universe' AS origin FROM customer WHERE c_acctbal > 0
UNION ALL SELECT DISTINCT o_custkey, 'orders' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def insert_if_absent(spark, folder):
    known = table(spark, folder, "customer").where("c_acctbal > 0").select(
        F.col("c_custkey").alias("company_id"), F.lit("universe").alias("origin"))
    seen = table(spark, folder, "orders").select(F.col("o_custkey").alias("company_id")).distinct().withColumn("origin", F.lit("orders"))
    return rel.insert_absent(known, seen, ["company_id"])


@query("skip_finished", with_tables("registry", query="SELECT event_id, route FROM registry WHERE event_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')"))
def skip_finished(spark, folder):
    done = table(spark, folder, "lineitem").where("l_linestatus = 'F'").select(F.col("l_orderkey").alias("event_id"))
    return rel.outstanding(registry(spark, folder), done, ["event_id"]).select("event_id", "route")


@query("field_fill", """
SELECT c_custkey AS company_id, coalesce(nullif(trim(CASE WHEN c_acctbal < 2000 THEN ' ' ELSE c_mktsegment END), ''), top) AS bucket
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderpriority) AS top FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def field_fill(spark, folder):
    companies = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("company_id"),
        F.when(F.col("c_acctbal") < 2000, " ").otherwise(F.col("c_mktsegment")).alias("bucket"))
    other = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("company_id")).agg(F.min("o_orderpriority").alias("bucket"))
    return rel.fill_fields(companies, other, ["company_id"], ["bucket"])


@query("default_fill", with_tables("registry", query="""
  SELECT event_id, coalesce(CAST(call_at AS VARCHAR), 'NULL (Not Published)') AS call_text, CASE WHEN call_at IS NULL THEN 0.6e0 ELSE 0.95e0 END AS confidence,
         status = 'F' AND call_at IS NOT NULL AS is_complete FROM registry"""))
def default_fill(spark, folder):
    call, period = F.col("call_at"), F.col("status")
    return registry(spark, folder).select(
        "event_id", F.coalesce(F.date_format("call_at", "yyyy-MM-dd HH:mm:ss"), F.lit("NULL (Not Published)")).alias("call_text"),
        cap.filing_confidence(call, period).alias("confidence"),
        ((period == "F") & call.isNotNull()).alias("is_complete"))


@query("override_rules", with_tables("registry", query="""
  SELECT event_id, CASE WHEN r_name = 'ASIA' THEN 'Q4 FY2026' WHEN r_name = 'EUROPE' AND status = 'O' THEN 'Q2 FY2026' ELSE status END AS status,
         CASE WHEN r_name = 'AFRICA' THEN NULL WHEN r_name = 'AMERICA' AND route IN ('1-URGENT', '5-LOW') THEN 'FORCED' ELSE route END AS route
  FROM registry JOIN nation ON n_name = country JOIN region ON r_regionkey = n_regionkey"""))
def override_rules(spark, folder):
    """Forced values per region: some always, some only over certain present values."""
    spots = table(spark, folder, "nation").join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("region"))
    rows = registry(spark, folder).join(spots, "country").select("event_id", "region", "status", "route")
    rules = table(spark, folder, "region").select(F.col("r_name").alias("rule_key")).select("rule_key", F.explode(F.expr("""
      CASE rule_key WHEN 'ASIA' THEN array(named_struct('field', 'status', 'only_if', cast(array() as array<string>), 'value', 'Q4 FY2026'))
        WHEN 'EUROPE' THEN array(named_struct('field', 'status', 'only_if', array('O'), 'value', 'Q2 FY2026'))
        WHEN 'AFRICA' THEN array(named_struct('field', 'route', 'only_if', cast(array() as array<string>), 'value', cast(null as string)))
        WHEN 'AMERICA' THEN array(named_struct('field', 'route', 'only_if', array('1-URGENT', '5-LOW'), 'value', 'FORCED')) END""")).alias("r")
    ).select("rule_key", "r.*")
    return rel.apply_overrides(rows, rules, "region", ["status", "route"]).select("event_id", "status", "route")


CAPTURES = """
bad AS (SELECT DISTINCT sha256(CAST(l_orderkey AS VARCHAR)) AS h FROM lineitem WHERE l_returnflag = 'R' AND l_discount >= 0.09),
caps AS (SELECT o_orderkey AS event_id, 'https://' || CASE WHEN o_orderpriority = '5-LOW' THEN 'www.youtube.com' ELSE 'host' || CAST(o_custkey AS VARCHAR) || '.example.com' END || '/a' AS source_url,
            CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 16000 END AS sample_rate, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END AS channels, 16 AS bit_depth,
            sha256(CAST(o_orderkey AS VARCHAR)) AS sha256, CAST(floor(o_totalprice / 50) AS BIGINT) AS duration_sec, CAST(floor(o_totalprice * 200) AS BIGINT) AS file_size FROM orders)"""


@query("capture_gate", "WITH " + CAPTURES.strip() + """
SELECT event_id, CASE WHEN source_url LIKE '%youtube.com/%' THEN 'Forbidden source domain: youtube'
   WHEN sample_rate IS DISTINCT FROM 16000 THEN 'Sample rate None != 16000' WHEN channels <> 1 THEN 'Channels 2 != 1 (mono)'
   WHEN sha256 IN (SELECT h FROM bad) THEN 'SHA256 ' || sha256 || ' matches an old synthetic/cached run'
   WHEN duration_sec < 1200 OR duration_sec > 7200 THEN 'Audio duration ' || CAST(duration_sec AS VARCHAR) || '.0s is out of range [1200s, 7200s]'
   WHEN file_size < 35000000 THEN 'File size ' || CAST(file_size AS VARCHAR) || ' is too small for a valid full call' ELSE 'VALID' END AS verdict FROM caps""")
def capture_gate(spark, folder):
    orders = table(spark, folder, "orders")
    host = F.when(F.col("o_orderpriority") == "5-LOW", "www.youtube.com").otherwise(
        F.concat(F.lit("host"), F.col("o_custkey").cast("string"), F.lit(".example.com")))
    caps = orders.select(
        F.col("o_orderkey").alias("event_id"), F.concat(F.lit("https://"), host, F.lit("/a")).alias("source_url"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", 16000).alias("sample_rate"),
        F.when(F.col("o_orderstatus") == "P", 2).otherwise(1).alias("channels"), F.lit(16).alias("bit_depth"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("sha256"),
        F.floor(F.col("o_totalprice") / 50).alias("duration_sec"), F.floor(F.col("o_totalprice") * 200).alias("file_size"))
    known = table(spark, folder, "lineitem").where("l_returnflag = 'R' AND l_discount >= 0.09").select(
        F.sha2(F.col("l_orderkey").cast("string"), 256).alias("sha256")).distinct().withColumn("_bad", F.lit(True))
    rows = caps.join(known, "sha256", "left")
    return rows.select("event_id", cap.capture_verdict(F.coalesce("_bad", F.lit(False))).alias("verdict"))


@query("valid_captures", """
SELECT o_orderkey AS event_id, o_orderpriority AS audio_path FROM orders WHERE o_orderpriority <> '' AND o_totalprice > 1000
  AND o_orderkey IN (SELECT l_orderkey FROM lineitem)""")
def valid_captures(spark, folder):
    path = lambda c: F.concat(F.lit("data/audio/"), F.col(c).cast("string"), F.lit(".wav"))
    manifest = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_orderpriority").alias("p"), path("o_orderkey").alias("audio_path"),
        (F.col("o_totalprice") - 1000).alias("duration_sec"))
    files = table(spark, folder, "lineitem").select(path("l_orderkey").alias("audio_path"))
    return cap.valid_captures(manifest, files).select("event_id", F.col("p").alias("audio_path"))


@query("manifest_union", """
SELECT o_orderkey AS event_id, o_custkey AS company_id, CAST(o_totalprice AS DECIMAL(18,2)) AS duration_sec, '' AS failure_reason FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT o_orderkey, o_custkey, NULL, 'status ' || o_orderstatus FROM orders
WHERE o_orderstatus <> 'F' AND (o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') OR o_orderstatus = 'O')""")
def manifest_union(spark, folder):
    """Valid captures plus the failures still worth keeping: of companies without a capture, or open ones."""
    base = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("company_id"), F.col("o_orderstatus").alias("st"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("duration_sec"))
    valid = base.where("st = 'F'").withColumn("failure_reason", F.lit("")).drop("st")
    failed = base.where("st <> 'F'").drop("duration_sec")
    captured = valid.select("company_id").distinct().withColumn("_c", F.lit(True))
    kept = failed.join(captured, "company_id", "left").where(F.col("_c").isNull() | (F.col("st") == "O"))
    kept = kept.select("event_id", "company_id", F.concat(F.lit("status "), "st").alias("failure_reason"))
    return valid.unionByName(kept, allowMissingColumns=True)


@query("set_difference", """
SELECT l_partkey AS part_id FROM lineitem EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R'""")
def set_difference(spark, folder):
    """Artifacts never superseded."""
    lines = table(spark, folder, "lineitem")
    gone = lines.where("l_returnflag = 'R'").select(F.col("l_partkey").alias("part_id"))
    return lines.select(F.col("l_partkey").alias("part_id")).distinct().join(gone, "part_id", "left_anti")


@query("multiset_intersection", """
SELECT l_partkey AS part_id, l_suppkey AS supp_id FROM lineitem WHERE l_returnflag = 'R'
INTERSECT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'""")
def multiset_intersection(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_returnflag", F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supp_id"))
    return rows.where("l_returnflag = 'R'").drop("l_returnflag").intersectAll(rows.where("l_returnflag = 'A'").drop("l_returnflag"))


@query("ordered_distinct", """
SELECT line, min(event_id) AS event_id FROM (SELECT event_id, event_type || ', ' || CAST(user_id AS VARCHAR) || ', ' || CAST(floor(value) AS VARCHAR) AS line FROM events) GROUP BY line""")
def ordered_distinct(spark, folder):
    lines = table(spark, folder, "events").select(
        "event_id", F.concat_ws(", ", "event_type", F.col("user_id").cast("string"), F.concat(F.floor("value").cast("string"), F.lit(".0"))).alias("line"))
    return rel.distinct_in_order(lines, "line", "event_id")


REPORTED = """
expected AS (SELECT call_id, CAST(CAST(asr_sec AS DECIMAL(28,3)) AS VARCHAR) AS asr_sec, CAST(chunk_count AS VARCHAR) AS chunk_count,
                    CASE WHEN queue_drained THEN 'YES' ELSE 'NO' END AS drained FROM rollup),
reported AS (SELECT call_id, CAST(CAST(sum(proc_time_sec) AS DECIMAL(28,3)) AS VARCHAR) AS asr_sec, CAST(count(*) AS VARCHAR) AS chunk_count,
                    CASE WHEN max(proc_time_sec) < 40 THEN 'YES' ELSE 'NO' END AS drained FROM chunks GROUP BY call_id),
cells AS (SELECT coalesce(e.call_id, r.call_id) AS call_id, u.* FROM expected e FULL JOIN reported r ON e.call_id = r.call_id,
  LATERAL (VALUES ('asr_sec', e.asr_sec, r.asr_sec), ('chunk_count', e.chunk_count, r.chunk_count), ('drained', e.drained, r.drained)) u(metric, expected, reported))"""


@query("reconcile_report", with_tables("chunks", more=ROLLUP + "," + REPORTED, query="""
  SELECT *, expected IS NOT DISTINCT FROM reported AS matches FROM cells"""))
def reconcile_report(spark, folder):
    """Recomputed per-call figures against a report that counted repeated chunks and used a stricter drain limit."""
    text = lambda c: c.cast("decimal(28,3)").cast("string")
    expected = rollup(spark, folder).select(
        "call_id", text(F.col("asr_sec")).alias("asr_sec"), "chunk_count", F.when(F.col("queue_drained"), "YES").otherwise("NO").alias("drained"))
    reported = chunk_metrics(spark, folder).groupBy("call_id").agg(
        text(F.sum("proc_time_sec")).alias("asr_sec"), F.count(F.lit(1)).alias("chunk_count"),
        F.when(F.max("proc_time_sec") < 40, "YES").otherwise("NO").alias("drained"))
    return rel.reconcile(expected, reported, ["call_id"], ["asr_sec", "chunk_count", "drained"])


@query("best_candidate", """
SELECT l_orderkey AS event_id, l_linenumber AS doc_rank, l_shipmode AS filing FROM (
 SELECT l_orderkey, l_linenumber, l_returnflag AS l_shipmode, row_number() OVER (PARTITION BY l_orderkey
   ORDER BY CASE WHEN l_discount > 0 AND l_tax > 0 THEN 0 WHEN l_discount > 0 THEN 1 ELSE 2 END, l_linenumber, l_partkey, l_suppkey, l_returnflag) AS r FROM lineitem) WHERE r = 1""")
def best_candidate(spark, folder):
    """Per event the first document with time and period, else with a time, else the first one."""
    has_time, has_period = F.col("l_discount") > 0, F.col("l_tax") > 0
    docs = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("event_id"), F.col("l_linenumber").alias("doc_rank"), F.col("l_returnflag").alias("filing"),
        F.when(has_time & has_period, 0).when(has_time, 1).otherwise(2).alias("_class"), "l_partkey", "l_suppkey")
    best = rel.pick_per_key(docs, ["event_id"], F.struct("_class", "doc_rank", "l_partkey", "l_suppkey", "filing"))
    return best.select("event_id", "doc_rank", "filing")


@query("route_resolution", with_tables("registry", query="""
  SELECT c_custkey AS company_id, coalesce(a.event_id, b.event_id) AS event_id,
         CASE WHEN a.event_id IS NOT NULL THEN 'FILING' WHEN b.event_id IS NOT NULL THEN 'PAGE' ELSE 'DEFAULT' END AS route
  FROM customer LEFT JOIN (SELECT company_id, min(event_id) AS event_id FROM registry WHERE status = 'F' GROUP BY 1) a ON a.company_id = c_custkey
  LEFT JOIN (SELECT company_id, min(event_id) AS event_id FROM registry WHERE status = 'O' GROUP BY 1) b ON b.company_id = c_custkey"""))
def route_resolution(spark, folder):
    """Filings first, then event pages, else the default row of the company."""
    reg = registry(spark, folder)
    route = lambda st, name: reg.where(F.col("status") == st).groupBy("company_id").agg(F.min("event_id").alias("event_id")).withColumn("route", F.lit(name))
    default = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("company_id"), F.lit(None).cast("long").alias("event_id"), F.lit("DEFAULT").alias("route"))
    return rel.fallback_lookup([route("F", "FILING"), route("O", "PAGE"), default], ["company_id"]).drop("source_rank")


@query("status_members", """
SELECT c_mktsegment AS status, count(*) AS n, string_agg(c_name, ', ' ORDER BY c_name) AS members FROM customer GROUP BY c_mktsegment""")
def status_members(spark, folder):
    """Count and members of each status, one row per status: the row is as long as its list."""
    rows = table(spark, folder, "customer").groupBy(F.col("c_mktsegment").alias("status"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list("c_name")), ", ").alias("members"))


@query("take_until", """
SELECT o_orderkey AS pos, o_orderstatus AS st FROM orders WHERE o_orderkey <= (
  SELECT max(o_orderkey) FROM (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY 1 LIMIT 12))""")
def take_until(spark, folder):
    queue = table(spark, folder, "orders").select(F.col("o_orderkey").alias("pos"), F.col("o_orderstatus").alias("st"))
    return rel.take_until(queue, "pos", F.col("st") == "F", 12)


@query("numbered_head", """
SELECT c_custkey, c_name, CAST(row_number() OVER (ORDER BY c_custkey) AS INTEGER) AS row_no FROM customer ORDER BY c_custkey LIMIT 25""")
def numbered_head(spark, folder):
    return rel.numbered_head(table(spark, folder, "customer").select("c_custkey", "c_name"), ["c_custkey"], 25)


@query("custom_order", """
SELECT r_name, n_name, CAST(row_number() OVER (ORDER BY o, n_name) AS INTEGER) AS ord FROM nation JOIN region ON r_regionkey = n_regionkey
JOIN (VALUES ('EUROPE', 0), ('ASIA', 1), ('AMERICA', 2), ('AFRICA', 3), ('MIDDLE EAST', 4)) v(k, o) ON k = r_name""")
def custom_order(spark, folder):
    """Nations in a listed region order."""
    order = table(spark, folder, "region").select(
        "r_regionkey", "r_name", F.expr("array_position(array('EUROPE','ASIA','AMERICA','AFRICA','MIDDLE EAST'), r_name)").alias("_o"))
    rows = table(spark, folder, "nation").join(order, F.col("n_regionkey") == F.col("r_regionkey"))
    # The window runs over the dimension alone.
    return rows.select("r_name", "n_name", F.row_number().over(Window.orderBy("_o", "n_name")).alias("ord"))


TABLES = ["customer", "orders", "lineitem", "events", "documents", "pages", "conversations"]


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in TABLES))
def table_counts(spark, folder):
    out = None
    for t in TABLES:
        one = table(spark, folder, t).agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@query("call_keys", with_tables("registry", query="""
  SELECT event_id, bucket || '_Q' || CAST(quarter(announced_at) AS VARCHAR) || '_FY' || CAST(year(announced_at) AS VARCHAR) AS call_key, bucket AS ticker,
         'Q' || CAST(quarter(announced_at) AS VARCHAR) || ' FY' || CAST(year(announced_at) AS VARCHAR) AS period FROM registry"""))
def call_keys(spark, folder):
    period = F.concat(F.lit("Q"), F.quarter("announced_at").cast("string"), F.lit(" FY"), F.year("announced_at").cast("string"))
    keyed = registry(spark, folder).select("event_id", cap.call_key(F.col("bucket"), period).alias("call_key"))
    return keyed.select("event_id", "call_key", cap.key_ticker(F.col("call_key")).alias("ticker"), cap.key_period(F.col("call_key")).alias("period"))


@query("speaker_lists", with_tables("turns", query="""
  SELECT call_id, array_to_string(list_sort(list(DISTINCT speaker_id)), ',') AS speakers, count(DISTINCT speaker_id) AS n FROM turns GROUP BY call_id"""))
def speaker_lists(spark, folder):
    who = diarization_turns(spark, folder).select("call_id", "speaker_id").distinct()
    return who.groupBy("call_id").agg(
        F.array_join(F.sort_array(F.collect_list("speaker_id")), ",").alias("speakers"), F.count(F.lit(1)).alias("n"))


@query("dropped_lists", with_tables("chunks", query="""
  SELECT call_id, count(*) AS n_dropped, string_agg(CAST(chunk_idx AS VARCHAR) || ':' || CAST(part_id AS VARCHAR), ',' ORDER BY chunk_idx, part_id) AS dropped
  FROM chunks WHERE proc_time_sec >= duration_sec GROUP BY call_id"""))
def dropped_lists(spark, folder):
    """Dropped entries gathered per chunk, the chunk lists flattened per call."""
    per_chunk = chunk_metrics(spark, folder).where("proc_time_sec >= duration_sec").groupBy("call_id", "chunk_idx").agg(
        F.sort_array(F.collect_list("part_id")).alias("_parts"))
    per_call = per_chunk.groupBy("call_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("chunk_idx", "_parts"))),
        lambda c: F.transform(c["_parts"], lambda p: F.concat_ws(":", c["chunk_idx"].cast("string"), p.cast("string"))))).alias("_d"))
    return per_call.select("call_id", F.size("_d").cast("long").alias("n_dropped"), F.array_join("_d", ",").alias("dropped"))


@query("form_filter", with_tables("registry", query="""
  SELECT event_id, route FROM registry JOIN nation ON n_name = country
  WHERE (n_regionkey = 1 AND route IN ('1-URGENT') AND status LIKE '%F%') OR (n_regionkey <> 1 AND (route = '2-HIGH' OR (route = '1-URGENT' AND status LIKE '%F%')))"""))
def form_filter(spark, folder):
    """Accepted forms depend on the country; the main form also needs its item."""
    reg = registry(spark, folder).join(table(spark, folder, "nation").select(F.col("n_name").alias("country"), "n_regionkey"), "country")
    forms = F.when(F.col("n_regionkey") == 1, F.array(F.lit("1-URGENT"))).otherwise(F.array(F.lit("2-HIGH"), F.lit("1-URGENT")))
    wanted = F.array_contains(forms, F.col("route")) & ((F.col("route") != "1-URGENT") | F.col("status").contains("F"))
    return reg.where(wanted).select("event_id", "route")


@query("positional_accuracy", with_tables("segments", query="""
  SELECT call_id, count(*) AS n_pairs, CAST(count(*) FILTER (lower(a) = lower(b)) AS DOUBLE) / max(n_ref) AS accuracy,
         greatest(0, 1 - CAST(count(*) FILTER (lower(a) = lower(b)) AS DOUBLE) / max(n_ref)) AS error_rate
  FROM (SELECT x.call_id, x.speaker_role AS a, CASE WHEN y.role = 'user' THEN 'analyst, firm' WHEN y.role = 'assistant' THEN 'Operator' ELSE 'OPERATOR' END AS b,
               count(*) OVER (PARTITION BY x.call_id) AS n_ref
        FROM segments x JOIN conversations y ON y.conv_id = x.call_id AND y.turn = x.idx) GROUP BY call_id"""))
def positional_accuracy(spark, folder):
    """Speaker labels compared position by position; shorter side decides the pairs, reference length the rate."""
    ref = call_segments(spark, folder).select("call_id", "idx", F.col("speaker_role").alias("ref"))
    hyp = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("call_id"), F.col("turn").alias("idx"),
        F.when(F.col("role") == "user", "analyst, firm").when(F.col("role") == "assistant", "Operator").otherwise("OPERATOR").alias("hyp"))
    sizes = ref.groupBy("call_id").agg(F.count(F.lit(1)).alias("_n"))
    hits = rel.positional_pairs(ref, hyp, ["call_id"], "idx").groupBy("call_id").agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_if(F.lower("ref") == F.lower("hyp")).alias("_h"))
    acc = F.col("_h") / F.col("_n")
    return hits.join(sizes, "call_id").select("call_id", "n_pairs", acc.alias("accuracy"), F.greatest(F.lit(0.0), 1 - acc).alias("error_rate"))
