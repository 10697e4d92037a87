"""Queries that replay the tables as streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.operators import segments as seg, words as wd
from callweave.operators.ordered import neighbour, running, slice_by
from callweave.plans.adapters import call_segments, crawl_log, registry, table, with_tables
from callweave.plans.operations import one_row_per_chunk
from callweave.plans.transcripts import HEARD_CHUNKS, SECTIONED, SESSIONS, WORD_SQL, call_lengths, heard_words, timed_words
from callweave.sources.keyed_table import KeyedTable
from callweave.streaming import in_order, live

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


#: Calls start an hour apart on the replay's clock; arrival may be spread over all of it.
APART, SPREAD, NOBODY = 3600, "100000 days", -(1 << 31)


def call_at():
    return F.timestamp_seconds((F.col("call_id") + 1) * APART)


def stamped_words(spark, folder):
    """Words with event time: the call's start plus their offset in it."""
    return timed_words(spark, folder).select(
        "call_id", "seq", "word", "start", "end", "prob", call_at().alias("call_at"),
        F.timestamp_millis((F.col("start") * 1000).cast("long") + (F.col("call_id") + 1) * (APART * 1000)).alias("at"))


def far_rows(rows, *times: str):
    """One row of call NOBODY, far ahead of all others: it moves the watermark past them once they have all arrived."""
    far = rows.agg(*((F.max(t) + F.expr("interval 200000 days")).alias(t) for t in times)).withColumn("call_id", F.lit(NOBODY))
    return far.select(*(F.col(c).cast(rows.schema[c].dataType) if c in far.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in rows.columns))


def windows_live(words, files=None):
    return live.drain_updates(live.chunk_windows(live.replay(words.select("call_id", "start", "call_at"), files), SPREAD), ["call_id", "window_sec"])


@query("stream_chunk_windows", with_tables("segments", more=WORD_SQL, query="""
  SELECT call_id, CAST(k * 57 AS BIGINT) AS window_sec, count(*) AS n_words FROM (
    SELECT call_id, CAST(start * 1000 AS BIGINT) AS ms FROM seqd), LATERAL (SELECT unnest([ms // 57000, ms // 57000 - 1]) AS k)
  WHERE ms >= k * 57000 AND ms < k * 57000 + 60000 GROUP BY ALL"""))
def stream_chunk_windows(spark, folder):
    return windows_live(stamped_words(spark, folder))


def pauses_live(words, files=None):
    rows = words.select("call_id", "call_at", "at")
    return live.drain(live.pause_sessions(live.replay(rows, files, last=far_rows(rows, "at")), SPREAD)).where(F.col("call_id") != NOBODY)


@query("stream_pause_sessions", with_tables("segments", more=WORD_SQL + """,
ms AS (SELECT call_id, seq, CAST(floor(start * 1000) AS BIGINT) AS t FROM seqd),
cut AS (SELECT *, CASE WHEN t - lag(t) OVER w < 1200 THEN 0 ELSE 1 END AS opens FROM ms WINDOW w AS (PARTITION BY call_id ORDER BY t, seq)),
ses AS (SELECT *, sum(opens) OVER (PARTITION BY call_id ORDER BY t, seq ROWS UNBOUNDED PRECEDING) AS n FROM cut)""", query="""
  SELECT call_id, min(t) AS from_ms, max(t) + 1200 AS to_ms, count(*) AS n_words FROM ses GROUP BY call_id, n"""))
def stream_pause_sessions(spark, folder):
    """Utterances by pauses alone; the last row of the replay closes them all."""
    return pauses_live(stamped_words(spark, folder))


def utterances_live(words, files=None):
    rows = in_order.with_end_markers(words, "seq", "at").select("call_id", "position", "at", "closes", "word", "start", "end", "prob")
    return live.drain(in_order.utterances(live.replay(rows, files), SPREAD))


@query("stream_utterances", SESSIONS)
def stream_utterances(spark, folder):
    """Utterances by all three rules, as word_sessions has them in batch."""
    return utterances_live(stamped_words(spark, folder))


@query("stream_crawl_monitor", with_tables("crawl", query="""
  SELECT date_trunc('hour', requested_at) AS window_start, source, http_status, count(*) AS n, CAST(sum(duration_ms) AS DOUBLE) AS total_ms FROM crawl GROUP BY ALL"""))
def stream_crawl_monitor(spark, folder):
    rows = live.drain_updates(live.crawl_monitor(live.replay(crawl_log(spark, folder))), ["window_start", "source", "http_status"])
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn("total_ms", F.col("total_ms").cast("double"))


@query("request_spacing", with_tables("crawl", query="""
  SELECT domain, count(*) AS n, count(*) FILTER (gap < 2500000) AS too_close FROM (
    SELECT domain, epoch_us(requested_at) - lag(epoch_us(requested_at)) OVER (PARTITION BY domain ORDER BY requested_at, request_id) AS gap FROM crawl) GROUP BY domain"""))
def request_spacing(spark, folder):
    """Requests of a domain closer than 2.5 s."""
    rows = crawl_log(spark, folder).withColumn("us", F.unix_micros("requested_at"))
    rows = neighbour(slice_by(rows, "us", 86_400_000_000.0), ["domain"], ["us", "request_id"], {"_before": F.col("us")}, ahead=False)
    return rows.groupBy("domain").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("us") - F.col("_before") < 2_500_000).alias("too_close"))


def own_words_live(heard, files=None, twice=False):
    """Chunk words and an end marker per call: the last chunk's number and the number of rows."""
    rows = heard.withColumn("closes", F.lit(False))
    ends = rows.groupBy("call_id").agg(
        F.max("chunk_idx").alias("chunk_idx"), F.count(F.lit(1)).alias("seq"), F.max("at").alias("at")).withColumn("closes", F.lit(True))
    rows = rows.unionByName(ends.withColumn("seq", F.col("seq").cast(rows.schema["seq"].dataType)), allowMissingColumns=True)
    return live.drain(live.own_words_live(live.replay(rows.unionByName(rows) if twice else rows, files), SPREAD))


@query("stream_own_words", with_tables("segments", more=HEARD_CHUNKS, query="""
  SELECT call_id, chunk_idx, seq, word, start FROM (
    SELECT *, start_sec + 57 AS next_start, max(chunk_idx) OVER (PARTITION BY call_id) AS top FROM heard)
  WHERE (chunk_idx = 0 OR start >= start_sec + 1.5) AND (chunk_idx = top OR start < next_start + 1.5)"""))
def stream_own_words(spark, folder):
    """Words of overlapping chunks, each once."""
    plan = wd.chunk_plan(call_lengths(spark, folder))
    return own_words_live(heard_words(spark, folder, plan).select(
        "call_id", "chunk_idx", "seq", "word", "start",
        F.timestamp_millis((F.col("start") * 1000).cast("long") + (F.col("call_id") + 1) * (APART * 1000)).alias("at")))


BACKLOG = """
c AS (SELECT call_id, chunk_idx, max(proc_time_sec) AS p, max(duration_sec) AS d FROM chunks GROUP BY 1, 2),
x AS (SELECT *, sum(p - d) OVER w AS s FROM c WINDOW w AS (PARTITION BY call_id ORDER BY chunk_idx ROWS UNBOUNDED PRECEDING))"""
BACKLOG_QUERY = """
  SELECT call_id, chunk_idx, CAST(s - least(0, min(s) OVER (PARTITION BY call_id ORDER BY chunk_idx ROWS UNBOUNDED PRECEDING)) AS DOUBLE) AS backlog_sec, p < d AS drained FROM x"""


def backlog_live(chunks, files=None):
    """A call's recorder numbers its chunks from 0 and says when it ends."""
    rank = slice_by(chunks, "chunk_idx")
    rows = running(rank, ["call_id"], ["chunk_idx"], {"_n": ("sum", F.lit(1))}).withColumn("n", F.col("_n") - 1)
    rows = rows.withColumn("at", F.timestamp_seconds((F.col("call_id") + 1) * APART + F.col("n") * 45))
    rows = in_order.with_end_markers(rows, "n", "at").select("call_id", "position", "at", "closes", "chunk_idx", "proc_time_sec", "duration_sec")
    return live.drain(in_order.backlog(live.replay(rows, files), SPREAD))


@query("stream_backlog", with_tables("chunks", more=BACKLOG, query=BACKLOG_QUERY))
def stream_backlog(spark, folder):
    return backlog_live(one_row_per_chunk(spark, folder))


@query("chunk_backlog", with_tables("chunks", more=BACKLOG, query=BACKLOG_QUERY))
def chunk_backlog(spark, folder):
    """The same backlog in batch: a running sum over its own running minimum."""
    rows = slice_by(one_row_per_chunk(spark, folder), "chunk_idx")
    rows = running(rows, ["call_id"], ["chunk_idx"], {"_s": ("sum", F.col("proc_time_sec") - F.col("duration_sec"))})
    rows = running(rows, ["call_id"], ["chunk_idx"], {"_m": ("min", F.col("_s"))})
    return rows.select("call_id", "chunk_idx", (F.col("_s") - F.least(F.col("_m"), F.lit(0))).cast("double").alias("backlog_sec"),
                       (F.col("proc_time_sec") < F.col("duration_sec")).alias("drained"))


def sections_live(segments, files=None):
    opens_qa, opens_remarks = seg.section_cues()
    rows = segments.withColumn("level", F.when(opens_qa, 2).when(opens_remarks, 1).otherwise(0))
    rows = rows.withColumn("at", F.timestamp_seconds((F.col("call_id") + 1) * APART + F.col("start")))
    rows = in_order.with_end_markers(rows, "idx", "at").select("call_id", "position", "at", "closes", "idx", "level")
    return live.drain(in_order.sections(live.replay(rows, files), SPREAD))


@query("stream_sections", with_tables("segments", more=SECTIONED, query="SELECT call_id, idx, section FROM sectioned"))
def stream_sections(spark, folder):
    return sections_live(call_segments(spark, folder))


@query("stream_drop_log", """
SELECT rule, count(*) AS n FROM (SELECT CASE WHEN CAST(props->>'$.k' AS INTEGER) > 60 AND value > 60 THEN 'quiet' WHEN value > 120 THEN 'weak' ELSE 'kept' END AS rule FROM events) GROUP BY rule""")
def stream_drop_log(spark, folder):
    raw = table(spark, folder, "events").select(
        "event_id", F.lit("revenue grew again this quarter").alias("text"), (0 - F.col("value") / F.lit(100.0)).alias("avg_logprob"),
        (F.get_json_object("props", "$.k").cast("int") / F.lit(100.0)).alias("no_speech_prob"))
    path = live.scratch(spark)
    live.split_hallucinations(live.replay(raw), f"{path}/kept", f"{path}/dropped", f"{path}/checkpoint").awaitTermination()
    kept = spark.read.parquet(f"{path}/kept").select(F.lit("kept").alias("rule"))
    dropped = spark.read.parquet(f"{path}/dropped").select(F.when(F.col("rule").startswith("no_speech"), "quiet").otherwise("weak").alias("rule"))
    return kept.unionByName(dropped).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("stream_registry_upsert", with_tables("registry", query="""
SELECT company_id, (r).event_id AS event_id, (r).route AS route FROM (
  SELECT company_id, max_by({'event_id': event_id, 'route': route}, (announced_at, event_id)) AS r FROM registry GROUP BY company_id)"""))
def stream_registry_upsert(spark, folder):
    rows = registry(spark, folder).select("company_id", "event_id", "route", F.col("announced_at").cast("timestamp").alias("announced_at"))
    path = live.scratch(spark)
    kept = KeyedTable(spark, f"{path}/table", ["company_id"], F.struct("announced_at", "event_id"), most_deltas=3)
    live.upsert_stream(live.replay(rows, 4), kept, f"{path}/checkpoint").awaitTermination()
    return kept.read().select("company_id", "event_id", "route")


@query("stream_late_corrections", with_tables("segments", more=WORD_SQL, query="""
  SELECT call_id, seq, CASE WHEN length(word) > 8 THEN word || '*' ELSE word END AS word, CASE WHEN length(word) > 8 THEN 1 ELSE 0 END AS pass_no FROM seqd"""))
def stream_late_corrections(spark, folder):
    """Long words heard again come after everything else, past the watermark, and replace the first hearing."""
    words = stamped_words(spark, folder).select("call_id", "seq", "word", "at")
    again = words.where(F.length("word") > 8).withColumn("word", F.concat("word", F.lit("*")))
    far = far_rows(words, "at")
    path = live.scratch(spark)
    kept = KeyedTable(spark, f"{path}/table", ["call_id", "seq"], F.struct("pass_no", "at", "word"))
    # Three batches, each a run of the stream from where the one before stopped: what is heard in time, a row that moves the watermark, what
    # comes after it. A batch is as many files as its rows were written by.
    source = f"{path}/in"
    for rows in (words, far, again):
        rows.write.mode("append").parquet(source)
        stream = spark.readStream.schema(words.schema).parquet(source)
        live.late_corrections(stream, "at", 86_400 * 365 * 100, kept, f"{path}/late", f"{path}/checkpoint").awaitTermination()
    return kept.read().where(F.col("call_id") != NOBODY).select("call_id", "seq", "word", "pass_no")


def alerts_live(ended, published, seconds, files=None):
    return live.drain(live.sla_alerts(
        live.replay(ended, files, last=far_rows(ended, "ended_at")), live.replay(published, files, last=far_rows(published, "published_at")),
        seconds=seconds, delay=SPREAD)).where(F.col("call_id") != NOBODY)


@query("stream_sla_alerts", """
SELECT o_orderkey AS call_id, CAST(o_orderdate AS TIMESTAMP) AS ended_at, CASE WHEN p >= o_orderdate AND p <= o_orderdate + INTERVAL 36 HOUR THEN p END AS published_at,
  NOT coalesce(p >= o_orderdate AND p <= o_orderdate + INTERVAL 36 HOUR, false) AS late
FROM orders LEFT JOIN (SELECT l_orderkey, CAST(min(l_shipdate) AS TIMESTAMP) AS p FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def stream_sla_alerts(spark, folder):
    """Orders as ended calls, their shipments as publications: which calls were published within a day and a half."""
    ended = table(spark, folder, "orders").select(F.col("o_orderkey").alias("call_id"), F.col("o_orderdate").cast("timestamp").alias("ended_at"))
    shipped = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("call_id")).agg(F.min("l_shipdate").cast("timestamp").alias("published_at"))
    rows = alerts_live(ended, shipped, 129_600)
    return rows.withColumn("ended_at", F.col("ended_at").cast("timestamp_ntz")).withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))
