"""Domain tables (segments, words, chunk metrics, crawl log, ...) derived from the supplied tables.

Every DataFrame builder has a SQL twin in ``SQL`` used by the oracles.  Times are integer tenths or hundredths of a
second until the last step, so both engines compute the same doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.operators.ordered import SLICE, running, slice_by


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def wide_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table about to go through costly per-row text work, spread over spark.callweave.textPartitions where that is set
    (tables of few files), else as it is scanned."""
    rows, parts = table(spark, folder, name), spark.conf.get("spark.callweave.textPartitions", None)
    return rows.repartition(int(parts)) if parts else rows


def word_array(text: Column) -> Column:
    """Whitespace-separated words; empty text gives an empty array."""
    squeezed = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.filter(F.split(squeezed, " "), lambda w: w != "")


def call_segments(spark: SparkSession, folder: str) -> DataFrame:
    """One row per conversation turn, spoken at 2.5 words a second with pauses.  A host turn ends by announcing the
    next questioner (a part's two-word name), the opening turn hands the call over."""
    turns = table(spark, folder, "conversations")
    names = table(spark, folder, "part").select(
        F.col("p_partkey").alias("_p"),
        F.initcap("p_name").alias("_person"),
        F.initcap(F.lower("p_type")).alias("_firm"),
    )
    cue = F.coalesce(
        F.concat(
            F.lit(" We will take our next question from "), "_person", F.lit(" with "), "_firm",
            F.lit(" Research. Please go ahead."),
        ),
        F.lit(""),
    )
    text = (
        F.when(F.col("role") == "system",
               F.concat(F.lit("Welcome to the conference call. I turn the call over to your host. "), "text"))
        .when(F.col("role") == "assistant", F.concat("text", cue))
        .otherwise(F.col("text"))
    )
    speaker = (
        F.when(F.col("role") == "system", F.lit("SPEAKER_00"))
        .when(F.col("role") == "assistant", F.lit("SPEAKER_01"))
        .otherwise(F.concat(F.lit("SPEAKER_0"), (F.lit(2) + F.floor(F.col("turn") / 3)).cast("string")))
    )
    rows = turns.join(names, F.expr("conv_id * 8 + turn") == F.col("_p"), "left").select(
        F.col("conv_id").alias("call_id"),
        F.col("turn").alias("idx"),
        F.when(F.col("role") == "system", "Operator").when(F.col("role") == "assistant", "Executive")
        .otherwise("Analyst, Firm").alias("speaker_role"),
        speaker.alias("speaker_id"),
        text.alias("text"),
    )
    rows = slice_by(rows.withColumn("n_words", F.size(word_array(F.col("text"))).cast("long")), "idx")
    pause = F.when(F.col("speaker_role") == "Analyst, Firm", 120).otherwise(0) + F.lit(5)
    rows = running(rows, ["call_id"], ["idx"], {"_end": ("sum", F.col("n_words") * 4)})
    start = F.col("_end") - F.col("n_words") * 4 + F.col("idx") * 5 + pause
    return rows.select(
        "call_id", "idx", "speaker_role", "speaker_id", "text", "n_words",
        (start / F.lit(10.0)).alias("start"), ((start + F.col("n_words") * 4) / F.lit(10.0)).alias("end"),
    )


def segment_words(segments: DataFrame) -> DataFrame:
    """One row per word of a segment with its position."""
    return segments.select("call_id", "idx", "start", "end", F.posexplode(word_array(F.col("text"))).alias("pos", "word"))


def chunk_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk processing facts: an order is a call, its line items are chunks of 45 s."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("call_id"),
        F.col("l_linenumber").alias("chunk_idx"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_quantity").cast("decimal(18,3)").alias("proc_time_sec"),
        F.lit(45).cast("decimal(18,3)").alias("duration_sec"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )


def crawl_log(spark: SparkSession, folder: str) -> DataFrame:
    """Crawl requests from events: status from props.k, time spent from value."""
    k = F.get_json_object("props", "$.k").cast("int")
    status = (
        F.when(k < 60, 200).when(k < 68, 404).when(k < 74, 403).when(k < 80, 429).when(k < 86, 500)
        .when(k < 92, 401).when(k < 96, 304)
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("request_id"),
        F.col("ts").cast("timestamp").alias("requested_at"),
        F.concat(F.lit("host"), F.col("user_id").cast("string"), F.lit(".example.com")).alias("domain"),
        F.col("event_type").alias("source"),
        status.alias("http_status"),
        (F.col("event_type") == "view").alias("from_cache"),
        F.col("value").cast("decimal(18,2)").alias("duration_ms"),
    )


def diarization_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Speaker turns from events: call = user, one minute of talk per unit of value (centiseconds as integers)."""
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").select(
        F.col("user_id").alias("call_id"),
        F.col("event_id").alias("turn_id"),
        start.alias("start_ms"),
        (start + (F.col("value").cast("decimal(18,2)") * 60000).cast("long")).alias("end_ms"),
        F.col("event_type").alias("speaker_id"),
    )


def registry(spark: SparkSession, folder: str) -> DataFrame:
    """Event registry: order = event, customer = company, first shipment = call time."""
    orders = table(spark, folder, "orders")
    first_ship = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_shipdate").alias("call_at")
    )
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return (
        orders.join(first_ship, "o_orderkey", "left")
        .join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            F.col("o_orderkey").alias("event_id"),
            F.col("c_custkey").alias("company_id"),
            F.col("n_name").alias("country"),
            F.col("c_mktsegment").alias("bucket"),
            F.col("o_orderpriority").alias("route"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").alias("announced_at"),
            F.col("call_at"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        )
    )


def spoken_text(text: Column) -> Column:
    """Renders written prose as speech: contractions, fillers and a figure in place of frequent short words."""
    for written, said in SPOKEN:
        text = F.replace(text, F.lit(written), F.lit(said))
    return text


# Rendering rules shared with the SQL twin: (written, said).
SPOKEN = [
    (" the ", " they're, um, "), (" of ", " don't "), (" and ", " it's $2.5B "), (" la ", " you know "),
    (" und ", " 1,250,000 "), (" to ", " 46.3% "), (" de ", " can't "), (" der ", " one "),
]


def heard_text(text: Column) -> Column:
    """A recogniser's version of a text: substitutions, deletions and insertions at frequent words."""
    for written, said in HEARD:
        text = F.replace(text, F.lit(written), F.lit(said))
    return text


HEARD = [(" the ", " a "), (" of ", " "), (" and ", " and and "), (" la ", " le "), (" und ", " "), (" der ", " der die ")]


def _replace_chain(column: str, rules: list[tuple[str, str]]) -> str:
    sql = column
    for written, said in rules:
        sql = "replace({}, '{}', '{}')".format(sql, written.replace("'", "''"), said.replace("'", "''"))
    return sql


def spoken_sql(column: str) -> str:
    return _replace_chain(column, SPOKEN)


def heard_sql(column: str) -> str:
    return _replace_chain(column, HEARD)


def words_sql(column: str) -> str:
    return f"list_filter(string_split(trim(regexp_replace({column}, '\\s+', ' ', 'g')), ' '), lambda w: w <> '')"


SQL = {
    "segments": f"""
segments_text AS (
  SELECT conv_id AS call_id, turn AS idx,
         CASE role WHEN 'system' THEN 'Operator' WHEN 'assistant' THEN 'Executive' ELSE 'Analyst, Firm' END AS speaker_role,
         CASE role WHEN 'system' THEN 'SPEAKER_00' WHEN 'assistant' THEN 'SPEAKER_01'
              ELSE 'SPEAKER_0' || CAST(2 + turn // 3 AS VARCHAR) END AS speaker_id,
         CASE role
           WHEN 'system' THEN 'Welcome to the conference call. I turn the call over to your host. ' || text
           WHEN 'assistant' THEN text || coalesce(' We will take our next question from '
             || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')
             || ' with ' || upper(p_type[1]) || lower(p_type[2:]) || ' Research. Please go ahead.', '')
           ELSE text END AS text
  FROM conversations LEFT JOIN part ON p_partkey = conv_id * 8 + turn),
segments_n AS (SELECT *, CAST(len({words_sql('text')}) AS BIGINT) AS n_words FROM segments_text),
segments_t AS (
  SELECT *, CAST(sum(n_words * 4) OVER (PARTITION BY call_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS BIGINT)
            - n_words * 4 + idx * 5 + 5 + CASE WHEN speaker_role = 'Analyst, Firm' THEN 120 ELSE 0 END AS s
  FROM segments_n),
segments AS (
  SELECT call_id, idx, speaker_role, speaker_id, text, n_words, s / 10e0 AS start, (s + n_words * 4) / 10e0 AS "end"
  FROM segments_t)""",
    "chunks": """
chunks AS (
  SELECT l_orderkey AS call_id, l_linenumber AS chunk_idx, l_partkey AS part_id,
         CAST(l_quantity AS DECIMAL(18,3)) AS proc_time_sec, CAST(45 AS DECIMAL(18,3)) AS duration_sec,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem)""",
    "crawl": """
crawl_k AS (SELECT *, CAST(props->>'$.k' AS INTEGER) AS k FROM events),
crawl AS (
  SELECT event_id AS request_id, ts AS requested_at, 'host' || CAST(user_id AS VARCHAR) || '.example.com' AS domain,
         event_type AS source,
         CASE WHEN k < 60 THEN 200 WHEN k < 68 THEN 404 WHEN k < 74 THEN 403 WHEN k < 80 THEN 429 WHEN k < 86 THEN 500
              WHEN k < 92 THEN 401 WHEN k < 96 THEN 304 END AS http_status,
         event_type = 'view' AS from_cache, CAST(value AS DECIMAL(18,2)) AS duration_ms
  FROM crawl_k)""",
    "turns": """
turns AS (
  SELECT user_id AS call_id, event_id AS turn_id, epoch_us(ts) // 1000 AS start_ms,
         epoch_us(ts) // 1000 + CAST(CAST(value AS DECIMAL(18,2)) * 60000 AS BIGINT) AS end_ms, event_type AS speaker_id
  FROM events)""",
    "registry": """
registry AS (
  SELECT o_orderkey AS event_id, c_custkey AS company_id, n_name AS country, c_mktsegment AS bucket,
         o_orderpriority AS route, o_orderstatus AS status, o_orderdate AS announced_at, call_at,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders
  LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS call_at FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey)""",
}


def with_tables(*names: str, more: str = "", query: str) -> str:
    """Assembles an oracle: domain tables, extra common tables, final query."""
    parts = [SQL[n].strip() for n in names] + ([more.strip().rstrip(",")] if more.strip() else [])
    return ("WITH " if parts else "") + ",\n".join(parts) + "\n" + query
