"""Queries over segments, words and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv
from callweave.operators import intervals, segments as seg, words as wd
from callweave.operators.ordered import running, slice_by
from callweave.plans.adapters import (
    call_segments, diarization_turns, segment_words, table, with_tables, word_array, words_sql,
)
from callweave.session import cut_lineage

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


def _alt(patterns: list[str]) -> str:
    return ("(?i)(?:" + "|".join(patterns) + ")").replace("'", "''")


SECTIONED = f"""
marks AS (
  SELECT *,
    ((regexp_matches(text, '{_alt(fv.QA_CUES)}') AND NOT regexp_matches(text, '{_alt(fv.QA_DISCLAIMER_CUES)}')
      AND (idx > 3 OR start > 120)) OR speaker_role LIKE 'Analyst,%') AS is_qa,
    ((regexp_matches(text, '{_alt(fv.REMARKS_CUES)}') AND idx > 0) OR (idx >= 2 AND speaker_role <> 'Operator')) AS is_rem
  FROM segments),
firsts AS (SELECT call_id, min(idx) FILTER (is_qa) AS q, min(idx) FILTER (is_rem) AS r FROM marks GROUP BY call_id),
sectioned AS (
  SELECT m.*, CASE WHEN idx >= q THEN 'qa' WHEN idx >= r THEN 'prepared_remarks' ELSE 'operator_intro' END AS section
  FROM marks m JOIN firsts USING (call_id))"""


@query("section_totals", with_tables("segments", more=SECTIONED, query="""
  SELECT call_id, section, count(*) AS n_segments, CAST(sum(n_words) AS BIGINT) AS n_words,
         CAST(sum(CAST("end" - start AS DECIMAL(18,3))) AS DOUBLE) AS spoken_sec
  FROM sectioned GROUP BY ALL"""))
def section_totals(spark: SparkSession, folder: str) -> DataFrame:
    return seg.section_totals(seg.label_sections(call_segments(spark, folder)))


@query("section_labels", with_tables("segments", more=SECTIONED, query="SELECT call_id, idx, section FROM sectioned"))
def section_labels(spark, folder):
    return seg.label_sections(call_segments(spark, folder)).select("call_id", "idx", "section")


@query("section_counts_map", with_tables("segments", more=SECTIONED, query="""
  SELECT call_id, count(*) FILTER (section = 'operator_intro') AS n_intro,
         count(*) FILTER (section = 'prepared_remarks') AS n_remarks, count(*) FILTER (section = 'qa') AS n_qa,
         CASE WHEN count(*) FILTER (section = 'qa') = 0 THEN 'NO_QA_DETECTED' END AS qa_warning
  FROM sectioned GROUP BY call_id"""))
def section_counts_map(spark, folder):
    counts = seg.section_counts(seg.label_sections(call_segments(spark, folder)))
    return counts.select(
        "call_id", F.col("section_counts")["operator_intro"].alias("n_intro"),
        F.col("section_counts")["prepared_remarks"].alias("n_remarks"),
        F.col("qa_segments").alias("n_qa"), "qa_warning",
    )


@query("segment_gaps", with_tables("segments", query="""
  SELECT call_id, idx, "end", lead(start) OVER w AS next_start, lead(start) OVER w - "end" AS gap_sec
  FROM segments WINDOW w AS (PARTITION BY call_id ORDER BY idx)"""))
def segment_gaps(spark, folder):
    return seg.with_next_gap(call_segments(spark, folder)).select("call_id", "idx", "end", "next_start", "gap_sec")


@query("segment_gap_stats", with_tables("segments", query="""
  SELECT call_id, count(*) FILTER (g > 10) AS gaps_count,
         CAST(coalesce(sum(CAST(g AS DECIMAL(18,2))) FILTER (g > 10), 0) AS DOUBLE) AS missing_sec,
         count(*) FILTER (ns < "end" - 0.5e0) AS overlaps,
         count(*) FILTER (t <> '' AND t = nt AND n_words > 3) AS duplicates
  FROM (SELECT *, lead(start) OVER w AS ns, lead(start) OVER w - "end" AS g, lead(t) OVER w AS nt
        FROM (SELECT *, lower(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS t FROM segments)
        WINDOW w AS (PARTITION BY call_id ORDER BY idx))
  GROUP BY call_id"""))
def segment_gap_stats(spark, folder):
    return seg.gap_stats(call_segments(spark, folder))


@query("ordered_text_assembly", with_tables("segments", more=SECTIONED, query="""
  SELECT call_id, section, string_agg(text, ' ' ORDER BY idx) AS text FROM sectioned GROUP BY ALL"""))
def ordered_text_assembly(spark, folder):
    return seg.assemble_text(seg.label_sections(call_segments(spark, folder)), ["call_id", "section"])


RUNS = """
lagged AS (SELECT *, CASE WHEN lag(speaker_id) OVER w IS NOT DISTINCT FROM speaker_id AND lag(idx) OVER w IS NOT NULL
                          THEN 0 ELSE 1 END AS opens
           FROM segments WINDOW w AS (PARTITION BY call_id ORDER BY idx)),
runs AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY call_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_no FROM lagged)"""


@query("speaker_runs", with_tables("segments", more=RUNS, query="""
  SELECT call_id, run_no, min(speaker_id) AS speaker_id, min(idx) AS first_idx, max(idx) AS last_idx,
         count(*) AS n_segments, min(start) AS start, max("end") AS "end" FROM runs GROUP BY call_id, run_no"""))
def speaker_runs(spark, folder):
    return seg.speaker_runs(call_segments(spark, folder))


@query("speaker_runs_close", with_tables("turns", more="""
lagged AS (SELECT *, CASE WHEN lag(speaker_id) OVER w IS NOT DISTINCT FROM speaker_id
                           AND abs(start_ms - lag(end_ms) OVER w) < 36000000 THEN 0 ELSE 1 END AS opens
           FROM turns WINDOW w AS (PARTITION BY call_id ORDER BY turn_id)),
runs AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY call_id ORDER BY turn_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS run_no FROM lagged)""",
       query="""SELECT call_id, run_no, min(speaker_id) AS speaker_id, min(turn_id) AS first_idx, max(turn_id) AS last_idx,
         count(*) AS n_segments, min(start_ms) AS start, max(end_ms) AS "end" FROM runs GROUP BY call_id, run_no"""))
def speaker_runs_close(spark, folder):
    """Diarization turns merged while the speaker stays and the gap is under ten hours of event time."""
    turns = diarization_turns(spark, folder).withColumnsRenamed({"turn_id": "idx", "start_ms": "start", "end_ms": "end"})
    return seg.speaker_runs(turns, max_gap=36_000_000)


@query("next_other_speaker", with_tables("segments", query="""
  SELECT call_id, idx, speaker_id,
    (SELECT min_by(b.speaker_id, b.idx) FROM segments b WHERE b.call_id = a.call_id AND b.idx > a.idx
      AND b.speaker_id <> a.speaker_id AND b.speaker_role <> 'Operator') AS next_speaker
  FROM segments a WHERE speaker_role <> 'Operator'"""))
def next_other_speaker(spark, folder):
    rows = seg.next_other_speaker(call_segments(spark, folder), F.col("speaker_role") == "Operator")
    return rows.select("call_id", "idx", "speaker_id", "next_speaker")


@query("top_speakers", with_tables("segments", query="""
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY call_id ORDER BY n_segments DESC, first_idx) AS INTEGER) AS rank
    FROM (SELECT call_id, speaker_id, speaker_role, count(*) AS n_segments, min(idx) AS first_idx FROM segments GROUP BY ALL))
  WHERE rank <= 6"""))
def top_speakers(spark, folder):
    return seg.top_speakers(call_segments(spark, folder))


@query("intro_context", with_tables("segments", query="""
  SELECT call_id, string_agg(text, ' ' ORDER BY idx) AS text FROM segments WHERE idx < 35 GROUP BY call_id"""))
def intro_context(spark, folder):
    return seg.opening_text(call_segments(spark, folder))


@query("speech_without_operator", with_tables("segments", query="""
  SELECT call_id, count(*) AS n_segments, CAST(sum(n_words) AS BIGINT) AS n_words
  FROM segments WHERE speaker_role IS DISTINCT FROM 'Operator' GROUP BY call_id"""))
def speech_without_operator(spark, folder):
    rows = seg.speech_only(call_segments(spark, folder))
    return rows.groupBy("call_id").agg(F.count(F.lit(1)).alias("n_segments"), F.sum("n_words").alias("n_words"))


# --- words and chunks -------------------------------------------------------------------------------------------

WORD_SQL = f"""
seg_words AS (SELECT *, {words_sql('text')} AS ws FROM segments),
times AS (
  SELECT call_id, idx, speaker_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos, start AS s, ("end" - start) / len(ws) AS step
  FROM seg_words),
timed AS (SELECT call_id, idx, pos, word, round(s + pos * step, 3) AS start, round(s + (pos + 1) * step, 3) AS "end" FROM times),
sized AS (SELECT call_id, idx, sum(n_words) OVER (PARTITION BY call_id ORDER BY idx ROWS UNBOUNDED PRECEDING) - n_words AS before FROM segments),
seqd AS (SELECT t.*, CAST(before + pos AS BIGINT) AS seq, least(1, exp(-len(word) / 10e0)) AS prob FROM timed t JOIN sized USING (call_id, idx))"""


def timed_words(spark, folder) -> DataFrame:
    """Words of all calls with times, a dense position per call and a confidence that falls with word length."""
    rows = running(slice_by(call_segments(spark, folder), "idx"), ["call_id"], ["idx"], {"_upto": ("sum", F.col("n_words"))})
    rows = rows.withColumn("_before", F.col("_upto") - F.col("n_words")).select(
        "call_id", "idx", "_before", "start", "end", "text")
    words = wd.word_times(rows, word_array(F.col("text")))
    # Deployments store words as a table; here they are derived once per query and read by several branches.
    return cut_lineage(words.select(
        "call_id", "idx", "pos", "word", "start", "end", (F.col("_before") + F.col("pos")).alias("seq"),
        wd.word_probability(-F.length("word") / F.lit(10.0)).alias("prob"),
    ))


@query("word_times", with_tables("segments", more=WORD_SQL, query='SELECT call_id, idx, pos, word, start, "end" FROM timed'))
def word_times(spark, folder):
    return wd.word_times(
        call_segments(spark, folder).select("call_id", "idx", "start", "end", "text"), word_array(F.col("text"))
    ).select("call_id", "idx", F.col("pos").cast("long").alias("pos"), "word", "start", "end")


SESSIONS = with_tables("segments", more=WORD_SQL + """,
lagw AS (SELECT *, lag("end") OVER w AS pe, lag(word) OVER w AS pw FROM seqd WINDOW w AS (PARTITION BY call_id ORDER BY seq)),
opened AS (SELECT *, CASE WHEN pe IS NULL OR start - pe > 1.2e0 OR (regexp_matches(pw, '[.!?]\\s*$') AND start - pe > 0.3e0) THEN 1 ELSE 0 END AS opens FROM lagw),
sess AS (SELECT *, CAST(sum(opens) OVER w AS BIGINT) AS session, max(CASE WHEN opens = 1 THEN seq END) OVER w AS first
         FROM opened WINDOW w AS (PARTITION BY call_id ORDER BY seq ROWS UNBOUNDED PRECEDING))""", query="""
  SELECT call_id, session, CAST((seq - first) // 25 AS BIGINT) AS part, min(start) AS start, max_by("end", seq) AS "end",
         trim(regexp_replace(string_agg(word, ' ' ORDER BY seq), ' +([,.!?:;%…])', '\\1', 'g')) AS text,
         CAST(sum(CAST(prob AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS confidence, count(*) AS n_words
  FROM sess GROUP BY call_id, session, (seq - first) // 25""")


@query("word_sessions", SESSIONS)
def word_sessions(spark, folder):
    return wd.utterances(timed_words(spark, folder))


CALLS = """
calls AS (SELECT call_id, max("end") AS duration_sec FROM segments GROUP BY call_id),
plan AS (
  SELECT call_id, duration_sec, CAST(k AS INTEGER) AS chunk_idx, k * 57e0 AS start_sec, least(k * 57e0 + 60, duration_sec) AS end_sec, k = n - 1 AS is_final
  FROM (SELECT *, greatest(1, CAST(ceil((duration_sec - 60) / 57e0) AS INTEGER) + 1) AS n FROM calls WHERE duration_sec > 0),
       LATERAL (SELECT unnest(range(n)) AS k))"""


def call_lengths(spark, folder) -> DataFrame:
    return call_segments(spark, folder).groupBy("call_id").agg(F.max("end").alias("duration_sec"))


@query("chunk_plan", with_tables("segments", more=CALLS, query="""
  SELECT call_id, duration_sec, chunk_idx, start_sec, end_sec, is_final, round(end_sec - start_sec, 3) AS chunk_sec FROM plan"""))
def chunk_plan(spark, folder):
    return wd.chunk_plan(call_lengths(spark, folder))


HEARD_CHUNKS = WORD_SQL + "," + CALLS + """,
heard AS (SELECT w.*, p.chunk_idx, p.start_sec, p.duration_sec FROM seqd w JOIN plan p
          ON w.call_id = p.call_id AND w.start >= p.start_sec AND w.start < p.end_sec)"""


def heard_words(spark, folder, plan: DataFrame) -> DataFrame:
    """Words as every chunk heard them: a word inside an overlap is heard twice.  The one or two candidate chunks follow
    from the word's time, so this is an equi-join."""
    k = F.floor(F.col("start") / (fv.CHUNK_SEC - fv.CHUNK_OVERLAP_SEC)).cast("int")
    words = timed_words(spark, folder).withColumn("chunk_idx", F.explode(F.array(k, k - 1)))
    bounds = plan.select("call_id", "chunk_idx", "start_sec", "end_sec")
    return words.join(bounds, ["call_id", "chunk_idx"]).where(
        (F.col("start") >= F.col("start_sec")) & (F.col("start") < F.col("end_sec")))


@query("boundary_ownership", with_tables("segments", more=HEARD_CHUNKS + """,
bounds AS (SELECT call_id, chunk_idx, CASE WHEN chunk_idx = 0 THEN 0 ELSE start_sec + 1.5e0 END AS l,
                  coalesce(lead(start_sec) OVER (PARTITION BY call_id ORDER BY chunk_idx) + 1.5e0, duration_sec) AS r FROM plan)""",
       query="""SELECT h.call_id, h.seq, h.word, h.start, h.chunk_idx FROM heard h JOIN bounds b
         ON h.call_id = b.call_id AND h.chunk_idx = b.chunk_idx WHERE h.start >= l AND h.start < r"""))
def boundary_ownership(spark, folder):
    plan = wd.chunk_plan(call_lengths(spark, folder))
    return wd.own_words(heard_words(spark, folder, plan), plan).select("call_id", "seq", "word", "start", "chunk_idx")


@query("repass_windows", with_tables("segments", more=CALLS + """,
raw AS (SELECT s.call_id, p.chunk_idx, s.idx AS seg_idx, s.start - p.start_sec AS start, s."end" - p.start_sec AS "end",
               s.text || CASE WHEN s.speaker_role = 'Executive' THEN '...' ELSE '' END AS text,
               round(p.end_sec - p.start_sec, 3) AS chunk_sec
        FROM segments s JOIN plan p ON s.call_id = p.call_id AND CAST(floor(s.start / 57e0) AS INTEGER) = p.chunk_idx),
near AS (SELECT *, coalesce(lead(start) OVER w, chunk_sec) AS until, lag(start) OVER w AS ps FROM raw
         WINDOW w AS (PARTITION BY call_id, chunk_idx ORDER BY seg_idx))""", query="""
  SELECT call_id, chunk_idx, seg_idx, 'gap' AS kind, greatest(0, "end") AS from_sec, least(chunk_sec, until) AS to_sec FROM near
  WHERE (until - "end" > 5 OR (regexp_matches(text, '(\\.\\.\\.|…)\\s*$') AND until - "end" > 2))
    AND least(chunk_sec, until) - greatest(0, "end") >= 3
  UNION ALL SELECT call_id, chunk_idx, seg_idx, 'lead_in', 0, start FROM near WHERE ps IS NULL AND start > 5"""))
def repass_windows(spark, folder):
    plan = wd.chunk_plan(call_lengths(spark, folder)).select("call_id", "chunk_idx", "start_sec", "chunk_sec")
    raw = call_segments(spark, folder).withColumn("chunk_idx", F.floor(F.col("start") / 57.0).cast("int"))
    raw = raw.join(plan, ["call_id", "chunk_idx"]).select(
        "call_id", "chunk_idx", F.col("idx").alias("seg_idx"),
        (F.col("start") - F.col("start_sec")).alias("start"), (F.col("end") - F.col("start_sec")).alias("end"),
        F.concat("text", F.when(F.col("speaker_role") == "Executive", "...").otherwise("")).alias("text"), "chunk_sec",
    )
    return wd.repass_windows(raw)


CHUNK_WORDS, CHUNK_SHARED = 23, 3


@query("suffix_prefix_overlap", f"""
WITH d AS (SELECT doc_id AS call_id, {words_sql('text')} AS ws FROM documents),
c AS (SELECT call_id, k AS chunk_idx, ws[k * 20 + 1 : k * 20 + 23] AS words FROM d,
      LATERAL (SELECT unnest(range(greatest(1, (len(ws) + 19) // 20))) AS k)),
l AS (SELECT *, lag(words) OVER (PARTITION BY call_id ORDER BY chunk_idx) AS prev FROM c),
b AS (SELECT call_id, chunk_idx, words,
        list_transform(coalesce(prev[-15:], []), lambda w: regexp_replace(lower(w), '^[.,!?:;"'']+|[.,!?:;"'']+$', '', 'g')) AS b,
        list_transform(words[1:15], lambda w: regexp_replace(lower(w), '^[.,!?:;"'']+|[.,!?:;"'']+$', '', 'g')) AS h FROM l),
k AS (SELECT *, coalesce(list_max(list_filter(range(1, least(len(b), len(h)) + 1), lambda n: b[len(b) - n + 1 : len(b)] = h[1 : n])), 0) AS dropped FROM b)
SELECT call_id, CAST(chunk_idx AS BIGINT) AS chunk_idx, CAST(dropped AS BIGINT) AS dropped,
       array_to_string(words[dropped + 1 : len(words)], ' ') AS text FROM k""")
def suffix_prefix_overlap(spark, folder):
    """Documents cut into 23-word chunks sharing 3 words with the next chunk, then stitched."""
    step = CHUNK_WORDS - CHUNK_SHARED
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("call_id"), word_array(F.col("text")).alias("_w"))
    n = F.greatest(F.lit(1), F.ceil(F.size("_w") / step)).cast("int")
    chunks = docs.select(
        "call_id", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.slice("_w", k * step + 1, CHUNK_WORDS)))
        .alias("chunk_idx", "words"),
    )
    out = wd.drop_repeated_prefix(chunks)
    return out.withColumn("chunk_idx", F.col("chunk_idx").cast("long")).withColumn("dropped", F.col("dropped").cast("long"))


@query("segment_stitch", with_tables("segments", more="""
w AS (SELECT call_id, idx // 2 - o AS part_no, idx, start + o * 0.5e0 AS start, "end" + o * 0.5e0 AS "end", text
      FROM segments, (VALUES (0), (1)) v(o) WHERE idx // 2 - o >= 0),
b AS (SELECT call_id, part_no + 1 AS pair, idx, start, "end", regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM w),
l AS (SELECT call_id, pair, max_by("end", idx) - 3e0 + 0.1e0 AS cutoff FROM b GROUP BY ALL),
a AS (SELECT w.*, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t, cutoff FROM w LEFT JOIN l ON w.call_id = l.call_id AND w.part_no = l.pair WHERE part_no > 0)""",
       query="""SELECT call_id, part_no AS pair, idx, start, "end" FROM a WHERE NOT EXISTS (
         SELECT 1 FROM b WHERE b.call_id = a.call_id AND b.pair = a.part_no AND b.t = a.t
          AND (abs(b."end" - a."end") < 2 OR a.start < a.cutoff))"""))
def segment_stitch(spark, folder):
    """Four-turn chunks sharing two turns with the chunk before: what the later chunk of each pair adds."""
    late = F.col("_o") * F.lit(0.5)
    parts = (
        call_segments(spark, folder).withColumn("_o", F.explode(F.array(F.lit(0), F.lit(1))))
        .select("call_id", (F.floor(F.col("idx") / 2) - F.col("_o")).alias("pair"), "idx",
                (F.col("start") + late).alias("start"), (F.col("end") + late).alias("end"), "text")
        .where(F.col("pair") >= 0)
    )
    before = parts.withColumn("pair", F.col("pair") + 1)
    out = wd.stitch_pairs(before, parts.where(F.col("pair") > 0), ["call_id", "pair"])
    return out.where(F.col("part") == 1).select("call_id", "pair", "idx", "start", "end")


@query("hallucination_filter", """
WITH raw AS (SELECT event_id, CASE event_type WHEN 'view' THEN 'Thanks for watching this ' WHEN 'signup' THEN 'Please subscribe to our channel ' ELSE 'revenue grew ' END
                 || repeat('again ', CAST(CAST(props->>'$.k' AS INTEGER) % 9 AS INTEGER)) AS text,
             (0 - floor(value)) / 100e0 AS lp, CAST(props->>'$.k' AS INTEGER) / 100e0 AS ns FROM events),
n AS (SELECT *, len(list_filter(regexp_split_to_array(trim(lower(text)), '\\s+'), lambda w: w <> '')) <= 6 OR lp < -0.4e0 AS odd FROM raw)
SELECT event_id, lp AS avg_logprob, ns AS no_speech_prob,
  CASE WHEN lower(text) LIKE '%thanks for watching%' AND odd THEN 'phrase (''thanks for watching'')'
       WHEN lower(text) LIKE '%please subscribe%' AND odd THEN 'phrase (''please subscribe'')'
       WHEN lower(text) LIKE '%subscribe to our channel%' AND odd THEN 'phrase (''subscribe to our channel'')'
       WHEN ns > 0.6e0 AND lp < -0.6e0 THEN 'no_speech_prob (' || printf('%.2f', ns) || ' > 0.6) & avg_logprob (' || printf('%.2f', lp) || ' < -0.6)'
       WHEN lp < -1.2e0 THEN 'avg_logprob (' || printf('%.2f', lp) || ' < -1.2)' END AS rule
FROM n""")
def hallucination_filter(spark, folder):
    k = F.get_json_object("props", "$.k").cast("int")
    raw = table(spark, folder, "events").select(
        "event_id",
        F.concat(
            F.when(F.col("event_type") == "view", "Thanks for watching this ")
            .when(F.col("event_type") == "signup", "Please subscribe to our channel ").otherwise("revenue grew "),
            F.expr("repeat('again ', cast(get_json_object(props, '$.k') as int) % 9)"),
        ).alias("text"),
        ((0 - F.floor("value")) / F.lit(100.0)).alias("avg_logprob"),
        (k / F.lit(100.0)).alias("no_speech_prob"),
    )
    rule = wd.hallucination_rule(F.col("text"), F.col("avg_logprob"), F.col("no_speech_prob"))
    return raw.select("event_id", "avg_logprob", "no_speech_prob", rule.alias("rule"))


@query("max_overlap_join", with_tables("turns", more="""
seg AS (SELECT user_id AS call_id, event_id AS seg_id, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + CAST(props->>'$.k' AS BIGINT) * 20000 AS e FROM events),
p AS (SELECT seg.call_id, seg_id, turn_id, speaker_id, least(e, end_ms) - greatest(s, start_ms) AS o
      FROM seg JOIN turns t ON seg.call_id = t.call_id AND s < end_ms AND start_ms < e),
m AS (SELECT call_id, seg_id, max(o) AS o, min(turn_id) FILTER (o = mo) AS t FROM (SELECT *, max(o) OVER (PARTITION BY call_id, seg_id) AS mo FROM p) GROUP BY ALL),
f AS (SELECT call_id, min_by(speaker_id, turn_id) AS fs FROM turns GROUP BY call_id)""", query="""
  SELECT seg.call_id, seg.seg_id, coalesce(turns.speaker_id, f.fs, 'UNDIARIZED') AS speaker_id, coalesce(m.o, 0) AS overlap
  FROM seg LEFT JOIN m USING (call_id, seg_id) LEFT JOIN turns ON turns.turn_id = m.t LEFT JOIN f ON f.call_id = seg.call_id"""))
def max_overlap_join(spark, folder):
    turns = diarization_turns(spark, folder).withColumnsRenamed({"start_ms": "turn_start", "end_ms": "turn_end"})
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    segments = table(spark, folder, "events").select(
        F.col("user_id").alias("call_id"), F.col("event_id").alias("seg_id"), start.alias("start"),
        (start + F.get_json_object("props", "$.k").cast("long") * 20000).alias("end"),
    )
    return intervals.assign_speakers(segments, turns, width=600_000).select("call_id", "seg_id", "speaker_id", "overlap")


@query("stitched_chunks", with_tables("segments", more="""
w AS (SELECT call_id, idx // 2 - o AS chunk_idx, idx, start + o * 0.5e0 AS start, "end" + o * 0.5e0 AS "end", text
      FROM segments, (VALUES (0), (1)) v(o) WHERE idx // 2 - o >= 0),
c AS (SELECT call_id, chunk_idx, list({'chunk_idx': chunk_idx, 'idx': idx, 'start': start, 'end': "end", 't': regexp_replace(text, '^\\s+|\\s+$', '', 'g')} ORDER BY idx) AS segs
      FROM w GROUP BY call_id, chunk_idx),
acc AS (
  SELECT call_id, chunk_idx, segs AS kept FROM c WHERE chunk_idx = 0
  UNION ALL
  SELECT c.call_id, c.chunk_idx, acc.kept || list_filter(c.segs, lambda s: len(list_filter(acc.kept, lambda p: p.t = s.t
    AND (abs(p."end" - s."end") < 2 OR s.start < acc.kept[len(acc.kept)]."end" - 3e0 + 0.1e0))) = 0)
  FROM acc JOIN c ON c.call_id = acc.call_id AND c.chunk_idx = acc.chunk_idx + 1),
done AS (SELECT call_id, max_by(kept, chunk_idx) AS kept FROM acc GROUP BY call_id)""",
       query="""SELECT call_id, k.chunk_idx AS chunk_idx, k.idx AS idx, k.start AS start, k."end" AS "end" FROM (SELECT call_id, unnest(kept) AS k FROM done)""").replace("WITH ", "WITH RECURSIVE ", 1))
def stitched_chunks(spark, folder):
    """Four-turn chunks that share two turns with the next, put together chunk by chunk."""
    late = F.col("_o") * F.lit(0.5)
    parts = (
        call_segments(spark, folder).withColumn("_o", F.explode(F.array(F.lit(0), F.lit(1))))
        .select("call_id", (F.floor(F.col("idx") / 2) - F.col("_o")).alias("chunk_idx"), "idx",
                (F.col("start") + late).alias("start"), (F.col("end") + late).alias("end"), "text")
        .where(F.col("chunk_idx") >= 0)
    )
    return wd.stitch_chunks(parts, ["call_id"]).select("call_id", "chunk_idx", "idx", "start", "end")
