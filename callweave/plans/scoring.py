"""Queries that normalise text and score transcripts."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import editdist as ed, entities as ent, fixed_values as fv, names as nm, text as tx
from callweave.operators import diarization as diar, matching, segments as seg, speakers as spk
from callweave.operators.ordered import running, slice_by, spread
from callweave.plans import evaluate as ev
from callweave.session import cut_lineage, stored
from callweave.plans.transcripts import SECTIONED
from callweave.plans.adapters import call_segments, heard_sql, heard_text, spoken_sql, spoken_text, table, wide_table, with_tables, word_array, words_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


# --- SQL twins of the cleaning steps -----------------------------------------------------------------------------
# RE2 word boundaries are ASCII only: accented letters are wrapped in word characters first and unwrapped at the end.

def _q(s: str) -> str:
    return s.replace("'", "''")


def _rr(x: str, pattern: str, to: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, '{_q(pattern)}', '{_q(to)}', '{flags}')"


def guard_sql(x: str) -> str:
    return _rr(x, r"([^\x00-\x7F\P{L}])", r"_QZ_\1_QZ_")


def unguard_sql(x: str) -> str:
    return f"replace(replace({x}, '_QZ_', ''), '_qz_', '')"


def fold_sql(x: str) -> str:
    return f"translate({x}, '’‘`“”–— ', '''''''\"\"-- ')"


def stamps_sql(x: str) -> str:
    return _rr(x, r"\[\s*\d+(?:\.\d+)?\s*-->\s*\d+(?:\.\d+)?\s*\]", " ")


def squeeze_sql(x: str) -> str:
    return f"trim({_rr(x, tx.SPACES, ' ')})"


def strip_sql(x: str) -> str:
    return _rr(x, rf"^{tx.SPACES}|{tx.SPACES}$", "")


def headers_sql(x: str) -> str:
    lines = f"list_transform(string_split({_rr(x, r'\([^)]*\)', ' ')}, chr(10)), lambda l: {strip_sql('l')})"
    markers = ", ".join(f"'{m}'" for m in fv.MARKER_LINES)
    spoken = (f"lambda l: l <> '' AND upper(l) NOT IN ({markers}) AND NOT regexp_matches(l, '{_q('(?i)' + fv.TITLE_LINE)}') "
              f"AND NOT regexp_matches(l, '{_q('(?i)' + fv.DATE_LINE)}') AND NOT regexp_matches(l, '{_q(fv.ATTENDEE_LINE)}')")
    said = f"list_transform(list_filter({lines}, {spoken}), lambda l: {_rr('l', fv.LABEL_PREFIX, '', '')})"
    keep = f"lambda l: l <> '' AND NOT (regexp_matches(l, '{_q(fv.CAPS_LINE)}') AND NOT regexp_matches(l, '{fv.CAPS_LINE_SPEECH}'))"
    return f"array_to_string(list_filter({said}, {keep}), ' ')"


def contractions_sql(x: str, rules=fv.CONTRACTIONS) -> str:
    for short, long in rules:
        x = _rr(x, rf"\b{short}\b", long, "gi")
    return x


def figures_sql(x: str) -> str:
    for _ in range(2):
        x = _rr(x, r"(\d+),(\d+)", r"\1\2")
    for letters, word in tx.MAGNITUDES:
        x = _rr(x, rf"\$\s*(\d+(?:\.\d+)?)\s*(?:[{letters}]|{word})\b", rf"\1 {word} dollars")
    return _rr(_rr(x, r"\$\s*(\d+(?:\.\d+)?)", r"\1 dollars"), r"(\d+(?:\.\d+)?)\s*%", r"\1 percent")


def fillers_sql(x: str) -> str:
    for f in fv.FILLERS:
        x = _rr(x, rf"\b{f}\b", " ", "gi")
    return x


def norm_sql(x: str, is_reference: bool = False) -> str:
    x = stamps_sql(fold_sql(x))
    if is_reference:
        x = headers_sql(x)
    x = unguard_sql(f"lower({fillers_sql(figures_sql(contractions_sql(guard_sql(x))))})")
    x = _rr(x, "[-–—/]", " ")
    x = _rr(x, r"(\d+)\.(\d+)", r"\1_DOT_\2")
    x = _rr(x, r"[^\p{L}\p{N}_\s]", " ")
    return squeeze_sql(f"replace({x}, '_DOT_', '.')")


def norm_v1_sql(x: str) -> str:
    x = contractions_sql(guard_sql(f"lower({x})"), fv.CONTRACTIONS_V1)
    n = r"(\d+(?:\.\d+)?)"
    large = [("billion", "b"), ("million", "m"), ("thousand", "k")]
    for word, letter in large:
        x = _rr(x, rf"\${n}\s*(?:{word}|{letter}\b)", rf"\1 {word} dollars")
    x = _rr(x, rf"\${n}", r"\1 dollars")
    for word, _ in large:
        x = _rr(x, rf"{n}\s*{word}(?:\s*dollars)?", rf"\1 {word} dollars")
    x = _rr(_rr(x, r"dollars\s+dollars", "dollars"), rf"{n}\s*%", r"\1 percent")
    for digit, word in enumerate(fv.NUMBER_WORDS):
        x = _rr(x, rf"\b{word}\b", str(digit))
    for f in fv.FILLERS_V1:
        x = _rr(x, rf"\b{f}\b", "", "gi")
    x = _rr(unguard_sql(x), r"[^\p{L}\p{N}_\s.]", " ")
    for _ in range(2):
        x = _rr(x, r"(\d)\.(\d)", r"\1_PT_\2")
    return squeeze_sql(f"replace(replace({x}, '.', ' '), '_PT_', '.')")


# --- normalising whole documents ---------------------------------------------------------------------------------

def spoken_documents(spark, folder):
    return wide_table(spark, folder, "documents").select("doc_id", spoken_text(F.col("text")).alias("text"))


SPOKEN_DOCS = f"WITH d AS (SELECT doc_id, {spoken_sql('text')} AS text FROM documents) SELECT doc_id, "


@query("normalize_v2", SPOKEN_DOCS + norm_sql("text") + " AS norm FROM d")
def normalize_v2(spark, folder):
    return spoken_documents(spark, folder).select("doc_id", tx.normalize(F.col("text")).alias("norm"))


@query("normalize_v1", SPOKEN_DOCS + norm_v1_sql("text") + " AS norm FROM d")
def normalize_v1(spark, folder):
    return spoken_documents(spark, folder).select("doc_id", tx.normalize_v1(F.col("text")).alias("norm"))


@query("expand_contractions", SPOKEN_DOCS + unguard_sql(contractions_sql(guard_sql("text"))) + " AS full_text FROM d")
def expand_contractions(spark, folder):
    return spoken_documents(spark, folder).select("doc_id", tx.expand_contractions(F.col("text")).alias("full_text"))


@query("spell_figures", SPOKEN_DOCS + unguard_sql(figures_sql(guard_sql("text"))) + " AS spelled FROM d")
def spell_figures(spark, folder):
    return spoken_documents(spark, folder).select("doc_id", tx.spell_figures(F.col("text")).alias("spelled"))


@query("drop_fillers", SPOKEN_DOCS + unguard_sql(fillers_sql(guard_sql("text"))) + " AS fluent FROM d")
def drop_fillers(spark, folder):
    return spoken_documents(spark, folder).select("doc_id", tx.drop_fillers(F.col("text")).alias("fluent"))


STAMPED = """
stamped AS (SELECT call_id, idx, '[' || CAST(CAST(start AS DECIMAL(18,2)) AS VARCHAR) || ' --> ' || CAST(CAST("end" AS DECIMAL(18,2)) AS VARCHAR) || '] “'
   || replace(text, ' the ', ' —the` ') || '”' AS text FROM segments)"""


@query("raw_clean", with_tables("segments", more=STAMPED, query=f"SELECT call_id, idx, {squeeze_sql(stamps_sql(fold_sql('text')))} AS cleaned FROM stamped"))
def raw_clean(spark, folder):
    """Time-stamped lines with typographic quotes and dashes."""
    two = lambda c: F.col(c).cast("decimal(18,2)").cast("string")
    rows = call_segments(spark, folder).select("call_id", "idx", F.concat(
        F.lit("["), two("start"), F.lit(" --> "), two("end"), F.lit("] “"), F.replace("text", F.lit(" the "), F.lit(" —the` ")), F.lit("”")).alias("text"))
    return rows.select("call_id", "idx", tx.raw_clean(F.col("text")).alias("cleaned"))


PUBLISHED = """
published AS (
  SELECT call_id, 'FY98 First Quarter Earnings Conference Call' || chr(10) || 'Thursday, October 3, 1998' || chr(10) || 'Small Ring, Red Widget' || chr(10)
    || string_agg(CASE speaker_role WHEN 'Operator' THEN 'OPERATOR: (Operator Direction.) ' WHEN 'Executive' THEN 'HOST SPEAKER, CHAIR: '
                  ELSE 'ANALYST 0' || speaker_id[10:10] || ' - FIRM: ' END || text, chr(10) ORDER BY idx) || chr(10) || 'END' AS text
  FROM segments GROUP BY call_id)"""


def published(segments):
    """Transcript as a company publishes it: title, date, attendees, labelled turns, end mark."""
    label = (
        F.when(F.col("speaker_role") == "Operator", "OPERATOR: (Operator Direction.) ")
        .when(F.col("speaker_role") == "Executive", "HOST SPEAKER, CHAIR: ")
        .otherwise(F.concat(F.lit("ANALYST 0"), F.substring("speaker_id", 10, 1), F.lit(" - FIRM: "))))
    lines = segments.select("call_id", "idx", F.concat(label, "text").alias("text"))
    body = seg.assemble_text(lines, ["call_id"], sep="\n")
    head = "FY98 First Quarter Earnings Conference Call\nThursday, October 3, 1998\nSmall Ring, Red Widget\n"
    return body.select("call_id", F.concat(F.lit(head), "text", F.lit("\nEND")).alias("text"))


def heard(segments):
    """The recogniser's segments: same times, misheard words."""
    return segments.withColumn("text", heard_text(F.col("text"))).withColumn("n_words", F.size(word_array(F.col("text"))))


@query("strip_headers", with_tables("segments", more=PUBLISHED, query=f"SELECT call_id, {headers_sql('text')} AS spoken FROM published"))
def strip_headers(spark, folder):
    return published(call_segments(spark, folder)).select("call_id", tx.drop_headers(F.col("text")).alias("spoken"))


@query("normalize_reference", with_tables("segments", more=PUBLISHED, query=f"SELECT call_id, {norm_sql('text', True)} AS norm FROM published"))
def normalize_reference(spark, folder):
    return published(call_segments(spark, folder)).select("call_id", tx.normalize(F.col("text"), True).alias("norm"))


@query("reference_split", with_tables("segments", more=PUBLISHED + """,
split AS (SELECT call_id, text, string_split(text, chr(10)) AS l FROM published)""", query="""
  SELECT call_id, array_to_string(l[1 : len(l) // 2], chr(10)) AS remarks, array_to_string(l[len(l) // 2 + 1 :], chr(10)) AS questions FROM split"""))
def reference_split(spark, folder):
    """Remarks and questions of published transcripts (no cue line in these, so by half of the lines)."""
    remarks, questions = tx.split_reference(F.col("text"))
    return published(call_segments(spark, folder)).select("call_id", remarks.alias("remarks"), questions.alias("questions"))


# --- error rates -------------------------------------------------------------------------------------------------

UNIT = 100_000
DP = f"""
pair AS (SELECT call_id, idx, {words_sql('lower(text)')} AS r, {words_sql('lower(' + heard_sql('text') + ')')} AS h FROM segments),
rt AS (SELECT call_id, idx, unnest(r) AS w, unnest(range(1, len(r) + 1)) AS i FROM pair),
ht AS (SELECT call_id, idx, unnest(h) AS w, unnest(range(1, len(h) + 1)) AS j FROM pair),
dp AS (
  SELECT call_id, idx, CAST(0 AS BIGINT) AS i, j, j * {UNIT} AS c FROM pair, LATERAL (SELECT unnest(range(0, len(h) + 1)) AS j)
  UNION ALL
  SELECT call_id, idx, i, j, CAST(min(t - j * {UNIT}) OVER (PARTITION BY call_id, idx ORDER BY j ROWS UNBOUNDED PRECEDING) + j * {UNIT} AS BIGINT)
  FROM (SELECT d.call_id, d.idx, d.i + 1 AS i, d.j,
               least(d.c + {UNIT}, lag(d.c) OVER (PARTITION BY d.call_id, d.idx ORDER BY d.j) + CASE WHEN rt.w = ht.w THEN -1 ELSE {UNIT} END) AS t
        FROM dp d JOIN rt ON rt.call_id = d.call_id AND rt.idx = d.idx AND rt.i = d.i + 1
        LEFT JOIN ht ON ht.call_id = d.call_id AND ht.idx = d.idx AND ht.j = d.j)),
done AS (SELECT call_id, idx, len(r) AS n, len(h) AS m, -((-c) // {UNIT}) AS d0, c FROM dp JOIN pair USING (call_id, idx) WHERE i = len(r) AND j = len(h)),
dist AS (SELECT call_id, idx, n, m, CAST(ceil(c / {UNIT}e0) AS BIGINT) AS d, CAST(ceil(c / {UNIT}e0) AS BIGINT) * {UNIT} - c AS hits FROM done)"""


def turn_pairs(spark, folder):
    rows = call_segments(spark, folder)
    return rows.select(
        "call_id", "idx", word_array(F.lower("text")).alias("ref"), word_array(F.lower(heard_text(F.col("text")))).alias("hyp"))


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@query("wer", recursive(with_tables("segments", more=DP, query="""
  SELECT call_id, idx, d AS distance, CASE WHEN n = 0 THEN CASE WHEN m = 0 THEN 0e0 ELSE 1e0 END ELSE CAST(d AS DOUBLE) / n END AS wer FROM dist""")))
def wer(spark, folder):
    """Word error rate of every turn, whole texts."""
    rows = turn_pairs(spark, folder).withColumn("distance", ed.word_distance(F.col("ref"), F.col("hyp")))
    return rows.select("call_id", "idx", "distance", ed.error_rate(F.col("distance"), F.size("ref"), F.size("hyp")).alias("wer"))


@query("edit_ops", recursive(with_tables("segments", more=DP, query="""
  SELECT call_id, idx, hits, n - hits - (d - n + hits + n - m) AS substitutions, d - n + hits + n - m AS deletions, d - n + hits AS insertions, d AS distance,
         CAST(n AS BIGINT) AS ref_words, CAST(m AS BIGINT) AS hyp_words FROM dist""")))
def edit_ops(spark, folder):
    rows = turn_pairs(spark, folder).withColumn("_e", ed.edit_breakdown(F.col("ref"), F.col("hyp")))
    return rows.select("call_id", "idx", "_e.*")


# One byte per character for DuckDB's byte-wise distance: accented letters move to unused control codes.
ACCENTED = "éèêçàâùûôîïëüöäßñáíóúìòÉÈÊÇÀÂÙÛÔÎÏËÜÖÄÑÁÍÓÚ¿¡"


def _bytes_sql(x: str) -> str:
    free = [c for c in range(1, 128) if c not in (9, 10, 13) and not 32 <= c < 127]
    free += [ord(c) for c in "{}~^|\\<>=`@#&*+;[]_"]
    to = " || ".join(f"chr({c})" for c in free[: len(ACCENTED)])
    return f"translate({x}, '{ACCENTED}', {to})"


@query("cer", with_tables("segments", query=f"""
  SELECT call_id, idx, CASE WHEN length(text) = 0 THEN 1e0 ELSE CAST(levenshtein({_bytes_sql('text')}, {_bytes_sql(heard_sql('text'))}) AS DOUBLE) / length(text) END AS cer FROM segments"""))
def cer(spark, folder):
    rows = call_segments(spark, folder).select("call_id", "idx", F.col("text").alias("r"), heard_text(F.col("text")).alias("h"))
    return rows.select("call_id", "idx", ed.char_error_rate(F.col("r"), F.col("h")).alias("cer"))


@query("document_wer")
def document_wer(spark, folder):
    """Word error rate of whole documents against their spoken-and-misheard version."""
    docs = wide_table(spark, folder, "documents").select(
        "doc_id", ed.text_distances(tx.normalize(F.col("text")), tx.normalize(heard_text(F.col("text"))), chars=False).alias("d"))
    return docs.select("doc_id", F.col("d.ref_words").cast("int").alias("ref_words"), ed.rates(F.col("d"))[0].alias("wer"))


HEARD_TEXT = f"""
hseg AS (SELECT *, {heard_sql('text')} AS heard FROM segments),
hyp AS (SELECT call_id, string_agg(heard, ' ' ORDER BY idx) AS text FROM hseg GROUP BY call_id)"""


def word_lists_sql(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def distances_sql(pairs: str) -> str:
    """Common tables that end in dist (k, n, m, d): word edit distance of pairs (k, r, h), row by row of the whole table of costs."""
    return f"""
pairs AS MATERIALIZED ({pairs}),
rt AS MATERIALIZED (SELECT k, unnest(r) AS w, unnest(range(1, len(r) + 1)) AS i FROM pairs),
ht AS MATERIALIZED (SELECT k, unnest(h) AS w, unnest(range(1, len(h) + 1)) AS j FROM pairs),
dp AS (
  SELECT k, CAST(0 AS BIGINT) AS i, j, j AS c FROM pairs, LATERAL (SELECT unnest(range(0, len(h) + 1)) AS j)
  UNION ALL
  SELECT k, i, j, min(t - j) OVER (PARTITION BY k ORDER BY j ROWS UNBOUNDED PRECEDING) + j
  FROM (SELECT d.k, d.i + 1 AS i, d.j, least(d.c + 1, lag(d.c) OVER (PARTITION BY d.k ORDER BY d.j) + CASE WHEN rt.w = ht.w THEN 0 ELSE 1 END) AS t
        FROM dp d JOIN rt ON rt.k = d.k AND rt.i = d.i + 1 LEFT JOIN ht ON ht.k = d.k AND ht.j = d.j)),
dist AS (SELECT p.k, len(r) AS n, len(h) AS m, dp.c AS d FROM pairs p JOIN dp ON dp.k = p.k AND dp.i = len(p.r) AND dp.j = len(p.h))"""


RATE = "CASE WHEN n = 0 THEN CASE WHEN m = 0 THEN 0e0 ELSE 1e0 END ELSE CAST(d AS DOUBLE) / n END * 100"


def cer_sql(r: str, h: str) -> str:
    return f"CASE WHEN length({r}) = 0 THEN CASE WHEN length({h}) = 0 THEN 0e0 ELSE 100e0 END ELSE CAST(levenshtein({_bytes_sql(r)}, {_bytes_sql(h)}) AS DOUBLE) / length({r}) * 100 END"


CALL_TEXTS = PUBLISHED + "," + HEARD_TEXT + f""",
forms AS MATERIALIZED (SELECT call_id, {squeeze_sql(headers_sql(stamps_sql(fold_sql('p.text'))))} AS rr, {squeeze_sql(stamps_sql(fold_sql('hyp.text')))} AS rh,
  {norm_sql('p.text', True)} AS nr, {norm_sql('hyp.text')} AS nh FROM published p JOIN hyp USING (call_id))"""


@query("call_scores", recursive(with_tables("segments", more=CALL_TEXTS + "," + distances_sql(
    f"SELECT 'raw' || call_id AS k, {word_lists_sql('rr')} AS r, {word_lists_sql('rh')} AS h FROM forms"
    f" UNION ALL SELECT 'norm' || call_id, {word_lists_sql('nr')}, {word_lists_sql('nh')} FROM forms"), query=f"""
  SELECT call_id, (SELECT {RATE} FROM dist WHERE k = 'raw' || call_id) AS raw_wer, (SELECT {RATE} FROM dist WHERE k = 'norm' || call_id) AS norm_wer,
    {cer_sql('rr', 'rh')} AS raw_cer, {cer_sql('nr', 'nh')} AS norm_cer FROM forms""")))
def call_scores(spark, folder):
    rows = call_segments(spark, folder)
    return ev.call_scores(published(rows), seg.assemble_text(heard(rows), ["call_id"]))


HEARD_OR_NONE = "coalesce(b.text, '')"
NORMAL_RATE = "CASE WHEN n = 0 THEN 0e0 ELSE CAST(d AS DOUBLE) / n * 100 END"


@query("section_wer", recursive(with_tables("segments", more=SECTIONED + "," + PUBLISHED + f""",
lines AS (SELECT call_id, string_split(text, chr(10)) AS l FROM published),
halves AS (SELECT call_id, unnest(['remarks', 'qa']) AS part,
  unnest([array_to_string(l[1 : len(l) // 2], chr(10)), array_to_string(l[len(l) // 2 + 1 :], chr(10))]) AS text FROM lines),
spoken AS (SELECT call_id, CASE WHEN section = 'qa' THEN 'qa' ELSE 'remarks' END AS part, string_agg({heard_sql('text')}, ' ' ORDER BY idx) AS text
  FROM sectioned GROUP BY ALL),
""" + distances_sql(f"SELECT a.part || a.call_id AS k, {word_lists_sql(norm_sql('a.text', True))} AS r, {word_lists_sql(norm_sql(HEARD_OR_NONE))} AS h"
                   " FROM halves a LEFT JOIN spoken b ON a.call_id = b.call_id AND a.part = b.part"), query=f"""
  SELECT call_id, remarks_wer, qa_wer, qa_wer - remarks_wer AS delta FROM (
    SELECT call_id, (SELECT {NORMAL_RATE} FROM dist WHERE k = 'remarks' || call_id) AS remarks_wer, (SELECT {NORMAL_RATE} FROM dist WHERE k = 'qa' || call_id) AS qa_wer FROM published)""")))
def section_wer(spark, folder):
    rows = seg.label_sections(call_segments(spark, folder))
    return ev.section_scores(published(rows), heard(rows))


@query("non_operator_wer", recursive(with_tables("segments", more=PUBLISHED + "," + HEARD_TEXT + f""",
speech AS (SELECT call_id, string_agg(heard, ' ' ORDER BY idx) AS text FROM hseg WHERE speaker_role IS DISTINCT FROM 'Operator' GROUP BY call_id),
refs AS (SELECT call_id, {word_lists_sql(norm_sql('text', True))} AS r FROM published),
hyps AS (SELECT 'all' || call_id AS k, call_id, text FROM hyp UNION ALL SELECT 'own' || p.call_id, p.call_id, coalesce(s.text, '') FROM published p LEFT JOIN speech s USING (call_id)),
""" + distances_sql(f"SELECT k, r, {word_lists_sql(norm_sql('text'))} AS h FROM hyps JOIN refs USING (call_id)"), query=f"""
  SELECT call_id, norm_wer, non_operator_wer, norm_wer - non_operator_wer AS reduction FROM (
    SELECT call_id, (SELECT {NORMAL_RATE} FROM dist WHERE k = 'all' || call_id) AS norm_wer, (SELECT {NORMAL_RATE} FROM dist WHERE k = 'own' || call_id) AS non_operator_wer FROM published)""")))
def non_operator_wer(spark, folder):
    rows = call_segments(spark, folder)
    return ev.without_operator(published(rows), heard(rows))


@query("version_compare")
def version_compare(spark, folder):
    """New version: misheard words.  Old version: also lacks the host's turns, so seconds are missing."""
    rows = call_segments(spark, folder)
    new = heard(rows)
    return ev.compare_versions(published(rows), new, new.where("speaker_role <> 'Executive' or idx = 0"))


@query("engine_scores")
def engine_scores(spark, folder):
    """Two engines over all documents; documents of one source have no reference."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("clip"), "text", "source")
    outputs = docs.select("clip", F.explode(F.array(
        F.struct(F.lit("engine_a").alias("engine"), heard_text(F.col("text")).alias("text")),
        F.struct(F.lit("engine_b").alias("engine"), F.replace("text", F.lit(" is "), F.lit(" was a ")).alias("text")))).alias("o")).select("clip", "o.*")
    return ev.engine_scores(outputs, docs.where("source <> 'src0'").select("clip", "text"), ["engine"])


# --- entities ----------------------------------------------------------------------------------------------------

FIGURES = """
fig AS (SELECT o_orderkey AS call_id, o_orderpriority AS pri, 'Revenue was $' || CAST(q // 10 AS VARCHAR) || '.' || CAST(q % 10 AS VARCHAR) || ' billion, up ' || CAST(q % 50 AS VARCHAR)
  || '% in Q' || CAST(quarter(o_orderdate) AS VARCHAR) || ' FY' || CAST(year(o_orderdate) AS VARCHAR) || ' and ' || CAST(q % 90 + 10 AS VARCHAR) || ' basis points, 12 percent ahead, said '
  || CASE o_orderpriority WHEN '1-URGENT' THEN 'Amy Hood' WHEN '2-HIGH' THEN 'satya nadella' ELSE 'Tim Cook' END || ' of '
  || CASE o_orderstatus WHEN 'F' THEN 'GitHub Copilot' WHEN 'O' THEN 'Goldman Sachs' ELSE 'Azure' END || ' (' || CASE o_orderstatus WHEN 'F' THEN 'MSFT' ELSE 'shop' END
  || ') on ' || strftime(o_orderdate, '%B %-d, %Y') || ', $' || CAST(q AS VARCHAR) || '.' AS text
  FROM (SELECT *, CAST(floor(o_totalprice / 100) AS BIGINT) AS q FROM orders)),
hyp AS (SELECT call_id, pri, replace(replace(replace(replace(text, 'Goldman Sachs', 'Goldman'), ' billion', CASE WHEN pri = '5-LOW' THEN ' million' ELSE ' billion' END), 'Amy Hood', 'Amy Wood'), ' in Q', ', uh, in Q') AS text FROM fig)"""


def figure_texts(spark, folder):
    """One sentence of figures, names and dates per order."""
    q = F.col("q")
    s = lambda c: c.cast("string")
    rows = wide_table(spark, folder, "orders").withColumn("q", F.floor(F.col("o_totalprice") / 100))
    text = F.concat(
        F.lit("Revenue was $"), s(F.floor(q / 10)), F.lit("."), s(q % 10), F.lit(" billion, up "), s(q % 50), F.lit("% in Q"),
        s(F.quarter("o_orderdate")), F.lit(" FY"), s(F.year("o_orderdate")), F.lit(" and "), s(q % 90 + 10),
        F.lit(" basis points, 12 percent ahead, said "),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Amy Hood").when(F.col("o_orderpriority") == "2-HIGH", "satya nadella").otherwise("Tim Cook"),
        F.lit(" of "),
        F.when(F.col("o_orderstatus") == "F", "GitHub Copilot").when(F.col("o_orderstatus") == "O", "Goldman Sachs").otherwise("Azure"),
        F.lit(" ("), F.when(F.col("o_orderstatus") == "F", "MSFT").otherwise("shop"), F.lit(") on "),
        F.date_format("o_orderdate", "MMMM d, yyyy"), F.lit(", $"), s(q), F.lit("."))
    return rows.select(F.col("o_orderkey").alias("call_id"), F.col("o_orderpriority").alias("pri"), text.alias("text"))


def misheard_figures(rows):
    swap = lambda c, a, b: F.replace(c, F.lit(a), b if not isinstance(b, str) else F.lit(b))
    scale = F.when(F.col("pri") == "5-LOW", " million").otherwise(" billion")
    text = swap(swap(swap(swap(F.col("text"), "Goldman Sachs", "Goldman"), " billion", scale), "Amy Hood", "Amy Wood"), " in Q", ", uh, in Q")
    return rows.select("call_id", "pri", text.alias("text"))


def _classes6_sql(x: str, value: str) -> str:
    parts = [f"SELECT call_id, '{c}' AS class, unnest(list_filter(list_transform(regexp_extract_all({x}, '{_q('(?i)' + p)}'), lambda e: trim(e)), lambda e: length(e) > 1)) AS {value} FROM fig"
             for c, p in fv.ENTITY_PATTERNS.items()]
    for c, names, flag in [("person_names", fv.ENTITY_PEOPLE, "(?i)"), ("company_product", fv.ENTITY_COMPANIES, "(?i)"), ("tickers", fv.ENTITY_TICKERS, "")]:
        vals = ", ".join(f"('{_q(n)}')" for n in names)
        parts.append(f"SELECT call_id, '{c}', unnest(list_transform(regexp_extract_all({x}, '{flag}\\b' || nm || '\\b'), lambda e: nm)) FROM fig, (VALUES {vals}) v(nm)")
    return " UNION ALL ".join(parts)


FOUND6 = FIGURES + ",\nfound AS (" + _classes6_sql("text", "entity") + ")"


@query("entity_extract6", with_tables(more=FOUND6, query="SELECT call_id, class, entity, count(*) AS n FROM found GROUP BY ALL"))
def entity_extract6(spark, folder):
    rows = figure_texts(spark, folder).select("call_id", F.explode(ent.entities_6(F.col("text"))).alias("class", "_e"))
    return rows.select("call_id", "class", F.explode("_e").alias("entity")).groupBy("call_id", "class", "entity").agg(F.count(F.lit(1)).alias("n"))


def _pattern7(name: str) -> str:
    return fv.ENTITY_PATTERNS_7.get(name) or r"\b(?:" + "|".join(fv.ENTITY_NAMES_7[name]) + r")\b"


@query("entity_extract7", with_tables(more=FIGURES, query=" UNION ALL ".join(
    f"SELECT call_id, '{c}' AS class, entity, count(*) AS n FROM (SELECT call_id, unnest(regexp_extract_all(text, '{_q('(?i)' + _pattern7(c))}')) AS entity FROM fig) GROUP BY ALL"
    for c, _ in fv.ENTITY_WEIGHTS)))
def entity_extract7(spark, folder):
    rows = figure_texts(spark, folder).select("call_id", F.explode(ent.entities_7(F.col("text"))).alias("class", "_e"))
    return rows.select("call_id", "class", F.explode("_e").alias("entity")).groupBy("call_id", "class", "entity").agg(F.count(F.lit(1)).alias("n"))


def _lists7(rel: str) -> str:
    norm = norm_v1_sql("e")
    cols = ", ".join(f"list_transform(regexp_extract_all(text, '{_q('(?i)' + _pattern7(c))}'), lambda e: {norm}) AS {c}" for c, _ in fv.ENTITY_WEIGHTS)
    return f"SELECT call_id, {cols} FROM {rel}"


@query("weighted_entity_accuracy", with_tables(more=FIGURES + f",\nr7 AS ({_lists7('fig')}),\nh7 AS ({_lists7('hyp')}),\nacc AS (" + " UNION ALL ".join(
    f"SELECT r7.call_id, '{c}' AS class, {w}e0 AS weight, len(r7.{c}) AS rc, len(h7.{c}) AS hc, len(list_filter(h7.{c}, lambda e: list_contains(r7.{c}, e))) AS ok FROM r7 JOIN h7 USING (call_id)"
    for c, w in fv.ENTITY_WEIGHTS) + ")", query="""
  SELECT class, CAST(sum(rc) AS BIGINT) AS ref_count, CAST(sum(hc) AS BIGINT) AS hyp_count, CAST(sum(CASE WHEN rc = 0 THEN 0 ELSE ok END) AS BIGINT) AS correct,
         CAST(sum(CAST(CASE WHEN rc = 0 THEN CASE WHEN hc = 0 THEN 1 ELSE 0.95 END ELSE round(least(1, CAST(ok AS DOUBLE) / greatest(1, rc)), 4) END AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS accuracy
  FROM acc GROUP BY class"""))
def weighted_entity_accuracy(spark, folder):
    """Seven-class accuracy summed over all calls, one row per class."""
    ref = figure_texts(spark, folder)
    lists = lambda rows, name: spread(rows, "call_id").select("call_id", ent.entities_7(F.col("text")).alias(name))
    pairs = lists(ref, "r").join(lists(misheard_figures(ref), "h"), "call_id")
    pairs = pairs.withColumn("hits", ent.normal_hits(F.col("r"), F.col("h")))
    rows = pairs.select("call_id", F.inline(ent.weighted_accuracy(F.col("r"), F.col("h"), F.col("hits"))))
    return rows.groupBy("class").agg(
        F.sum("ref_count").alias("ref_count"), F.sum("hyp_count").alias("hyp_count"), F.sum("correct").alias("correct"),
        (F.sum(F.col("accuracy").cast("decimal(18,4)")).cast("double") / F.count(F.lit(1))).alias("accuracy"))


MATCHES = FIGURES.replace("\nhyp AS", "\nhyp0 AS").replace("fig AS (", "fig0 AS (", 1).replace("FROM fig)", "FROM fig0)") + f""",
hyp AS (SELECT * FROM hyp0), fig AS (SELECT call_id, pri, {headers_sql('text')} AS text FROM fig0),
found AS ({_classes6_sql("text", "entity")}),""" + f"""
refn AS (SELECT call_id, class, {norm_sql('entity')} AS entity FROM found),
hypn AS (SELECT call_id, {norm_sql('text')} AS t FROM hyp),
matches AS (SELECT r.call_id, class, entity, n AS ref_count, len(regexp_extract_all(t, '\\b' || replace(entity, '.', '\\.') || '\\b')) AS hyp_count
            FROM (SELECT call_id, class, entity, count(*) AS n FROM refn WHERE entity <> '' GROUP BY ALL) r JOIN hypn USING (call_id))"""


def figure_matches(spark, folder):
    ref = figure_texts(spark, folder)
    return ev.entity_matches(ref, misheard_figures(ref), ["call_id"])


@query("entity_recall", with_tables(more=MATCHES, query="""
  SELECT class, CAST(sum(ref_count) AS BIGINT) AS ref_count, CAST(sum(least(ref_count, hyp_count)) AS BIGINT) AS matched_count,
         CASE WHEN sum(ref_count) > 0 THEN CAST(sum(least(ref_count, hyp_count)) AS DOUBLE) / CAST(sum(ref_count) AS DOUBLE) * 100 END AS recall_pct FROM matches GROUP BY class"""))
def entity_recall(spark, folder):
    return ent.recall(figure_matches(spark, folder), ["class"])


@query("entity_deficits", with_tables(more=MATCHES, query="""
  SELECT call_id, class, entity, CAST(ref_count AS INTEGER) AS ref_count, CAST(hyp_count AS INTEGER) AS hyp_count, CAST(ref_count - hyp_count AS INTEGER) AS deficit, CASE WHEN hyp_count = 0 THEN 'Missing' ELSE 'Partial' END AS status
  FROM matches WHERE ref_count > hyp_count"""))
def entity_deficits(spark, folder):
    # Stored first: the sort's sampling would find all entities a second time.
    return stored(ent.deficits(figure_matches(spark, folder), ["call_id"])).orderBy(F.desc("deficit"))


@query("dictionary_counts", f"""
WITH b AS (SELECT item_id, {words_sql('lower(text)')} AS ws FROM benchmark),
p AS (SELECT DISTINCT ws[i] || ' ' || ws[i + 1] AS phrase, ws[i] || '  ' || ws[i + 1] AS padded FROM b, LATERAL (SELECT unnest(range(1, len(ws))) AS i)),
d AS (SELECT doc_id, {words_sql('lower(text)')} AS ws FROM documents),
s AS (SELECT doc_id, ' ' || array_to_string(ws, '  ') || ' ' AS t FROM d),
hit AS (SELECT DISTINCT doc_id, ws[i] || ' ' || ws[i + 1] AS phrase FROM d, LATERAL (SELECT unnest(range(1, len(ws))) AS i))
SELECT doc_id, phrase, CAST((length(t) - length(replace(t, ' ' || padded || ' ', ''))) / (length(padded) + 2) AS BIGINT) AS n
FROM hit JOIN p USING (phrase) JOIN s USING (doc_id)""")
def dictionary_counts(spark, folder):
    """Every two-word phrase of the benchmark passages counted in every document."""
    b = table(spark, folder, "benchmark").select(word_array(F.lower("text")).alias("w")).where(F.size("w") > 1)
    phrases = b.select(F.explode(F.transform(
        F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.array_join(F.slice("w", i, 2), " "))).alias("phrase")).distinct()
    docs = wide_table(spark, folder, "documents").select("doc_id", word_array(F.lower("text")).alias("tokens"))
    return matching.dictionary_counts(docs, phrases, "doc_id", longest=2)


# --- alignment ---------------------------------------------------------------------------------------------------

def call_pairs(spark, folder):
    rows = call_segments(spark, folder)
    words = lambda df, name: spread(seg.assemble_text(df, ["call_id"]), "call_id").select(
        "call_id", tx.words(tx.normalize(F.col("text"))).alias(name))
    return words(rows, "ref").join(words(heard(rows), "hyp"), "call_id")


@query("align_opcodes")
def align_opcodes(spark, folder):
    return ev.scripts(call_pairs(spark, folder)).select("call_id", "op_no", "tag", "i1", "i2", "j1", "j2")


@query("substitution_pairs")
def substitution_pairs(spark, folder):
    return ev.substitutions(ev.scripts(call_pairs(spark, folder)))


def hyp_words(spark, folder):
    """Normalised hypothesis words with position in the call and their segment's facts."""
    rows = heard(call_segments(spark, folder)).withColumn("_w", tx.words(tx.normalize(F.col("text"))))
    rows = running(slice_by(rows, "idx"), ["call_id"], ["idx"], {"_upto": ("sum", F.size("_w"))})
    rows = rows.withColumn("_before", F.col("_upto") - F.size("_w"))
    words = rows.select("call_id", F.col("idx").alias("seg_idx"), "speaker_id", "speaker_role", "start", "end", "_before",
                        F.size("_w").alias("_n"), F.posexplode("_w").alias("_p", "word"))
    step = F.greatest(F.col("end") - F.col("start"), F.lit(0.01)) / F.col("_n")
    return words.select("call_id", "seg_idx", "speaker_id", "speaker_role", "word", (F.col("_before") + F.col("_p")).alias("j"),
                        (F.col("start") + F.col("_p") * step).alias("start"), (F.col("start") + (F.col("_p") + 1) * step).alias("end"))


def ref_words(spark, folder):
    """Normalised reference words with position in the call and their speaker."""
    rows = call_segments(spark, folder).withColumn("_w", tx.words(tx.normalize(F.col("text"))))
    rows = running(slice_by(rows, "idx"), ["call_id"], ["idx"], {"_upto": ("sum", F.size("_w"))})
    name = F.when(F.col("speaker_role") == "Operator", "OPERATOR").when(F.col("speaker_role") == "Executive", "SMALL RING").otherwise(
        F.concat(F.lit("ANALYST "), F.substring("speaker_id", 9, 2)))
    return rows.select("call_id", name.alias("ref_name"), (F.col("_upto") - F.size("_w")).alias("_b"), F.posexplode("_w").alias("_p", "word")).select(
        "call_id", "ref_name", "word", (F.col("_b") + F.col("_p")).alias("i"))


@query("diff_blocks")
def diff_blocks(spark, folder):
    return ev.diff_blocks(ev.scripts(call_pairs(spark, folder)), hyp_words(spark, folder).select("call_id", "j", "seg_idx"))


def matched(spark, folder):
    m = cut_lineage(ev.matched_words(ev.scripts(call_pairs(spark, folder))))
    return m.join(ref_words(spark, folder).drop("word"), ["call_id", "i"]).join(hyp_words(spark, folder), ["call_id", "j"])


@query("speaker_name_accuracy")
def speaker_name_accuracy(spark, folder):
    """Names as the recogniser resolved them: hosts right, the second analyst unknown."""
    name = F.when(F.col("speaker_role") == "Operator", "Conference Operator").when(F.col("speaker_role") == "Executive", "Small Ring").when(
        F.col("speaker_id") == "SPEAKER_02", "Analyst 02")
    rows = matched(spark, folder).withColumn("hyp_name", name)
    return ev.name_accuracy(rows, F.col("ref_name") == "SMALL RING")


@query("der")
def der(spark, folder):
    """Diarization error per call: reference turns from aligned words, hypothesis turns from the segments' speakers."""
    us = lambda c: F.round(F.col(c) * 1_000_000).cast("long")
    hyp = call_segments(spark, folder).select("call_id", us("start").alias("start"), us("end").alias("end"), F.col("speaker_id").alias("speaker"))
    return diar.error_rate(diar.reference_turns(matched(spark, folder)), hyp)


# --- speakers ----------------------------------------------------------------------------------------------------

@query("resolve_speakers")
def resolve_speakers(spark, folder):
    """Names and roles of every segment from announcements, handovers and order (sections of the first pass)."""
    rows = call_segments(spark, folder).drop("speaker_role").withColumn("ticker", F.lit("MSFT"))
    rows = spk.resolve_speakers(seg.label_sections(rows, role=None))
    return rows.select("call_id", "idx", "speaker_id", "speaker_name", "speaker_role")


BLOCKS = r"""
marked AS (SELECT call_id, string_split(regexp_replace(text, '(?m)^[ \t]*([A-Z0-9\s.,''\-&]+?):[ \t]*(.*)$', chr(1) || '\1' || chr(2) || '\2', 'g'), chr(1)) AS p FROM published),
pieces AS (SELECT call_id, unnest(p[2:]) AS b, unnest(range(len(p) - 1)) AS block_no FROM marked),
cut AS (SELECT call_id, block_no, regexp_replace(trim(string_split(trim(string_split(b, chr(2))[1]), ',')[1]), '\s+', ' ', 'g') AS name,
  regexp_replace(regexp_replace(regexp_replace(string_split(b, chr(2))[2], '^\s+|\s+$', '', 'g'), '\([^)]*\)', ' ', 'g'), '\[[^\]]*\]', ' ', 'g') AS text FROM pieces)"""


@query("speaker_blocks", with_tables("segments", more=PUBLISHED + "," + BLOCKS, query="SELECT call_id, CAST(block_no AS INTEGER) AS block_no, name, text FROM cut WHERE text <> ''"))
def speaker_blocks(spark, folder):
    return spk.speaker_blocks(published(call_segments(spark, folder)))


@query("name_validity", f"""
WITH n AS (SELECT DISTINCT array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || CASE WHEN p_size < 10 THEN ' Sale' WHEN p_size < 20 THEN ' X' WHEN p_size < 30 THEN ' Ring' ELSE '' END AS name FROM part)
SELECT name, len(string_split(name, ' ')) BETWEEN 2 AND 3 AND len(list_filter(string_split(name, ' '), lambda w: NOT regexp_matches(w, '^[A-Z][a-z]+$') OR list_contains({[w for w in fv.NAME_BLACKLIST]}, lower(w)))) = 0 AS is_person FROM n""")
def name_validity(spark, folder):
    suffix = F.when(F.col("p_size") < 10, " Sale").when(F.col("p_size") < 20, " X").when(F.col("p_size") < 30, " Ring").otherwise("")
    names = table(spark, folder, "part").select(F.concat(F.initcap("p_name"), suffix).alias("name")).distinct()
    return names.select("name", nm.is_person(F.col("name")).alias("is_person"))


@query("analyst_cues", with_tables("segments", query=r"""
  SELECT call_id, idx, regexp_extract(text, 'next question from (\w+ \w+) with', 1) AS name, regexp_extract(text, 'with (\w+ Research)\. Please', 1) AS firm FROM segments
  WHERE regexp_matches(text, 'take our next question from \w+ \w+ with \w+ Research\.')"""))
def analyst_cues(spark, folder):
    rows = call_segments(spark, folder).select("call_id", "idx", nm.analyst_cue(F.col("text")).alias("_c"))
    return rows.where(F.col("_c").isNotNull()).select("call_id", "idx", "_c.*")
