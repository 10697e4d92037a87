"""Who is speaking: names and roles of diarized speakers, speaker blocks of published transcripts.

Every rule yields candidate rows (call, speaker, name, role, strength, order); one aggregate picks the winner per
speaker.  Only the analyst announcements depend on earlier assignments; they run as a fold over one short list per
call (announcements and the speakers heard after each), built by aggregates beforehand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv, names as nm
from callweave.operators import segments as seg
from callweave.operators.ordered import running, slice_by
from callweave.session import cut_lineage

CALL = ["call_id"]
# Strength of a candidate: lower wins.
HANDOVER, FIXED, THANKS, BY_ORDER, ANALYST = range(5)


def _candidates(rows: DataFrame, speaker: str, name, role, strength: int, order: Column) -> DataFrame:
    return rows.select(
        "call_id", F.col(speaker).alias("speaker_id"), name.alias("name"), role.alias("role"), F.lit(strength).alias("strength"),
        order.cast("long").alias("order"))


def opening_roster(segments: DataFrame, limit: int = 35) -> DataFrame:
    """Named executives of the opening text in order of mention: call_id, pos, name, role."""
    intro = seg.opening_text(segments, limit)
    text = F.col("text")
    mentioned = F.lower(text).rlike("|".join(fv.ROSTER_WORDS))
    pair = lambda pattern: F.arrays_zip(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias("name"), F.regexp_extract_all(text, F.lit(pattern), F.lit(2)).alias("role"))
    none = F.array().cast("array<struct<name:string,role:string>>")
    every = F.concat(
        F.when(mentioned, pair(fv.ROSTER_ENTRY)).otherwise(none),
        F.slice(pair(fv.HOST_BY_OPERATOR), 1, 1), F.slice(pair(fv.HOST_BY_SELF), 1, 1))
    rows = intro.select("call_id", F.posexplode(every).alias("pos", "_e")).select(
        "call_id", "pos", nm.clean_name(F.col("_e.name")).alias("name"), F.trim(F.col("_e.role")).alias("role"))
    # A repeated name keeps its first place and takes its last title.
    return rows.where(nm.is_person(F.col("name"))).groupBy("call_id", "name").agg(
        F.min("pos").alias("pos"), F.max_by("role", "pos").alias("role"))


def _rule_match(ticker: Column, rules, kind: str, value) -> Column:
    """First rule of a kind for the row's company ("*" = any company without its own rule)."""
    own, general = [r for r in rules if r[1] == kind and r[0] != "*"], [r for r in rules if r[1] == kind and r[0] == "*"]
    out = F
    for r in own:
        out = out.when((ticker == r[0]) & value(r)[0], value(r)[1])
    named = sorted({r[0] for r in own})
    free = ~ticker.isin(named) if named else F.lit(True)
    for r in general:
        out = out.when(F.coalesce(free, F.lit(True)) & value(r)[0], value(r)[1])
    return out


def _person(rule) -> Column:
    return F.struct(F.lit(rule[3]).alias("name"), F.lit(rule[4]).alias("role"))


def resolve_speakers(segments: DataFrame, rules=fv.SPEAKER_RULES) -> DataFrame:
    """Adds speaker_name and speaker_role.  segments: call_id, idx, ticker, speaker_id, text, section (first pass)."""
    # Read by every rule below, so computed once and cut from its history.
    segments = cut_lineage(segments)
    rows = segments.select("call_id", "idx", "ticker", "speaker_id", "text", "section")
    text, idx = F.col("text"), F.col("idx")
    in_intro, in_remarks = F.col("section") == "operator_intro", F.col("section") == "prepared_remarks"

    greets = in_intro & F.lower(text).rlike("|".join(fv.OPERATOR_WORDS))
    operator = rows.groupBy("call_id").agg(F.min_by(F.when(greets, F.col("speaker_id")), F.when(greets, idx)).alias("_operator"))
    rows = rows.join(operator, "call_id")
    not_operator = ~F.col("speaker_id").eqNullSafe(F.col("_operator"))
    op_rows = operator.where(F.col("_operator").isNotNull())
    found = [_candidates(op_rows, "_operator", F.lit(fv.OPERATOR_NAME), F.lit("Operator"), FIXED, F.lit(0))]

    # Host: the first prepared speaker, named by the roster's relations entry or the company's default.
    prepared = rows.where(in_remarks & not_operator)
    first = prepared.groupBy("call_id").agg(F.min_by("speaker_id", "idx").alias("_host"), F.min("ticker").alias("ticker"))
    roster = opening_roster(segments)
    listed = roster.where(F.lower("role").contains("relations")).groupBy("call_id").agg(
        F.min_by(F.struct("name", "role"), "pos").alias("_listed"))
    host = first.join(listed, "call_id", "left").withColumn(
        "_p", F.coalesce("_listed", _rule_match(F.col("ticker"), rules, "host", lambda r: (F.lit(True), _person(r)))))
    found.append(_candidates(host, "_host", F.col("_p.name"), F.col("_p.role"), FIXED, F.lit(0)))

    # Thanks: the speaker who thanks somebody; handovers: whoever else speaks next.  The last handover wins.
    says = lambda r: (text.rlike(r[2]), _person(r))
    tick = F.col("ticker")
    after = seg.next_other_speaker(
        segments.join(operator, "call_id"), F.col("speaker_id").eqNullSafe(F.col("_operator"))
    ).select("call_id", "idx", F.col("next_speaker").alias("_next"))
    cues = prepared.select(
        "call_id", "idx", "speaker_id",
        *[_rule_match(tick, rules, kind, says).alias(kind) for kind in ("thanks_host", "handover_lead", "handover_finance", "thanks_lead")])
    cues = cues.where(F.coalesce("thanks_host", "handover_lead", "handover_finance", "thanks_lead").isNotNull())
    handed = cues.join(after, ["call_id", "idx"]).where(F.col("_next").isNotNull())
    for step, kind in enumerate(("handover_lead", "handover_finance")):
        c = handed.where(F.col(kind).isNotNull())
        found.append(_candidates(c, "_next", F.col(f"{kind}.name"), F.col(f"{kind}.role"), HANDOVER, -(F.col("idx") * 4 + step)))
    for step, kind in ((0, "thanks_host"), (3, "thanks_lead")):
        c = cues.where(F.col(kind).isNotNull())
        found.append(_candidates(c, "speaker_id", F.col(f"{kind}.name"), F.col(f"{kind}.role"), THANKS, F.col("idx") * 4 + step))

    # Order of the prepared speakers, host left out.
    runs = seg.with_runs(prepared.select("call_id", "idx", "ticker", "speaker_id", F.lit(0.0).alias("start"), F.lit(0.0).alias("end")))
    runs = runs.groupBy("call_id", "run_no").agg(F.min("speaker_id").alias("speaker_id"), F.min("ticker").alias("ticker"))
    runs = runs.join(first.select("call_id", "_host"), "call_id").where(F.col("speaker_id") != F.col("_host"))
    lead = runs.groupBy("call_id").agg(F.min("run_no").alias("_first_run"), F.min("ticker").alias("ticker"))
    tail = runs.join(lead.select("call_id", "_first_run"), "call_id").where(F.col("run_no") > F.col("_first_run"))
    places = [("first", runs), ("second", tail)]
    for kind, pool in places:
        c = pool.groupBy("call_id").agg(F.min_by("speaker_id", "run_no").alias("_who"), F.min("ticker").alias("ticker"))
        c = c.withColumn("_p", _rule_match(F.col("ticker"), rules, kind, lambda r: (F.lit(True), _person(r)))).where(F.col("_p").isNotNull())
        found.append(_candidates(c, "_who", F.col("_p.name"), F.col("_p.role"), BY_ORDER, F.lit(places.index((kind, pool)))))

    known = found[0]
    for c in found[1:]:
        known = known.unionByName(c)
    known = cut_lineage(
        known.groupBy("call_id", "speaker_id").agg(F.min_by(F.struct("name", "role"), F.struct("strength", "order")).alias("_who")))
    heard = segments.where(F.col("section").isin("operator_intro", "prepared_remarks")).select("call_id", "speaker_id").distinct()
    barred = heard.unionByName(known.select("call_id", "speaker_id")).distinct()
    analysts = announce_analysts(rows.where(F.col("section") == "qa"), barred)
    who = known.select("call_id", "speaker_id", "_who.*").unionByName(analysts)
    good = nm.is_person(F.col("name"))
    role = F.when(F.col("role").startswith("Analyst, "), F.col("role")).otherwise(nm.clean_role(F.col("role")))
    return (
        segments.drop("speaker_name", "speaker_role").join(who, ["call_id", "speaker_id"], "left")
        .withColumn("speaker_name", F.when(good, F.col("name")))
        .withColumn("speaker_role", F.when(good, role).otherwise("Unknown"))
        .drop("name", "role")
    )


def announce_analysts(questions: DataFrame, barred: DataFrame) -> DataFrame:
    """Gives every announced analyst to the first speaker heard after the announcement who is neither ``barred`` nor
    taken; a new announcement replaces one still waiting.  An announcement that names no valid person changes nothing.

    questions: call_id, idx, speaker_id, text of the question part."""
    rows = questions.withColumn("_cue", nm.analyst_cue(F.col("text")))
    named = F.col("_cue").isNotNull() & nm.is_person(F.col("_cue.name"))
    rows = running(slice_by(rows, "idx"), CALL, ["idx"], {"_turn": ("sum", F.when(named, 1).otherwise(0))})
    cues = rows.where(named).select("call_id", "_turn", "_cue")
    free = rows.where(F.col("_cue").isNull() & (F.col("_turn") > 0)).join(barred, ["call_id", "speaker_id"], "left_anti")
    heard = free.groupBy("call_id", "_turn", "speaker_id").agg(F.min("idx").alias("idx"))
    heard = heard.groupBy("call_id", "_turn").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("idx", "speaker_id"))), lambda x: x["speaker_id"]).alias("_heard"))
    steps = cues.join(heard, ["call_id", "_turn"]).groupBy("call_id").agg(
        F.sort_array(F.collect_list(F.struct("_turn", "_heard", "_cue"))).alias("_steps"))
    start = F.array().cast("array<struct<speaker_id:string,name:string,role:string>>")

    def give(taken: Column, step: Column) -> Column:
        used = F.transform(taken, lambda t: t["speaker_id"])
        open_ = F.array_except(step["_heard"], used)
        entry = F.struct(
            F.get(open_, F.lit(0)).alias("speaker_id"), step["_cue"]["name"].alias("name"),
            F.concat(F.lit("Analyst, "), step["_cue"]["firm"]).alias("role"))
        return F.when(F.size(open_) > 0, F.concat(taken, F.array(entry))).otherwise(taken)

    return steps.select("call_id", F.inline(F.aggregate("_steps", start, give)))


def speaker_blocks(texts: DataFrame, key: str = "call_id", text: str = "text") -> DataFrame:
    """Published transcript to (key, block_no, name, text): a label opens a block, its name ends at the first comma,
    notes in brackets are dropped.  A text without labels is one UNKNOWN block."""
    marked = F.regexp_replace(F.col(text), fv.SPEAKER_LABEL, "\u0001$1\u0002$2")
    pieces = F.split(marked, "\u0001")
    labelled = F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
    none = F.array(F.concat(F.lit("UNKNOWN\u0002"), F.col(text)))
    rows = texts.select(key, F.posexplode(F.when(F.size(pieces) > 1, labelled).otherwise(none)).alias("block_no", "_b"))
    name = F.regexp_replace(F.trim(F.split_part(F.trim(F.split_part("_b", F.lit("\u0002"), F.lit(1))), F.lit(","), F.lit(1))), r"\s+", " ")
    body = F.regexp_replace(F.split_part("_b", F.lit("\u0002"), F.lit(2)), r"^\s+|\s+$", "")
    body = F.regexp_replace(F.regexp_replace(body, r"\([^)]*\)", " "), r"\[[^\]]*\]", " ")
    return rows.select(key, "block_no", name.alias("name"), body.alias("text")).where(F.col("text") != "")
