"""Word- and chunk-level operators: chunk plans, boundary ownership, utterances, overlap removal, filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv
from callweave.operators.ordered import SLICE, neighbour, running, slice_by
from callweave.session import cut_lineage

CALL = ["call_id"]


def chunk_plan(calls: DataFrame, length: float = fv.CHUNK_SEC, overlap: float = fv.CHUNK_OVERLAP_SEC) -> DataFrame:
    """Overlapping windows covering [0, duration_sec] of every call; the last one is clipped and final."""
    step = length - overlap
    n = F.greatest(F.lit(1), F.ceil((F.col("duration_sec") - length) / step) + 1).cast("int")
    plan = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda k: F.struct(
            k.alias("chunk_idx"),
            (k * step).alias("start_sec"),
            F.least(k * step + length, F.col("duration_sec")).alias("end_sec"),
            (k == n - 1).alias("is_final"),
        ),
    )
    return (
        calls.where(F.col("duration_sec") > 0)
        .select(*[c for c in calls.columns if c != "duration_sec"], "duration_sec", F.inline(plan))
        .withColumn("chunk_sec", F.round(F.col("end_sec") - F.col("start_sec"), 3))
    )


def word_times(segments: DataFrame, words: Column, min_sec: float = 0.0) -> DataFrame:
    """Spreads a segment's time evenly over its words."""
    kept = [c for c in segments.columns if c not in ("start", "end", "text")]
    # The words are split in a step of their own: beside the generator their number would be found anew for every word.
    split = segments.select(*kept, F.col("start").alias("_s"), F.greatest(F.col("end") - F.col("start"), F.lit(min_sec)).alias("_long"), words.alias("_words"))
    sized = split.select(*kept, "_s", (F.col("_long") / F.size("_words")).alias("_step"), "_words")
    out = sized.select(*kept, "_s", "_step", F.posexplode("_words").alias("pos", "word"))
    return out.select(
        *[c for c in out.columns if c not in ("_s", "_step", "pos", "word")], "pos", "word",
        F.round(F.col("_s") + F.col("pos") * F.col("_step"), 3).alias("start"),
        F.round(F.col("_s") + (F.col("pos") + 1) * F.col("_step"), 3).alias("end"),
    )


def word_probability(logprob: Column) -> Column:
    return F.least(F.lit(1.0), F.exp(logprob))


def own_words(words: DataFrame, plan: DataFrame, margin: float = fv.BOUNDARY_SEC) -> DataFrame:
    """Keeps a word in exactly one of the overlapping chunks that heard it; re-pass words are always kept."""
    plan = slice_by(plan.select("call_id", "chunk_idx", "start_sec", "duration_sec"), "chunk_idx")
    plan = neighbour(plan, CALL, ["chunk_idx"], {"_next": F.col("start_sec")}, ahead=True)
    bounds = plan.select(
        "call_id", "chunk_idx",
        F.when(F.col("chunk_idx") == 0, 0.0).otherwise(F.col("start_sec") + margin).alias("_left"),
        F.coalesce(F.col("_next") + margin, F.col("duration_sec")).alias("_right"),
    )
    inside = (F.col("start") >= F.col("_left")) & (F.col("start") < F.col("_right"))
    keep = inside | F.col("is_repass") if "is_repass" in words.columns else inside
    return words.join(bounds, ["call_id", "chunk_idx"]).where(keep).drop("_left", "_right")


def join_words(words: Column) -> Column:
    """Words to text with punctuation attached to the word before."""
    return F.trim(F.regexp_replace(F.array_join(words, " "), r" +(?=[,.!?:;%…])", ""))


def utterances(words: DataFrame, pause: float = 1.2, sentence_pause: float = 0.3, max_words: int = 25) -> DataFrame:
    """Words to segments: a break at a long pause, at a short pause after a sentence end, or after ``max_words``.

    Pause breaks do not depend on the word counter, so they form sessions by a running sum and the counter splits each
    session afterwards.  ``seq`` is the dense position of a word in its call."""
    rows = neighbour(
        slice_by(words, "seq"), CALL, ["seq"], {"_pe": F.col("end"), "_pw": F.col("word")}, ahead=False
    )
    quiet = F.col("start") - F.col("_pe")
    ended = F.col("_pw").rlike(r"[.!?]\s*$") & (quiet > sentence_pause)
    opens = F.col("_pe").isNull() | (quiet > pause) | ended
    rows = running(
        rows, CALL, ["seq"],
        {"session": ("sum", F.when(opens, 1).otherwise(0)), "_first": ("max", F.when(opens, F.col("seq")))},
    )
    rows = rows.withColumn("part", F.floor((F.col("seq") - F.col("_first")) / max_words))
    grouped = rows.groupBy("call_id", "session", "part").agg(
        F.min("start").alias("start"),
        F.max_by("end", "seq").alias("end"),
        F.transform(F.sort_array(F.collect_list(F.struct("seq", "word"))), lambda x: x["word"]).alias("_w"),
        (F.sum(F.col("prob").cast("decimal(18,6)")).cast("double") / F.count(F.lit(1))).alias("confidence"),
        F.count(F.lit(1)).alias("n_words"),
    )
    return grouped.select(
        "call_id", "session", "part", "start", "end", join_words(F.col("_w")).alias("text"), "confidence", "n_words"
    )


def repass_windows(raw: DataFrame, gap: float = 5.0, ellipsis_gap: float = 2.0, shortest: float = 3.0) -> DataFrame:
    """Stretches of a chunk worth recognising again: long silences, cut-off sentences, a late first segment.
    ``raw``: call_id, chunk_idx, seg_idx, start, end (relative to the chunk), text, chunk_sec."""
    keys = ["call_id", "chunk_idx"]
    rows = slice_by(raw, "seg_idx")
    rows = neighbour(rows, keys, ["seg_idx"], {"_ns": F.col("start")}, ahead=True)
    rows = neighbour(rows, keys, ["seg_idx"], {"_ps": F.col("start")}, ahead=False)
    until = F.coalesce(F.col("_ns"), F.col("chunk_sec"))
    quiet = until - F.col("end")
    cut_off = F.col("text").rlike(r"(\.\.\.|…)\s*$")
    left, right = F.greatest(F.lit(0.0), F.col("end")), F.least(F.col("chunk_sec"), until)
    wanted = ((quiet > gap) | (cut_off & (quiet > ellipsis_gap))) & (right - left >= shortest)
    lead_in = F.col("_ps").isNull() & (F.col("start") > gap)
    windows = F.filter(
        F.array(
            F.when(lead_in, F.struct(F.lit("lead_in").alias("kind"), F.lit(0.0).alias("from_sec"), F.col("start").alias("to_sec"))),
            F.when(wanted, F.struct(F.lit("gap").alias("kind"), left.alias("from_sec"), right.alias("to_sec"))),
        ),
        lambda w: w.isNotNull(),
    )
    return rows.select(*keys, "seg_idx", F.inline(windows))


def bare_word(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"^[.,!?:;\"']+|[.,!?:;\"']+$", "")


def drop_repeated_prefix(chunks: DataFrame, limit: int = 15) -> DataFrame:
    """Removes from each chunk text the longest run of words (up to ``limit``) that ends the chunk before.
    ``chunks``: call_id, chunk_idx, words array."""
    rows = neighbour(slice_by(chunks, "chunk_idx"), CALL, ["chunk_idx"], {"_prev": F.col("words")}, ahead=False)
    # Only the last and the first ``limit`` words can take part, so only those are cleaned and compared.
    before = F.transform(F.slice("_prev", -F.least(F.lit(limit), F.size("_prev")), F.lit(limit)), bare_word)
    here = F.transform(F.slice("words", 1, limit), bare_word)
    rows = rows.withColumn("_b", F.coalesce(before, F.array().cast("array<string>"))).withColumn("_h", here)
    most = F.least(F.lit(limit), F.size("_b"), F.size("_h"))
    k = F.coalesce(
        F.array_max(
            F.filter(
                F.when(most > 0, F.sequence(F.lit(1), most)),
                lambda n: F.slice("_b", F.size("_b") - n + 1, n) == F.slice("_h", F.lit(1), n),
            )
        ),
        F.lit(0),
    )
    return rows.withColumn("dropped", k).select(
        "call_id", "chunk_idx", "dropped",
        F.array_join(F.slice("words", F.col("dropped") + 1, F.greatest(F.size("words") - F.col("dropped"), F.lit(0))), " ").alias("text"),
    )


def stitch_pairs(before: DataFrame, after: DataFrame, keys: list[str], overlap: float = fv.CHUNK_OVERLAP_SEC) -> DataFrame:
    """Segments of two overlapping lists per key: all of ``before``, and those of ``after`` that do not repeat a text of
    ``before`` at nearly the same end or inside the overlap.  Both: keys, idx, start, end, text."""
    def trimmed(df: DataFrame) -> DataFrame:
        return df.withColumn("_t", F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", ""))

    b = trimmed(before)
    last = before.groupBy(*keys).agg((F.max_by("end", "idx") - overlap + 0.1).alias("_cutoff"))
    known = b.select(*keys, "_t", F.col("end").alias("_be"))
    a = trimmed(after).join(last, keys, "left")
    on = [a[k] == known[k] for k in keys] + [
        a["_t"] == known["_t"],
        (F.abs(known["_be"] - a["end"]) < 2.0) | (a["start"] < a["_cutoff"]),
    ]
    kept = a.join(known, on, "left_anti").drop("_cutoff", "_t")
    return before.withColumn("part", F.lit(0)).unionByName(kept.withColumn("part", F.lit(1)))


def stitch_chunks(parts: DataFrame, keys: list[str], overlap: float = fv.CHUNK_OVERLAP_SEC, near: float = 2.0) -> DataFrame:
    """Segments of overlapping chunks put together chunk by chunk: a segment goes when its text is among those kept of all chunks before, at
    nearly the same end, or anywhere while it starts before the cut-off, which follows the last segment kept so far.

    What is kept of a chunk depends on the chunks before, so it is settled by rounds: each takes the cut-offs and texts of what the round before
    kept, until nothing changes; after round k the first k chunks are final.  parts: keys, chunk_idx, idx, start, end, text; a chunk's numbers
    and its segments' rise with time."""
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"^\s+|\s+$", "")
    rows = cut_lineage(parts.withColumn("_t", text).withColumn("_kept", F.lit(True)))
    row, chunk = [*keys, "chunk_idx", "idx"], [*keys, "chunk_idx"]
    while True:
        # The last kept end up to each chunk, handed to the chunk after it.
        last = F.when(F.col("_end").isNotNull(), F.struct("chunk_idx", "_end"))
        chunks = rows.groupBy(*chunk).agg(F.max_by("end", F.when(F.col("_kept"), F.col("idx"))).alias("_end"), F.count_if("_kept").alias("_n"))
        chunks = slice_by(chunks.withColumn("_end", F.when(F.col("_n") > 0, F.col("_end"))), "chunk_idx")
        upto = running(chunks, keys, ["chunk_idx"], {"_last": ("max", last)})
        before = neighbour(upto, keys, ["chunk_idx"], {"_before": F.col("_last._end")}, ahead=False)
        cut = before.select(*chunk, (F.col("_before") - overlap + 0.1).alias("_cutoff"))
        kept = rows.where("_kept")
        seen = kept.groupBy(*keys, "_t").agg(F.min("chunk_idx").alias("_first"))
        # Nearly equal ends meet in the same or a neighbouring bucket of their difference.
        slot = F.floor(F.col("end") / near)
        ends = kept.select(*keys, "_t", F.col("chunk_idx").alias("_c"), F.col("end").alias("_e"), F.explode(F.sequence(slot - 1, slot + 1)).alias("_slot"))
        close = rows.withColumn("_slot", slot).join(ends, [*keys, "_t", "_slot"]).where((F.col("_c") < F.col("chunk_idx")) & (F.abs(F.col("_e") - F.col("end")) < near))
        close = close.select(*row).distinct().withColumn("_close", F.lit(True))
        judged = rows.join(cut, chunk, "left").join(seen, [*keys, "_t"], "left").join(close, row, "left")
        again = (F.col("start") < F.col("_cutoff")) & (F.col("_first") < F.col("chunk_idx"))
        stays = ~F.coalesce(F.col("_close"), F.lit(False)) & ~F.coalesce(again, F.lit(False))
        judged = cut_lineage(judged.withColumn("_new", stays).drop("_cutoff", "_first", "_close"))
        settled = judged.where("_new != _kept").isEmpty()
        rows = judged.withColumn("_kept", F.col("_new")).drop("_new")
        if settled:
            return rows.where("_kept").drop("_kept", "_t")


def hallucination_rule(text: Column, logprob: Column, no_speech: Column, phrases: list[str] = fv.HALLUCINATION_PHRASES) -> Column:
    """Name of the first rule a raw segment breaks; null for a segment to keep."""
    clean = F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))
    short = F.size(F.filter(F.split(clean, r"\s+"), lambda w: w != "")) <= 6
    rule = F
    for phrase in phrases:
        rule = rule.when(clean.contains(phrase) & (short | (logprob < -0.4)), F.lit(f"phrase ('{phrase}')"))
    two = lambda x: F.format_string("%.2f", x)
    return rule.when(
        (no_speech > 0.6) & (logprob < -0.6),
        F.concat(F.lit("no_speech_prob ("), two(no_speech), F.lit(" > 0.6) & avg_logprob ("), two(logprob), F.lit(" < -0.6)")),
    ).when(logprob < -1.2, F.concat(F.lit("avg_logprob ("), two(logprob), F.lit(" < -1.2)")))
