"""Transcript text cleaning and normalising as column expressions (no Python in the data path).

``U`` = Unicode-aware word characters and boundaries, so accented words behave like plain ones.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv
from callweave.functions.editdist import bind

SPACES = r"[\s\p{Z}\x1c-\x1f\x85]+"


def in_runs(text: Column, run: str, change) -> Column:
    """``change`` applied to the matches of ``run`` alone, which are joined by NUL for it; the text between them is left as it is. A long chain of
    rules then reads the few places it can touch, not the whole text. Matches and what ``change`` makes of them hold no NUL."""
    def changed(whole: Column) -> Column:
        new = F.split(change(F.array_join(F.regexp_extract_all(whole, F.lit(run), F.lit(0)), "\0")), "\0")
        return F.array_join(F.zip_with(F.split(whole, run), new, lambda gap, word: F.concat(gap, F.coalesce(word, F.lit("")))), "")

    return bind(text, changed)


def where_contains(text: Column, mark: str, change) -> Column:
    """``change`` applied to texts that contain ``mark``; the others as they are."""
    return bind(text, lambda t: F.when(t.contains(mark), change(t)).otherwise(t))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACES}|{SPACES}$", "")


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def fold_punctuation(text: Column) -> Column:
    """Curly quotes, back-ticks, long dashes and no-break spaces to their plain forms."""
    # All but the back-tick are beyond ASCII.
    plain = lambda t: (F.octet_length(t) == F.length(t)) & ~t.contains("`")
    return bind(text, lambda t: F.when(plain(t), t).otherwise(F.translate(t, "’‘`“”–— ", "'''\"\"-- ")))


def drop_stamps(text: Column) -> Column:
    """Removes ``[1.0 --> 2.5]`` marks."""
    return where_contains(text, "-->", lambda t: F.regexp_replace(t, r"\[\s*\d+(?:\.\d+)?\s*-->\s*\d+(?:\.\d+)?\s*\]", " "))


def drop_headers(text: Column) -> Column:
    """Spoken words of a published transcript: no parentheticals, titles, dates, attendee lists or speaker labels."""
    lines = F.transform(F.split(F.regexp_replace(text, r"\([^)]*\)", " "), "\n"), strip)

    def spoken(line: Column) -> Column:
        meta = (
            (line == "") | F.upper(line).isin(fv.MARKER_LINES) | line.rlike("(?i)" + fv.TITLE_LINE)
            | line.rlike("(?i)" + fv.DATE_LINE) | line.rlike(fv.ATTENDEE_LINE)
        )
        return ~meta

    def bare_caps(line: Column) -> Column:
        return line.rlike(fv.CAPS_LINE) & ~line.rlike(fv.CAPS_LINE_SPEECH)

    said = F.transform(F.filter(lines, spoken), lambda line: F.regexp_replace(line, fv.LABEL_PREFIX, ""))
    return F.array_join(F.filter(said, lambda line: (line != "") & ~bare_caps(line)), " ")


def _word_rule(word: str) -> str:
    return rf"(?iU)\b{word}\b"


#: Runs without spaces that hold an apostrophe: every contraction has one and no space, so it lies in such a run with both its boundaries.
APOSTROPHE_RUN = r"(?<![^ \x00])[^ '\x00]*+'[^ \x00]*+"


def expand_contractions(text: Column, rules: list[tuple[str, str]] = fv.CONTRACTIONS) -> Column:
    """Contractions to full forms, rule by rule; rows without an apostrophe skip the chain."""
    def expanded(runs: Column) -> Column:
        for short, long in rules:
            runs = F.regexp_replace(runs, _word_rule(short), long)
        return runs

    return where_contains(text, "'", lambda t: in_runs(t, APOSTROPHE_RUN, expanded))


def contraction_passes(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Merges neighbouring rules that only replace the same ending ("he'd", "it'd" -> "$1 would") into one pass.

    A rule is regular when its expansion keeps the word before the ending.  Regular rules are grouped by ending; a
    group stays in front of a later rule it can feed ("he'd've" -> "he would've" -> "he would have")."""
    def ending(rule):
        short, long = rule
        stem, _, added = long.rpartition(" ")
        return (short[len(stem):], added) if stem and short.startswith(stem) and len(short) > len(stem) else None

    last_fed = next((i for i, r in enumerate(rules) if r[0] == "would've"), len(rules))
    ranked = [
        ((2 if i > last_fed and ending(r) and ending(r)[1] == "would" else 1 if ending(r) and ending(r)[0] == "'ve" else 0,
          ending(r) or ("", r[0])), r)
        for i, r in enumerate(rules)
    ]
    passes = []
    for (_, (tail, added)), group in groupby(sorted(ranked, key=lambda x: x[0]), key=lambda x: x[0]):
        members = [r for _, r in group]
        if tail:
            stems = "|".join(sorted(r[0][: -len(tail)] for r in members))
            passes.append((f"({stems}){tail}", f"$1 {added}"))
        else:
            passes += members
    return passes


def expand_fast(text: Column, rules: list[tuple[str, str]] = fv.CONTRACTIONS) -> Column:
    """Same result as ``expand_contractions`` up to letter case, in a quarter of the passes."""
    return expand_contractions(text, contraction_passes(rules))


MAGNITUDES = [("bB", "billion"), ("mM", "million"), ("tT", "trillion"), ("kK", "thousand")]


#: A dollar sign with the figures, further signs and the word behind it.
AMOUNT_RUN = r"(?U)\$[\s0-9.$]*+\w*+"


def spell_figures(text: Column) -> Column:
    """Thousands commas out, dollar amounts and percent signs in words.  The comma rule runs twice, no more."""
    for _ in range(2):
        text = F.regexp_replace(text, r"(\d+),(\d+)", "$1$2")

    def dollars(runs: Column) -> Column:
        for letters, word in MAGNITUDES:
            runs = F.regexp_replace(runs, rf"(?U)\$\s*([0-9]+(?:\.[0-9]+)?)\s*(?:[{letters}]|{word})\b", f"$1 {word} dollars")
        return F.regexp_replace(runs, r"\$\s*(\d+(?:\.\d+)?)", "$1 dollars")

    text = where_contains(text, "$", lambda t: in_runs(t, AMOUNT_RUN, dollars))
    return where_contains(text, "%", lambda t: F.regexp_replace(t, r"(\d+(?:\.\d+)?)\s*%", "$1 percent"))


def drop_fillers(text: Column) -> Column:
    return F.regexp_replace(text, _word_rule("(?:" + "|".join(fv.FILLERS) + ")"), " ")


def normalize(text: Column, is_reference: bool = False) -> Column:
    """Text as compared for scoring: lower-case words and figures, single spaces."""
    text = drop_stamps(fold_punctuation(F.coalesce(text, F.lit(""))))
    if is_reference:
        text = drop_headers(text)
    text = F.lower(drop_fillers(spell_figures(expand_fast(text))))
    text = F.regexp_replace(text, r"(\d+)\.(\d+)", "$1_DOT_$2")
    # All but letters, figures and underscores, white space too, become single spaces in one pass.
    text = F.regexp_replace(text, r"[^\p{L}\p{N}_ ][^\p{L}\p{N}_]*+| [^\p{L}\p{N}_]++", " ")
    return F.trim(F.replace(text, F.lit("_DOT_"), F.lit(".")))


def raw_clean(text: Column, is_reference: bool = False) -> Column:
    """Minimal cleaning for unnormalised scores."""
    text = drop_stamps(fold_punctuation(F.coalesce(text, F.lit(""))))
    return squeeze(drop_headers(text) if is_reference else text)


def normalize_v1(text: Column) -> Column:
    """First-generation normaliser: also spells digits for small number words and drops more fillers."""
    text = expand_fast(F.lower(F.coalesce(text, F.lit(""))), fv.CONTRACTIONS_V1)
    number = r"([0-9]+(?:\.[0-9]+)?)"
    large = [("billion", "b"), ("million", "m"), ("thousand", "k")]

    def dollars(runs: Column) -> Column:
        for word, letter in large:
            runs = F.regexp_replace(runs, rf"(?U)\${number}\s*(?:{word}|{letter}\b)", f"$1 {word} dollars")
        return F.regexp_replace(runs, rf"\${number}", "$1 dollars")

    text = where_contains(text, "$", lambda t: in_runs(t, AMOUNT_RUN, dollars))
    for word, _ in large:
        text = where_contains(text, word, lambda t: F.regexp_replace(t, rf"{number}\s*{word}(?:\s*dollars)?", f"$1 {word} dollars"))
    text = where_contains(text, "dollars", lambda t: F.regexp_replace(t, r"dollars\s+dollars", "dollars"))
    text = where_contains(text, "%", lambda t: F.regexp_replace(t, rf"{number}\s*%", "$1 percent"))

    def digits(runs: Column) -> Column:
        for digit, word in enumerate(fv.NUMBER_WORDS):
            runs = F.regexp_replace(runs, _word_rule(word), str(digit))
        return runs

    text = in_runs(text, _word_rule("(?:" + "|".join(fv.NUMBER_WORDS) + ")"), digits)
    text = F.regexp_replace(text, _word_rule("(?:" + "|".join(fv.FILLERS_V1) + ")"), "")
    # Points stay between digits only; all else but letters, figures and underscores becomes single spaces in one pass.
    return F.trim(F.regexp_replace(text, r"(?:[^\p{L}\p{N}_.]|(?<!\d)\.|\.(?!\d))++", " "))


def split_reference(text: Column) -> tuple[Column, Column]:
    """(remarks, questions) of a published transcript: at the first Q&A cue line, else at half of its lines."""
    cue = F.regexp_extract(text, fv.REFERENCE_QA_LINE, 0)
    at = F.instr(text, cue)
    lines = F.split(text, "\n")
    half = F.floor(F.size(lines) * 0.5).cast("int")
    found = cue != ""
    remarks = F.when(found, F.substring(text, F.lit(1), at - 1)).otherwise(F.array_join(F.slice(lines, F.lit(1), half), "\n"))
    questions = F.when(found, F.substring(text, at, F.length(text))).otherwise(
        F.array_join(F.slice(lines, half + 1, F.size(lines) - half), "\n"))
    return remarks, questions


def minutes_seconds(seconds: Column) -> Column:
    """MM:SS."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%02d:%02d", F.floor(whole / 60).cast("long"), whole % 60)


def spoken_length(seconds: Column) -> Column:
    """Xm SSs."""
    whole = F.floor(seconds).cast("long")
    return F.format_string("%dm %02ds", F.floor(whole / 60).cast("long"), whole % 60)


def escape_html(text: Column) -> Column:
    for plain, safe in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")]:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def register_sql_functions(spark: SparkSession) -> None:
    """The cleaning steps as temporary SQL functions, so SQL users get the same semantics."""
    q = lambda s: s.replace("\\", "\\\\").replace("'", "\\'")
    fillers = q(_word_rule("(?:" + "|".join(fv.FILLERS) + ")"))
    spell = "t"
    for _ in range(2):
        spell = f"regexp_replace({spell}, '{q(r'([0-9]+),([0-9]+)')}', '$1$2')"
    for letters, word in MAGNITUDES:
        pattern = q(rf"(?U)\$\s*([0-9]+(?:\.[0-9]+)?)\s*(?:[{letters}]|{word})\b")
        spell = f"regexp_replace({spell}, '{pattern}', '$1 {word} dollars')"
    dollars, percent = q(r"\$\s*([0-9]+(?:\.[0-9]+)?)"), q(r"([0-9]+(?:\.[0-9]+)?)\s*%")
    spell = f"regexp_replace(regexp_replace({spell}, '{dollars}', '$1 dollars'), '{percent}', '$1 percent')"
    bodies = {
        "cw_spell_figures": spell,
        "cw_drop_fillers": f"regexp_replace(t, '{fillers}', ' ')",
        "cw_squeeze": f"trim(regexp_replace(t, '{q(SPACES)}', ' '))",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(t STRING) RETURNS STRING RETURN {body}")
