"""Cleaning and checking of speaker names, titles and firms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv


def _without(text: Column, patterns: list[str], rim: str) -> Column:
    """Text with patterns taken out in turn and the characters of ``rim`` dropped at both ends."""
    out = reduce(lambda t, p: F.regexp_replace(t, p, ""), patterns, F.regexp_replace(text, r"^\s+|\s+$", ""))
    return F.regexp_replace(out, f"^[{rim}]+|[{rim}]+$", "")


def _renamed(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """The long form of a known short one, whatever its case; other texts stay."""
    known = F.create_map(*[F.lit(x) for short, long in pairs for x in (short.lower(), long)])
    return F.coalesce(F.try_element_at(known, F.lower(text)), text)


def clean_name(name: Column) -> Column:
    """Drops lead-ins and honorifics; known mis-hearings become the person's name."""
    return _renamed(_without(name, fv.NAME_LEAD_INS, r" ,.\-"), fv.MISHEARD_NAMES)


def clean_role(role: Column) -> Column:
    """Titles in one standard wording: the first of the table whose words the role has; Unknown without a role."""
    bare = F.regexp_replace(F.coalesce(role, F.lit("")), r"^\s+|\s+$", "")
    low = F.lower(bare)

    def has(words: list[str]) -> Column:
        return reduce(lambda x, y: x & y, [low.contains(w) for w in words])

    rules = F.when(bare == "", "Unknown")
    for title, ways in fv.STANDARD_ROLES:
        rules = rules.when(reduce(lambda x, y: x | y, map(has, ways)), title)
    return rules.otherwise(bare)


def clean_firm(firm: Column) -> Column:
    """Firm without the announcer's closing words, in its full name."""
    return _renamed(_without(firm, [fv.FIRM_CLOSING], r" .,\-"), fv.FIRM_NAMES)


def is_person(name: Column) -> Column:
    """Two or three capitalised words, none of them a word of the trade."""
    parts = F.split(F.trim(name), r"\s+")
    banned = F.array(*[F.lit(w) for w in fv.NAME_BLACKLIST])
    good = F.size(parts).between(2, 3) & F.forall(parts, lambda w: w.rlike("^[A-Z][a-z]+$") & ~F.array_contains(banned, F.lower(w)))
    return F.coalesce((F.trim(name) == fv.OPERATOR_NAME) | good, F.lit(False))


def analyst_cue(text: Column) -> Column:
    """(name, firm) announced as the next questioner; null when the text announces nobody."""
    hit = F.regexp_extract(text, fv.ANALYST_CUE, 0)
    part = lambda i: F.regexp_extract(text, fv.ANALYST_CUE, i)
    return F.when(hit != "", F.struct(clean_name(part(1)).alias("name"), clean_firm(part(2)).alias("firm")))
