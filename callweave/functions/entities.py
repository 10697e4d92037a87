"""Entity extraction and count-limited matching."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv
from callweave.functions.editdist import bind
from callweave.functions.text import normalize, normalize_v1

CLASSES_6 = [*fv.ENTITY_PATTERNS, "person_names", "company_product", "tickers"]


def _phrase_hits(text: Column, phrases: list[str], any_case: bool) -> Column:
    """Every phrase once per occurrence between word boundaries; a plain substring test spares most pattern scans."""
    flag = "(?iU)" if any_case else "(?U)"
    fold = (lambda t: F.lower(F.upper(t))) if any_case else (lambda t: t)

    def count(seen: Column, phrase: str) -> Column:
        needle = phrase.lower() if any_case else phrase
        n = F.when(seen["low"].contains(needle), F.regexp_count(seen["raw"], F.lit(rf"{flag}\b{re.escape(phrase)}\b"))).otherwise(0)
        return F.array_repeat(F.lit(phrase), n)

    both = F.struct(text.alias("raw"), fold(text).alias("low"))
    return bind(both, lambda seen: F.flatten(F.array(*[count(seen, p) for p in phrases])))


def entities_6(
    text: Column, people: list[str] = fv.ENTITY_PEOPLE, companies: list[str] = fv.ENTITY_COMPANIES,
    tickers: list[str] = fv.ENTITY_TICKERS, patterns: dict[str, str] = fv.ENTITY_PATTERNS,
) -> Column:
    """Map from class to the entities found, in text order for patterns and list order for names."""
    parts = []
    for name, pattern in patterns.items():
        found = F.regexp_extract_all(text, F.lit("(?iU)" + pattern), F.lit(0))
        trimmed = F.transform(found, lambda e: F.regexp_replace(e, r"^\s+|\s+$", ""))
        parts += [F.lit(name), F.filter(trimmed, lambda e: F.length(e) > 1)]
    parts += [F.lit("person_names"), _phrase_hits(text, people, True)]
    parts += [F.lit("company_product"), _phrase_hits(text, companies, True)]
    parts += [F.lit("tickers"), _phrase_hits(text, tickers, False)]
    return F.create_map(*parts)


def entities_7(text: Column, names: dict[str, list[str]] = fv.ENTITY_NAMES_7, patterns: dict[str, str] = fv.ENTITY_PATTERNS_7) -> Column:
    """Seven-class variant: one case-insensitive alternation per class."""
    parts = []
    for name, _ in fv.ENTITY_WEIGHTS:
        pattern = patterns.get(name) or r"\b(?:" + "|".join(names[name]) + r")\b"
        parts += [F.lit(name), F.regexp_extract_all(text, F.lit("(?iU)" + pattern), F.lit(0))]
    return F.create_map(*parts)


def normal_lists(entities: Column) -> Column:
    return F.transform_values(entities, lambda _, found: F.transform(found, lambda e: normalize_v1(e)))


def _hits(ref: Column, hyp: Column) -> Column:
    """How many hypothesis entries occur in the reference."""
    return bind(ref, lambda r: F.size(F.filter(hyp, lambda e: F.array_contains(r, e))))


def normal_hits(ref: Column, hyp: Column) -> Column:
    """Per class, how many entries of ``hyp`` occur in ``ref`` once both are normalised (``normalize_v1``). Equal entries are equal normalised,
    so only those that ``ref`` lacks as they stand are normalised, and ``ref`` for their sake."""
    def more(r: Column, rest: Column) -> Column:
        every = F.transform(F.concat(r, rest), lambda e: normalize_v1(e))
        return bind(every, lambda n: _hits(F.slice(n, F.lit(1), F.size(r)), F.slice(n, F.size(r) + 1, F.size(rest))))

    def count(side: Column) -> Column:
        lacking = F.filter(side["h"], lambda e: ~F.array_contains(side["r"], e))
        return bind(lacking, lambda rest: F.size(side["h"]) - F.size(rest) + F.when(F.size(rest) == 0, 0).otherwise(more(side["r"], rest)))

    return F.transform(F.array(*[F.struct(ref[name].alias("r"), hyp[name].alias("h")) for name, _ in fv.ENTITY_WEIGHTS]), count)


def weighted_accuracy(ref: Column, hyp: Column, hits: Column | None = None) -> Column:
    """Array of (class, ref_count, hyp_count, correct, accuracy, weight) for two maps of ``normal_lists``, or of lists as found where ``hits``
    has the result of ``normal_hits``; pass materialised columns."""
    rows = []
    for k, (name, weight) in enumerate(fv.ENTITY_WEIGHTS):
        r, h = ref[name], hyp[name]
        correct = _hits(r, h) if hits is None else hits[k]
        accuracy = F.when(F.size(r) == 0, F.when(F.size(h) == 0, 1.0).otherwise(0.95)).otherwise(
            F.round(F.least(F.lit(1.0), correct / F.greatest(F.lit(1), F.size(r))), 4))
        correct = F.when(F.size(r) == 0, 0).otherwise(correct)
        missing = F.when(F.size(r) == 0, F.size(h)).otherwise(F.greatest(F.lit(0), F.size(r) - correct))
        rows.append(F.struct(
            F.lit(name).alias("class"), F.size(r).alias("ref_count"), F.size(h).alias("hyp_count"), correct.alias("correct"),
            missing.alias("incorrect"), accuracy.alias("accuracy"), F.lit(weight).alias("weight")))
    return F.array(*rows)


def overall(scores: Column) -> Column:
    """Weighted sum over the classes of ``weighted_accuracy``."""
    return F.round(F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s["accuracy"] * s["weight"]), 4)


def literal(text: Column) -> Column:
    """Escapes a text for use inside a pattern."""
    return F.regexp_replace(text, r"([^\p{L}\p{N}_ ])", r"\\$1")


def normal_counts(entities: Column) -> Column:
    """Array of (class, entity, ref_count) of a class -> list map: distinct normalised entities with their counts."""
    def one_class(name: Column, found: Column) -> Column:
        normal = F.filter(F.transform(found, lambda e: normalize(e)), lambda e: e != "")
        return bind(normal, lambda every: F.transform(
            F.array_distinct(every),
            lambda e: F.struct(name.alias("class"), e.alias("entity"), F.size(F.filter(every, lambda x: x == e)).alias("ref_count"))))

    return F.flatten(F.transform(F.map_entries(entities), lambda kv: one_class(kv["key"], kv["value"])))


def limited_matches(found: DataFrame, keys: list[str], hyp: str = "hyp_norm") -> DataFrame:
    """Per key, class and distinct normalised entity: reference count, hypothesis count and the smaller of both.

    ``found``: keys, ``counts`` (from ``normal_counts``) and the normalised hypothesis text.  Occurrences are counted
    inside the row, so a hypothesis text is never copied per entity."""
    in_hyp = lambda e: F.regexp_count(F.col(hyp), F.concat(F.lit(r"(?U)\b"), literal(e), F.lit(r"\b")))
    rows = found.select(*keys, F.inline(F.transform("counts", lambda c: F.struct(
        c["class"].alias("class"), c["entity"].alias("entity"), c["ref_count"].alias("ref_count"), in_hyp(c["entity"]).alias("hyp_count")))))
    return rows.withColumn("matched", F.least("ref_count", "hyp_count"))


def recall(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Count-limited recall in percent; null where the reference has no entity."""
    totals = matches.groupBy(*keys).agg(F.sum("ref_count").alias("ref_count"), F.sum("matched").alias("matched_count"))
    return totals.withColumn("recall_pct", F.when(F.col("ref_count") > 0, F.col("matched_count") / F.col("ref_count") * 100.0))


def deficits(matches: DataFrame, keys: list[str]) -> DataFrame:
    """Entities the hypothesis has fewer of, largest deficit first."""
    short = F.col("ref_count") - F.col("hyp_count")
    return (
        matches.where(short > 0)
        .select(*keys, "class", "entity", "ref_count", "hyp_count", short.alias("deficit"),
                F.when(F.col("hyp_count") == 0, "Missing").otherwise("Partial").alias("status"))
    )
