"""Dictionary and containment joins between texts and phrase tables, by equi-join on n-grams instead of all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = "_gram"


def has_border(tokens: Column) -> Column:
    """True where a phrase can overlap a shifted copy of itself."""
    n = F.size(tokens)
    shifts = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.exists(shifts, lambda s: F.slice(tokens, s + 1, n - s) == F.slice(tokens, F.lit(1), n - s))


def dictionary_counts(texts: DataFrame, phrases: DataFrame, key: str, longest: int) -> DataFrame:
    """Occurrences of every phrase per text, left to right without overlap.

    texts: key, tokens array.  phrases: phrase (tokens joined by one space, up to ``longest`` tokens).  The join is an
    equi-join on the word run and emits true matches only; the planner broadcasts the phrase side if its size allows and
    otherwise splits hot runs.  Positions are kept only for phrases that can overlap themselves.  A longer phrase is an error."""
    sizes = F.sequence(F.lit(1), F.lit(longest))
    rows = texts.select(
        key, "tokens", F.explode(sizes).alias("_n")
    ).where(F.size("tokens") >= F.col("_n"))
    runs = rows.select(
        key, "_n",
        F.posexplode(F.transform(
            F.sequence(F.lit(1), F.size("tokens") - F.col("_n") + 1), lambda i: F.array_join(F.slice("tokens", i, F.col("_n")), " ")
        )).alias("_pos", GRAM),
    )
    dictionary = phrases.select(
        F.col("phrase").alias(GRAM), F.size(F.split("phrase", " ")).alias("_n"), has_border(F.split("phrase", " ")).alias("_border")
    ).distinct().where(F.expr(f"if(_n <= {longest}, true, raise_error(concat('phrase over {longest} tokens: ', {GRAM})))"))
    hits = runs.join(dictionary, [GRAM, "_n"])
    grouped = hits.groupBy(key, F.col(GRAM).alias("phrase")).agg(
        F.count(F.lit(1)).alias("_all"), F.max("_n").alias("_n"),
        F.sort_array(F.collect_list(F.when(F.col("_border"), F.col("_pos")))).alias("_at"),
    )
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("free"))
    apart = F.aggregate(
        "_at", start,
        lambda acc, p: F.when(p >= acc["free"], F.struct((acc["n"] + 1).alias("n"), (p + F.col("_n")).alias("free"))).otherwise(acc),
    )["n"]
    return grouped.select(key, "phrase", F.when(F.size("_at") > 0, apart).otherwise(F.col("_all")).cast("long").alias("n"))


def _runs_of(text: str, w: int) -> Column:
    """All character runs of length ``w`` of a text column, overlapping, in one linear scan."""
    return F.regexp_extract_all(F.col(text), F.lit(rf"(?s)(?=(.{{{w}}}))"), F.lit(1))


def containing(texts: DataFrame, keys: list[str], text: str, phrases: DataFrame, phrase: str, shortest: int = 1, width: int = 6) -> DataFrame:
    """Pairs (text, phrase) where the text contains the phrase anywhere.  ``keys`` identify a text row.

    Both sides meet on the phrase's first ``width`` characters (shorter phrases on all of theirs).  Only (keys, run) rows
    go through that join, never the texts; the few candidate pairs fetch their text afterwards and are checked.  Say how
    long the ``shortest`` phrase is to skip the short runs; a shorter one (but the empty) is an error."""
    phrases = phrases.where(F.when((F.length(phrase) == 0) | (F.length(phrase) >= shortest), True).otherwise(
        F.raise_error(F.concat(F.lit(f"phrase under {shortest} characters: "), F.col(phrase))).cast("boolean")))
    rest = [c for c in phrases.columns if c != phrase]
    size = F.length(phrase)

    def candidates(widths: list[int], rule: Column) -> DataFrame:
        grams = F.flatten(F.array(*[_runs_of(text, w) for w in widths]))
        runs = texts.select(*keys, F.explode(grams).alias(GRAM))
        needles = phrases.where(rule).select(phrase, *rest, F.substring(F.col(phrase), 1, width).alias(GRAM))
        return runs.join(needles, GRAM).select(*keys, phrase, *rest)

    pairs = candidates([width], size >= width)
    if shortest < width:
        pairs = pairs.unionByName(candidates(list(range(max(1, shortest), width)), (size > 0) & (size < width)))
    return pairs.distinct().join(texts.select(*keys, text), keys).where(F.contains(F.col(text), F.col(phrase)))
