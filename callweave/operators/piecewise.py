"""Alignment of long word sequences cut into pieces that are aligned side by side, with the result of the uncut alignment.

The alignment takes the longest common run first, then both sides of it in the same way. A run of ``gram`` words or more starts with a common
n-gram, so joining n-grams by (call, hash) finds all such runs, each a stretch of one diagonal. Only their places meet per call: there the
longest run of every window is taken from the list, clipped to the window, until the longest left is shorter than ``gram``. What remains are
windows without a long run; each is a row of its own with just its words, aligned in its own task. A call whose n-grams repeat so much that
they would meet more than ``most`` times its length is aligned as one piece.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions.alignment import align
from callweave.operators.ordered import SLICE, running, slice_by, spread

GRAM, MOST, CONTEXT = 5, 16, 3

PLAN = T.ArrayType(T.StructType(
    [T.StructField("run", T.BooleanType()), *[T.StructField(n, T.IntegerType()) for n in ("i1", "i2", "j1", "j2")]]))


def windows(runs: list[tuple[int, int, int]], n: int, m: int, gram: int) -> list[tuple[bool, int, int, int, int]]:
    """Long runs taken longest first (ties: earliest in the reference, then in the hypothesis) and the windows between them."""
    out, todo = [], [(0, n, 0, m, runs)]
    while todo:
        a0, a1, b0, b1, near = todo.pop()
        clipped = []
        for i, j, k in near:
            shift = max(0, a0 - i, b0 - j)
            size = min(k, a1 - i, b1 - j) - shift
            if size >= gram:
                clipped.append((i + shift, j + shift, size))
        if not clipped:
            if a0 < a1 or b0 < b1:
                out.append((False, a0, a1, b0, b1))
            continue
        i, j, k = min(clipped, key=lambda r: (-r[2], r[0], r[1]))
        out.append((True, i, i + k, j, j + k))
        todo += [(a0, i, b0, j, clipped), (i + k, a1, j + k, b1, clipped)]
    return sorted(out, key=lambda w: (w[1], w[3], w[2]))


def _planner(gram: int):
    @F.pandas_udf(PLAN)
    def plan(runs: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        names = ("run", "i1", "i2", "j1", "j2")
        return pd.Series([
            [dict(zip(names, w)) for w in windows([(r["i"], r["j"], r["k"]) for r in (rs if rs is not None else [])], int(x), int(y), gram)]
            for rs, x, y in zip(runs, n, m)])

    return plan


def common_runs(pairs: DataFrame, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """call_id, i, j, k: maximal common runs of ``gram`` words or more of calls whose n-grams do not repeat too much."""
    def grams(side: str, place: str) -> DataFrame:
        starts = F.when(F.size(side) >= gram, F.sequence(F.lit(1), F.size(side) - gram + 1)).otherwise(F.array().cast("array<int>"))
        hashes = F.transform(starts, lambda p: F.xxhash64(F.slice(side, p, gram)))
        return pairs.select("call_id", F.posexplode(hashes).alias(place, "gram"))

    a, b = grams("ref", "i"), grams("hyp", "j")
    times = a.groupBy("call_id", "gram").agg(F.count(F.lit(1)).alias("x")).join(b.groupBy("call_id", "gram").agg(F.count(F.lit(1)).alias("y")), ["call_id", "gram"])
    meets = times.groupBy("call_id").agg(F.sum(F.col("x") * F.col("y")).alias("meets"))
    sizes = pairs.select("call_id", (F.size("ref") + F.size("hyp")).alias("size"))
    fit = meets.join(sizes, "call_id").where(F.col("meets") <= F.col("size") * most).select("call_id")
    seeds = a.join(fit, "call_id").join(b, ["call_id", "gram"]).select("call_id", "i", "j")
    along = Window.partitionBy("call_id", "diagonal").orderBy("i")
    islands = seeds.withColumn("diagonal", F.col("i") - F.col("j")).withColumn("island", F.col("i") - F.row_number().over(along))
    return islands.groupBy("call_id", "diagonal", "island").agg(
        F.min("i").alias("i"), F.min("j").alias("j"), (F.count(F.lit(1)) + gram - 1).cast("int").alias("k")).select("call_id", "i", "j", "k")


def pieces(pairs: DataFrame, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """call_id, run, i1, i2, j1, j2, ref_words, hyp_words, before, after: long runs and windows between them, each with its own words and the
    reference words next to it."""
    runs = common_runs(pairs, gram, most).groupBy("call_id").agg(F.collect_list(F.struct("i", "j", "k")).alias("runs"))
    planned = pairs.join(runs, "call_id", "left").select(
        "call_id", "ref", "hyp", F.explode(_planner(gram)(F.col("runs"), F.size("ref"), F.size("hyp"))).alias("p"))
    cut = lambda side, lo, hi: F.slice(side, lo + 1, F.greatest(hi - lo, F.lit(0)))
    i1, i2, j1, j2 = (F.col(f"p.{c}") for c in ("i1", "i2", "j1", "j2"))
    return planned.select(
        "call_id", "p.*", cut("ref", i1, i2).alias("ref_words"), cut("hyp", j1, j2).alias("hyp_words"),
        cut("ref", F.greatest(i1 - CONTEXT, F.lit(0)), i1).alias("before"), cut("ref", i2, F.least(i2 + CONTEXT, F.size("ref"))).alias("after"))


def edit_scripts(pairs: DataFrame, gram: int = GRAM, most: int = MOST) -> DataFrame:
    """One row per entry of the calls' edit scripts: call_id, op_no, tag, i1, i2, j1, j2, ref_words, hyp_words, context (of replacements).
    ``pairs``: call_id, ref, hyp (word arrays)."""
    parts = spread(pieces(pairs, gram, most), "call_id", "i1", "j1")
    whole = F.array(F.struct(
        F.when(F.col("run"), "equal").when(F.size("hyp_words") == 0, "delete").when(F.size("ref_words") == 0, "insert").alias("tag"),
        F.lit(0).alias("i1"), F.size("ref_words").alias("i2"), F.lit(0).alias("j1"), F.size("hyp_words").alias("j2")))
    # Runs and one-sided windows are one entry each; only the others are aligned.
    done = F.col("run") | (F.size("ref_words") == 0) | (F.size("hyp_words") == 0)
    simple = parts.where(done).withColumn("ops", whole)
    aligned = parts.where(~done).withColumn("ops", align(F.col("ref_words"), F.col("hyp_words")))
    ops = simple.unionByName(aligned).withColumnsRenamed({"i1": "a", "j1": "b"}).drop("i2", "j2", "run")
    ops = ops.select("call_id", "a", "b", "ref_words", "hyp_words", "before", "after", F.explode("ops").alias("op"))
    cut = lambda side, lo, hi: F.slice(side, lo + 1, hi - lo)
    i1, i2 = F.col("op.i1"), F.col("op.i2")
    around = F.concat("before", "ref_words", "after")
    # Places inside ``around`` are shifted by the words before.
    left, right = i1 + F.size("before"), i2 + F.size("before")
    context = cut(around, F.greatest(left - CONTEXT, F.lit(0)), F.least(right + CONTEXT, F.size(around)))
    rows = ops.select(
        "call_id", F.col("op.tag").alias("tag"), (F.col("a") + i1).alias("i1"), (F.col("a") + i2).alias("i2"),
        (F.col("b") + F.col("op.j1")).alias("j1"), (F.col("b") + F.col("op.j2")).alias("j2"),
        cut("ref_words", i1, i2).alias("ref_words"), cut("hyp_words", F.col("op.j1"), F.col("op.j2")).alias("hyp_words"),
        F.when(F.col("op.tag") == "replace", F.array_join(context, " ")).alias("context"))
    return _numbered(rows)


def _numbered(rows: DataFrame) -> DataFrame:
    """Adds op_no from 0 in order of (i1, j1): places only go through the windows."""
    rows = rows.withColumn("_place", F.col("i1") + F.col("j1"))
    places = slice_by(rows.select("call_id", "i1", "j1", "_place"), "_place")
    numbers = running(places, ["call_id"], ["i1", "j1"], {"_n": ("sum", F.lit(1))}).drop(SLICE, "_place")
    return rows.drop("_place").join(numbers, ["call_id", "i1", "j1"]).select(
        "call_id", (F.col("_n") - 1).cast("int").alias("op_no"), "tag", "i1", "i2", "j1", "j2", "ref_words", "hyp_words", "context")
