"""Operator 8: mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) take the weights in turn and share `budget` times all words; a source's target stops at
`cap` times its words and the excess goes to the others by weight. That is one level L with target = min(cap * words, L * weight), found in
closed form over the sources sorted by cap * words / weight.

Choice: every document is taken floor(target / words) times; the rest of the target goes to a prefix of the source's documents in md5 order of
the id, then in rounds to the largest further document that still fits and to those after it in the order of size that fit together with it.
`mixed` goes on until no document fits the gap of any source; the query takes FILLS times the one largest document, as its SQL states. Whole
documents only, so a source of `mixed` ends short of its target by less than its smallest document not taken, and no document is taken more
than ceil(cap) times.

Positions: each source has a piecewise-linear schedule of its weight over training time 0 to 1. The schedule is integrated to the source's
cumulative demand and inverted at the document's place among the words taken; documents are range-sorted by that position.

Running sums are two-level (md5 prefix, then inside a prefix), so a source with most of the rows is spread over tasks. Null or wordless texts
have size 0 and are taken as often as the base count says, with 0 words. Null ids hash as an empty id. Repeated rows are separate documents.
An empty table gives an empty table. Columns named like the results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callweave.llm import common

WEIGHTS = (3.0, 1.0, 2.0)
#: Schedule of the sources in turn: (time, weight) knots; rising, level, falling.
SCHEDULES = (((0.0, 1.0), (1.0, 3.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 2.0), (0.5, 2.0), (1.0, 1.0)))
FILLS = 3
PREFIX = 3


def sized(docs: DataFrame) -> DataFrame:
    """Id, source, words and md5 order of each document, written once: all later steps read this narrow table."""
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    return common.written(
        docs.select("doc_id", "source", common.n_words(F.col("text")).alias("size"), digest.alias("digest"))
        .withColumn("row", F.monotonically_increasing_id())
    )


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per source: rank, source_size, target. Windows run over sources, not documents."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("limit", "rank")
    upto, after = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(every) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", cap * F.col("source_size") / F.col("weight"))
    )
    # With the sources of smaller limit capped, the level of the rest; it holds at the first source, by limit, that it does not exceed.
    level = (budget * F.sum("source_size").over(whole) - F.coalesce(cap * F.sum("source_size").over(upto), F.lit(0.0))) / F.sum("weight").over(after)
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("limit"), F.struct("limit", "rank", "level"))).over(whole)["level"])
        .withColumn("target", F.least(cap * F.col("source_size"), F.coalesce(F.col("level") * F.col("weight"), cap * F.col("source_size"))))
        .select("source", "rank", "source_size", "target")
    )


def running(sizes: DataFrame) -> DataFrame:
    """Adds `before`: the words of the source's documents ahead in md5 order."""
    keyed = sizes.withColumn("prefix", F.substring("digest", 1, PREFIX))
    totals = keyed.groupBy("source", "prefix").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("source", "prefix", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source", "prefix").orderBy("digest", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.prefix") == F.col("b.prefix"))
    return placed.alias("a").join(totals.alias("b"), same).select("a.*", "b.base").withColumn("before", F.col("base") + F.col("inside")).drop("base", "inside", "prefix")


def position(u: Column, rank: Column, schedules: tuple = SCHEDULES) -> Column:
    """Training time at which the source's integrated schedule has reached the share u of its whole."""
    out = None
    for k, knots in enumerate(schedules):
        pieces, total = [], 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            pieces.append((t0, t1, w0, w1, total))
            total += (w0 + w1) / 2 * (t1 - t0)
        found = None
        for t0, t1, w0, w1, start in pieces:
            need, slope = u * total - start, (w1 - w0) / (t1 - t0)
            # The root of w0 x + slope x^2 / 2 = need, in the form that also holds for slope 0.
            x = F.lit(t0) + 2 * need / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * need, F.lit(0.0))))
            end = start + (w0 + w1) / 2 * (t1 - t0)
            found = F.when(u * total <= end, x) if found is None else found.when(u * total <= end, x)
        found = F.least(F.lit(1.0), F.coalesce(found, F.lit(1.0)))
        out = F.when(rank % len(schedules) == k, found) if out is None else out.when(rank % len(schedules) == k, found)
    return out


def chosen(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = 1.5, cap: float = 2.0, fills: int | None = FILLS) -> DataFrame:
    """One row per document: row, doc_id, source, size, source_size, target, rank, before, copies.

    Without `fills` all gaps are filled, and `place` has the words of the documents ahead that are taken once more, for those that are.
    """
    sizes = sized(docs)
    goal = targets(sizes, weights, budget, cap)
    same = F.col("d.source").eqNullSafe(F.col("t.source"))
    rows = running(sizes).alias("d").join(goal.alias("t"), same).select("d.*", "t.rank", "t.source_size", "t.target")
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target") - F.col("base") * F.col("source_size"))
    rows = rows.withColumn("base", base).withColumn("rest", rest.cast("long"))
    rows = rows.withColumn("extra", (F.col("before") + F.col("size") <= F.col("rest")).cast("long"))
    if fills is None:
        rows = filled(rows)
        extra = running(rows.where("extra = 1").select("row", "doc_id", "source", "size", "digest")).select("row", F.col("before").alias("place"))
        return rows.join(extra, "row", "left").withColumn("copies", F.col("base") + F.col("extra")).drop("base", "extra", "rest")
    for _ in range(fills):
        rows = common.written(rows)
        left = rows.groupBy("source").agg((F.max("rest") - F.sum(F.col("size") * F.col("extra"))).alias("left"))
        same = F.col("d.source").eqNullSafe(F.col("l.source"))
        fits = rows.alias("d").join(left.alias("l"), same).where("d.extra = 0 AND d.size > 0 AND d.size <= l.left")
        best = fits.groupBy("d.source").agg(F.max_by("d.row", F.struct("d.size", "d.digest", "d.doc_id", "d.row")).alias("best"))
        # One row per source at most, found by its row number.
        rows = rows.join(best.select(F.col("best").alias("row"), F.lit(1).alias("filled")), "row", "left")
        rows = rows.withColumn("extra", F.greatest("extra", F.coalesce("filled", F.lit(0)).cast("long"))).drop("filled")
    return rows.withColumn("copies", F.col("base") + F.col("extra")).drop("base", "extra", "rest")


def filled(rows: DataFrame) -> DataFrame:
    """`rows` with `extra` also 1 for documents that fill the gaps, until no further document fits the gap of its source.

    A round takes the documents that fit, largest first, up to the first that does not fit with those before it. They are more than half of the gap,
    so rounds are few. Sums run over the sizes of a source; only in the one size that is taken in part do documents have an order.
    """
    ahead = Window.partitionBy("source").orderBy(F.col("size").desc())
    while True:
        rows = common.written(rows)
        left = rows.groupBy("source").agg((F.max("rest") - F.sum(F.col("size") * F.col("extra"))).alias("left"))
        same = F.col("d.source").eqNullSafe(F.col("l.source"))
        fits = rows.alias("d").join(left.alias("l"), same).where("d.extra = 0 AND d.size > 0 AND d.size <= l.left")
        sizes = fits.groupBy("d.source", "d.size").agg(F.sum("d.size").alias("words"), F.first("l.left").alias("left"))
        sizes = sizes.withColumn("upto", F.sum("words").over(ahead))
        over = F.when(F.col("upto") > F.col("left"), F.col("size"))
        # One row per source: the largest size that is not taken whole, and the room that larger ones leave.
        edge = sizes.groupBy("source").agg(F.max(over).alias("edge"), (F.first("left") - F.sum(F.when(F.col("upto") <= F.col("left"), F.col("words")).otherwise(0))).alias("room"), F.max("left").alias("left"))
        edge = common.written(edge)
        if edge.isEmpty():
            return rows
        same = F.col("d.source").eqNullSafe(F.col("e.source"))
        some = rows.alias("d").join(edge.alias("e"), same).where("d.extra = 0 AND d.size > 0 AND d.size <= e.left")
        some = common.written(some.select("d.row", "d.doc_id", "d.source", "d.size", "d.digest", "e.edge", "e.room"))
        part = running(some.where("size = edge")).where("before + size <= room")
        take = some.where("edge IS NULL OR size > edge").select("row").unionByName(part.select("row")).withColumn("filled", F.lit(1))
        rows = rows.join(take, "row", "left").withColumn("extra", F.greatest("extra", F.coalesce("filled", F.lit(0)).cast("long"))).drop("filled")


def placed(rows: DataFrame, schedules: tuple = SCHEDULES) -> DataFrame:
    """One row per taken copy with its `position` in training time."""
    copy = rows.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    ahead = F.col("before")
    if "place" in rows.columns:
        ahead = F.when(F.col("copy") == F.col("copies") - 1, F.coalesce("place", "before")).otherwise(F.col("before"))
    at = F.col("copy") * F.col("source_size") + ahead + F.col("size") / 2
    u = F.when(F.col("target") > 0, F.least(F.lit(1.0), at / F.col("target"))).otherwise(0.0)
    return copy.withColumn("position", position(u, F.col("rank"), schedules))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: each taken copy as a row with the columns of `docs`, range-sorted by position."""
    names = [c for c in docs.columns if c != "position"]
    rows = placed(common.written(chosen(docs, **{"fills": None} | settings)))
    rows = rows.select(*(F.col(c).alias(f"__{c}") for c in ("doc_id", "size", "source", "copy", "position")))
    # Rows of equal id, source and size are told apart by their number, so that repeated rows are not multiplied.
    pick = Window.partitionBy("__doc_id", "__source", "__size", "__copy").orderBy("__position")
    rows = rows.withColumn("__n", F.row_number().over(pick))
    each = Window.partitionBy("doc_id", "source", "__words").orderBy(F.xxhash64("text"))
    texts = docs.select(*names).withColumn("__words", common.n_words(F.col("text"))).withColumn("__k", F.row_number().over(each))
    same = (
        F.col("doc_id").eqNullSafe(F.col("__doc_id")) & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__words") == F.col("__size")) & (F.col("__k") == F.col("__n"))
    )
    return texts.join(rows, same).select(*names, F.col("__position").alias("position")).orderBy("position", "doc_id")


def op8_mix(spark: SparkSession, folder: str) -> DataFrame:
    rows = common.written(chosen(common.table(spark, folder, "documents")))
    first = placed(rows).where("copy = 0").select("row", "position")
    return (
        rows.join(first, "row", "left")
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", F.round("position", 9).alias("position"))
        .orderBy("position", "doc_id")
    )


def _sql() -> str:
    """DuckDB form of the query; the schedule's integral is inverted piece by piece."""
    words = "len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))"
    arms = []
    for k, knots in enumerate(SCHEDULES):
        start, total = 0.0, sum((w0 + w1) / 2 * (t1 - t0) for (t0, w0), (t1, w1) in zip(knots, knots[1:]))
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            slope, end = (w1 - w0) / (t1 - t0), start + (w0 + w1) / 2 * (t1 - t0)
            need = f"(u * {total!r}::DOUBLE - {start!r}::DOUBLE)"
            root = f"({need} / {w0!r}::DOUBLE)" if slope == 0 else f"((sqrt(greatest({w0 * w0!r}::DOUBLE + {2 * slope!r}::DOUBLE * {need}, 0)) - {w0!r}::DOUBLE) / {slope!r}::DOUBLE)"
            arms.append(f"WHEN rank % {len(SCHEDULES)} = {k} AND u * {total!r}::DOUBLE <= {end!r}::DOUBLE THEN least(1.0::DOUBLE, {t0!r}::DOUBLE + {root})")
            start = end
    steps = []
    for i in range(FILLS):
        steps.append(f"""
l{i} AS (SELECT source, max(rest) - sum(size * extra) AS gap FROM e{i} GROUP BY source),
b{i} AS (SELECT source, doc_id FROM (SELECT e.source, e.doc_id, row_number() OVER (PARTITION BY e.source ORDER BY e.size DESC, e.digest DESC, e.doc_id DESC) AS n
  FROM e{i} e JOIN l{i} l ON e.source IS NOT DISTINCT FROM l.source WHERE e.extra = 0 AND e.size > 0 AND e.size <= l.gap) WHERE n = 1),
e{i + 1} AS (SELECT e.* REPLACE (CASE WHEN b.doc_id IS NOT NULL THEN 1 ELSE e.extra END AS extra) FROM e{i} e LEFT JOIN b{i} b ON e.doc_id = b.doc_id AND e.source IS NOT DISTINCT FROM b.source)""")
    return f"""
WITH d AS (SELECT doc_id, source, {words} AS size, md5(coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
s AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source)),
w AS (SELECT *, [3.0, 1.0, 2.0][(rank % 3 + 1)::INT]::DOUBLE AS weight FROM s),
lv AS (SELECT x.rank, (1.5 * (SELECT sum(source_size) FROM w) - coalesce((SELECT sum(2.0 * y.source_size) FROM w y WHERE 2.0 * y.source_size / y.weight < 2.0 * x.source_size / x.weight), 0))
  / (SELECT sum(y.weight) FROM w y WHERE 2.0 * y.source_size / y.weight >= 2.0 * x.source_size / x.weight) AS level, 2.0 * x.source_size / x.weight AS cap FROM w x),
t AS (SELECT w.*, least(2.0 * source_size, coalesce((SELECT level FROM lv WHERE abs((SELECT sum(least(2.0 * z.source_size, lv.level * z.weight)) FROM w z) - 1.5 * (SELECT sum(source_size) FROM w)) < 1e-3 ORDER BY level LIMIT 1) * weight, 2.0 * source_size))::DOUBLE AS target FROM w),
r AS (SELECT d.*, t.rank, t.source_size, t.target, coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY digest, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS base FROM r),
k2 AS (SELECT *, floor(target - base * source_size)::BIGINT AS rest FROM k),
e0 AS (SELECT *, CASE WHEN before + size <= rest THEN 1 ELSE 0 END AS extra FROM k2),{",".join(steps)},
f AS (SELECT *, base + extra AS copies, CASE WHEN target > 0 THEN least(1.0, (before + size / 2.0) / target)::DOUBLE ELSE 0.0 END AS u FROM e{FILLS})
SELECT doc_id, size::BIGINT AS size, source_size, target, (copies * size)::BIGINT AS taken, copies::BIGINT AS copies,
  CASE WHEN copies > 0 THEN round((CASE {" ".join(arms)} ELSE 1.0 END)::DOUBLE, 9) END AS position
FROM f"""


QUERIES = {"op8_mix": op8_mix}
ORACLE = {"op8_mix": _sql()}
