"""Keyed merges, fallbacks, fills and exact order statistics, all as map-side-combinable aggregates or equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators.ordered import SLICE, first_rows, running, slice_by


def filled(value: Column) -> Column:
    """Null for null and blank text."""
    return F.nullif(F.trim(value), F.lit(""))


def pick_per_key(rows: DataFrame, keys: list[str], by: Column, lowest: bool = True) -> DataFrame:
    """One whole row per key with the lowest (highest) ``by``; an aggregate, so hot keys combine on the map side."""
    rest = [c for c in rows.columns if c not in keys]
    pick = F.min_by if lowest else F.max_by
    best = rows.groupBy(*keys).agg(pick(F.struct(*rest), by).alias("_row"))
    return best.select(*keys, "_row.*")


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], version: Column) -> DataFrame:
    """Last write wins per key."""
    both = current.unionByName(changes, allowMissingColumns=True)
    return pick_per_key(both, keys, version, lowest=False)


def insert_absent(current: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Current rows plus the rows whose key is not there yet (first of several new ones is any one of them only when
    the caller leaves duplicates in; dedupe before)."""
    return current.unionByName(rows.join(current.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def outstanding(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work without a finished output."""
    return work.join(done.select(*keys), keys, "left_anti")


def fallback_lookup(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Earlier sources win, later ones fill the gaps; blank keys are dropped."""
    ranked = None
    for rank, source in enumerate(sources):
        rows = source.withColumn("source_rank", F.lit(rank))
        ranked = rows if ranked is None else ranked.unionByName(rows, allowMissingColumns=True)
    for k in keys:
        ranked = ranked.where(F.col(k).isNotNull())
    return pick_per_key(ranked, keys, F.col("source_rank"))


def fill_fields(rows: DataFrame, other: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Takes ``other``'s value only where a field is null or blank."""
    extra = other.select(*keys, *[F.col(f).alias(f"_o_{f}") for f in fields])
    out = rows.join(extra, keys, "left")
    text = {n for n, t in rows.dtypes if t == "string"}
    for f in fields:
        mine = filled(F.col(f)) if f in text else F.col(f)
        out = out.withColumn(f, F.coalesce(mine, F.col(f"_o_{f}")))
    return out.drop(*[f"_o_{f}" for f in fields])


def apply_overrides(rows: DataFrame, rules: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Per-key forced values.  ``rules``: rule_key, field, only_if array<string> (empty = always; '' = missing), value."""
    for f in fields:
        mine = rules.where(F.col("field") == f).select(
            F.col("rule_key").alias(key), F.col("only_if").alias("_if"), F.col("value").alias("_v"), F.lit(True).alias("_has")
        )
        now = F.coalesce(F.col(f).cast("string"), F.lit(""))
        hit = F.col("_has") & ((F.size("_if") == 0) | F.array_contains("_if", now))
        kind = dict(rows.dtypes)[f]
        rows = rows.join(mine, key, "left").withColumn(
            f, F.when(F.coalesce(hit, F.lit(False)), F.col("_v").cast(kind)).otherwise(F.col(f))
        ).drop("_if", "_v", "_has")
    return rows


def distinct_in_order(lines: DataFrame, text: str, position: str) -> DataFrame:
    """Each text once, at its first position."""
    return lines.groupBy(text).agg(F.min(position).alias(position))


def share_of_total(rows: DataFrame, by: str) -> DataFrame:
    """Count and share per value."""
    counts = rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(by, "n", (F.col("n") / F.greatest(F.lit(1), total)).alias("share"))


def upper_median(rows: DataFrame, keys: list[str], value: str, slice_width: float) -> DataFrame:
    """The element at index n div 2 of the sorted values per group.  Distinct values are counted first and ranked by a
    sliced running count, so a group with a third of all rows never reaches one task."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = running(slice_by(counts, value, slice_width), keys, [value], {"_upto": ("sum", F.col("_n"))})
    size = counts.groupBy(*keys).agg(F.sum("_n").alias("n"))
    return (
        upto.join(size, keys).where(F.col("_upto") > F.floor(F.col("n") / 2))
        .groupBy(*keys).agg(F.min(value).alias("upper_median"), F.min("n").alias("n"))
    )


def take_until(queue: DataFrame, position: str, valid: Column, wanted: int) -> DataFrame:
    """Queue rows in order up to the ``wanted``-th valid one; everything if there are fewer.  Two top-n plans instead of
    one global window."""
    hits = queue.where(valid).select(position).orderBy(position).limit(wanted)
    stop = hits.agg(F.when(F.count(F.lit(1)) == wanted, F.max(position)).alias("_stop"))
    return queue.where(F.col(position) <= F.coalesce(stop.scalar(), F.col(position)))


def numbered_head(rows: DataFrame, order: list, limit: int = 25) -> DataFrame:
    """First ``limit`` rows with their number."""
    return first_rows(rows.orderBy(*order).limit(limit), [], order, limit, rank="row_no")


def reconcile(expected: DataFrame, reported: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Every (key, metric) cell of either side with both values and whether they agree."""
    def long(df: DataFrame, name: str) -> DataFrame:
        cells = df.select(*keys, *[F.col(m).cast("string").alias(m) for m in metrics])
        return cells.unpivot(keys, metrics, "metric", name)

    both = long(expected, "expected").join(long(reported, "reported"), [*keys, "metric"], "full")
    return both.withColumn("matches", F.col("expected").eqNullSafe(F.col("reported")))


def positional_pairs(left: DataFrame, right: DataFrame, keys: list[str], position: str) -> DataFrame:
    """Zip by position, cut to the shorter side."""
    return left.join(right, [*keys, position])
