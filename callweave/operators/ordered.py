"""Order-dependent column operators that never put one whole group into one task.

``Window.partitionBy(call)`` sends every row of a call to a single task, so one call holding a third of the table
would be one task's work.  These helpers cut each group into slices of consecutive rows (``slice`` is a column that
does not decrease with the order), run the window per (group, slice), summarise every slice to ONE row with a
map-side-combined aggregate, run the group-level window over the summaries only, and join them back on
(group, slice).  Results equal those of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICE = "_slice"
SLICE_ROWS = 4096


def slice_by(df: DataFrame, position: str, width: float = SLICE_ROWS) -> DataFrame:
    """Adds the slice number of a row from its position (row index, seconds, ...)."""
    return df.withColumn(SLICE, F.floor(F.col(position) / F.lit(width)).cast("long"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows spread by key over all shuffle partitions, ahead of work whose cost is the text, not the bytes.  The fixed
    partition count keeps the runtime planner from folding small inputs into one task; it differs from that of other
exchanges, as one by the same keys and count just before (of a grouping) would stand in for it and be folded."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
    return df.repartition(n, *keys)


def neighbour(df: DataFrame, keys: list[str], order: list[str], take: dict[str, Column], ahead: bool) -> DataFrame:
    """Adds the ``take`` expressions of the next (``ahead``) or previous row of the same group; null at the rim."""
    packed = F.struct(*[expr.alias(name) for name, expr in take.items()])
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    across = Window.partitionBy(*keys).orderBy(SLICE)
    shift, rim = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    rims = (
        df.groupBy(*keys, SLICE)
        .agg(rim(packed, F.struct(*order)).alias("_rim"))
        .select(*keys, SLICE, shift("_rim").over(across).alias("_rim"))
    )
    near = F.coalesce(F.col("_near"), F.col("_rim"))
    return (
        df.withColumn("_near", shift(packed).over(inside))
        .join(rims, [*keys, SLICE], "left")
        .select(*[df[c] for c in df.columns], *[near[name].alias(name) for name in take])
    )


_MERGE = {
    "sum": lambda before, here: F.coalesce(before, F.lit(0)) + here,
    "max": F.greatest,
    "min": F.least,
}
_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def running(df: DataFrame, keys: list[str], order: list[str], take: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds inclusive running aggregates: ``take`` maps a new name to ("sum" | "max" | "min", expression)."""
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, SLICE).agg(*[_AGG[how](expr).alias(f"_b_{n}") for n, (how, expr) in take.items()])
    totals = totals.select(
        *keys, SLICE, *[_AGG[how](f"_b_{n}").over(earlier).alias(f"_b_{n}") for n, (how, _) in take.items()]
    )
    local = df.select("*", *[_AGG[how](expr).over(inside).alias(f"_h_{n}") for n, (how, expr) in take.items()])
    return local.join(totals, [*keys, SLICE], "left").select(
        *[local[c] for c in df.columns],
        *[_MERGE[how](F.col(f"_b_{n}"), F.col(f"_h_{n}")).alias(n) for n, (how, _) in take.items()],
    )


def first_rows(df: DataFrame, keys: list[str], order: list, limit: int, rank: str = "rank") -> DataFrame:
    """First ``limit`` rows per group.  Catalyst plans a group limit before the shuffle, so a hot group ships at most
    ``limit`` rows per map task."""
    window = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= limit)
