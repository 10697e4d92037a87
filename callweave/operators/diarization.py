"""Diarization error rate: missed, false and confused speaking time after the best one-to-one naming of speakers.

Time is integer microseconds.  All timeline work is running sums over sorted boundary events (sliced by time) and
bucketed interval joins; only the speaker-by-speaker matrix of a call, a few hundred cells at most, reaches Python.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.operators.intervals import overlapping
from callweave.operators.ordered import neighbour, running, slice_by
from callweave.session import cut_lineage

SLICE_US = 600_000_000
BUCKET_US = 300_000_000


def levels(marks: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Stretches between consecutive marks with the running totals of ``counts``.  marks: keys, t, one delta per count."""
    at = marks.groupBy(*keys, "t").agg(*[F.sum(c).alias(c) for c in counts])
    rows = slice_by(at, "t", SLICE_US)
    rows = running(rows, keys, ["t"], {f"n_{c}": ("sum", F.col(c)) for c in counts})
    rows = neighbour(rows, keys, ["t"], {"t_end": F.col("t")}, ahead=True)
    return rows.where(F.col("t_end").isNotNull()).select(*keys, F.col("t").alias("t_start"), "t_end", *[f"n_{c}" for c in counts])


def _edges(rows: DataFrame, keys: list[str], start: Column, end: Column, which: str, names: list[str]) -> DataFrame:
    """An interval as its two boundary marks; the other counts do not move."""
    delta = lambda sign: F.struct(*[F.lit(sign if n == which else 0).alias(n) for n in names])
    both = F.array(F.struct(start.alias("t"), delta(1).alias("d")), F.struct(end.alias("t"), delta(-1).alias("d")))
    return rows.select(*keys, F.inline(both)).select(*keys, "t", "d.*")


def scored_time(ref: DataFrame, hyp: DataFrame, collar_us: int) -> DataFrame:
    """The stretches of a call that count: its whole extent minus a collar centred on every reference boundary."""
    half, names = collar_us // 2, ["collar", "extent"]
    extent = ref.select("call_id", "start", "end").unionByName(hyp.select("call_id", "start", "end")).groupBy("call_id").agg(
        F.min("start").alias("start"), F.max("end").alias("end"))
    marks = _edges(extent, ["call_id"], F.col("start"), F.col("end"), "extent", names)
    if half > 0:
        for edge in ("start", "end"):
            marks = marks.unionByName(_edges(ref, ["call_id"], F.col(edge) - half, F.col(edge) + half, "collar", names))
    kept = levels(marks, ["call_id"], names).where((F.col("n_extent") > 0) & (F.col("n_collar") == 0))
    return kept.select("call_id", F.col("t_start").alias("u_start"), F.col("t_end").alias("u_end"))


def cropped(turns: DataFrame, kept: DataFrame) -> DataFrame:
    pairs = overlapping(turns.select("call_id", "start", "end", "speaker"), kept, BUCKET_US, ("start", "end", "u_start", "u_end"))
    return pairs.select("call_id", "speaker", F.greatest("start", "u_start").alias("start"), F.least("end", "u_end").alias("end"))


def best_assignment(weights: list[list[float]]) -> list[int]:
    """Column given to each row so that the total weight is largest (rows <= columns); shortest augmenting paths."""
    rows, cols = len(weights), len(weights[0])
    inf = float("inf")
    u, v, owner, way = [0.0] * (rows + 1), [0.0] * (cols + 1), [0] * (cols + 1), [0] * (cols + 1)
    for r in range(1, rows + 1):
        owner[0], j, slack, seen = r, 0, [inf] * (cols + 1), [False] * (cols + 1)
        while owner[j]:
            seen[j], i, gap, nxt = True, owner[j], inf, 0
            for c in range(1, cols + 1):
                if not seen[c]:
                    cost = -weights[i - 1][c - 1] - u[i] - v[c]
                    if cost < slack[c]:
                        slack[c], way[c] = cost, j
                    if slack[c] < gap:
                        gap, nxt = slack[c], c
            for c in range(cols + 1):
                if seen[c]:
                    u[owner[c]] += gap
                    v[c] -= gap
                else:
                    slack[c] -= gap
            j = nxt
        while j:
            owner[j], j = owner[way[j]], way[j]
    out = [0] * rows
    for c in range(1, cols + 1):
        if owner[c]:
            out[owner[c] - 1] = c - 1
    return out


def speaker_mapping(shared: DataFrame) -> DataFrame:
    """One-to-one naming with the most shared time per call.  shared: call_id, ref, hyp, us."""
    schema = f"call_id {dict(shared.dtypes)['call_id']}, ref string, hyp string"

    def solve(cells: pd.DataFrame) -> pd.DataFrame:
        grid = cells.pivot_table(index="ref", columns="hyp", values="us", aggfunc="sum", fill_value=0).sort_index().sort_index(axis=1)
        flip = grid.shape[0] > grid.shape[1]
        grid = grid.T if flip else grid
        picks = best_assignment(grid.astype(float).values.tolist())
        rows = [(grid.index[i], grid.columns[c]) for i, c in enumerate(picks) if grid.iat[i, c] > 0]
        ref, hyp = ([b for _, b in rows], [a for a, _ in rows]) if flip else ([a for a, _ in rows], [b for _, b in rows])
        return pd.DataFrame({"call_id": [cells["call_id"].iat[0]] * len(rows), "ref": ref, "hyp": hyp})

    return shared.groupBy("call_id").applyInPandas(solve, schema)


def error_rate(ref: DataFrame, hyp: DataFrame, collar_sec: float = 0.25) -> DataFrame:
    """Per call: reference time, missed, false alarm, confusion (seconds) and the rate.  Both: call_id, start, end
    (microseconds), speaker.  Turns without length are ignored."""
    # The timelines are read by several branches below: each is computed once and cut from its history.
    ref, hyp = (cut_lineage(df.where(F.col("end") > F.col("start"))) for df in (ref, hyp))
    kept = cut_lineage(scored_time(ref, hyp, int(round(collar_sec * 1_000_000))))
    r, h = cut_lineage(cropped(ref, kept)), cut_lineage(cropped(hyp, kept))
    names, edge = ["r", "h"], (F.col("start"), F.col("end"))
    active = levels(_edges(r, ["call_id"], *edge, "r", names).unionByName(_edges(h, ["call_id"], *edge, "h", names)), ["call_id"], names)
    span = F.col("t_end") - F.col("t_start")
    both = F.least("n_r", "n_h")
    totals = active.groupBy("call_id").agg(
        F.sum(span * F.col("n_r")).alias("total_us"),
        F.sum(span * F.greatest(F.col("n_r") - F.col("n_h"), F.lit(0))).alias("missed_us"),
        F.sum(span * F.greatest(F.col("n_h") - F.col("n_r"), F.lit(0))).alias("false_us"),
        F.sum(span * both).alias("_matched"))
    other = h.select("call_id", F.col("start").alias("h_start"), F.col("end").alias("h_end"), F.col("speaker").alias("hyp"))
    shared = overlapping(r.withColumnRenamed("speaker", "ref"), other, BUCKET_US, ("start", "end", "h_start", "h_end"))
    shared = shared.groupBy("call_id", "ref", "hyp").agg(F.sum(F.least("end", "h_end") - F.greatest("start", "h_start")).alias("us"))
    mapping = cut_lineage(speaker_mapping(shared))
    pair = ["call_id", "ref"]
    named = _edges(r.withColumnRenamed("speaker", "ref").join(mapping.select(*pair), pair), pair, *edge, "r", names).unionByName(
        _edges(h.withColumnRenamed("speaker", "hyp").join(mapping, ["call_id", "hyp"]), pair, *edge, "h", names))
    right = levels(named, pair, names).groupBy("call_id").agg(F.sum(span * both).alias("_right"))
    sec = lambda c: F.coalesce(c, F.lit(0)) / F.lit(1_000_000.0)
    out = totals.join(right, "call_id", "left").select(
        "call_id", sec(F.col("total_us")).alias("total_sec"), sec(F.col("missed_us")).alias("missed_sec"), sec(F.col("false_us")).alias("false_alarm_sec"),
        sec(F.col("_matched") - F.coalesce("_right", F.lit(0))).alias("confusion_sec"))
    wrong = F.col("missed_sec") + F.col("false_alarm_sec") + F.col("confusion_sec")
    return out.withColumn("der", F.when(F.col("total_sec") > 0, wrong / F.col("total_sec")).otherwise(F.when(wrong > 0, 1.0).otherwise(0.0)))


def reference_turns(matched: DataFrame, max_gap: float = 1.0) -> DataFrame:
    """Reference speaking turns from aligned words: consecutive words of one reference speaker closer than ``max_gap``.
    matched: call_id, i (reference position), ref_name, start, end (seconds)."""
    from callweave.operators.segments import speaker_runs

    rows = matched.select("call_id", F.col("i").alias("idx"), F.col("ref_name").alias("speaker_id"), "start", "end")
    us = lambda c: F.round(F.col(c) * 1_000_000).cast("long")
    return speaker_runs(rows, max_gap=max_gap).select("call_id", us("start").alias("start"), us("end").alias("end"), F.col("speaker_id").alias("speaker"))
