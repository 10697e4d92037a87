"""Longest-matching-block alignment of two token sequences (the diff people read), one pair per row in Arrow batches.

The longest common run is taken first (ties: earliest in the reference, then in the hypothesis), then both sides of it
are aligned the same way.  This is not a longest common subsequence."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions.editdist import encode_pair


def longest_run(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    """(start in a, start in b, length) of the first longest common run."""
    best = (0, 0, 0)
    ends = np.zeros(len(b) + 1, dtype=np.int64)
    for i, token in enumerate(a):
        here = np.where(b == token, ends[:-1] + 1, 0)
        j = int(here.argmax())
        size = int(here[j])
        if size > best[2]:
            best = (i - size + 1, j - size + 1, size)
        ends[1:] = here
    return best


def matching_blocks(ref: list, hyp: list) -> list[tuple[int, int, int]]:
    """Maximal equal runs in order, touching ones merged."""
    a, b = encode_pair(ref, hyp)
    todo, found = [(0, len(a), 0, len(b))], []
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if a0 == a1 or b0 == b1:
            continue
        i, j, k = longest_run(a[a0:a1], b[b0:b1])
        if k:
            i, j = i + a0, j + b0
            found.append((i, j, k))
            todo += [(a0, i, b0, j), (i + k, a1, j + k, b1)]
    merged: list[tuple[int, int, int]] = []
    for i, j, k in sorted(found):
        if merged and merged[-1][0] + merged[-1][2] == i and merged[-1][1] + merged[-1][2] == j:
            merged[-1] = (merged[-1][0], merged[-1][1], merged[-1][2] + k)
        else:
            merged.append((i, j, k))
    return merged


def edit_script(blocks: list[tuple[int, int, int]], n: int, m: int) -> list[tuple[str, int, int, int, int]]:
    """Equal runs and the changes between them."""
    script, i, j = [], 0, 0
    for bi, bj, k in [*blocks, (n, m, 0)]:
        if i < bi or j < bj:
            tag = "replace" if i < bi and j < bj else "delete" if i < bi else "insert"
            script.append((tag, i, bi, j, bj))
        if k:
            script.append(("equal", bi, bi + k, bj, bj + k))
        i, j = bi + k, bj + k
    return script


SCRIPT = T.ArrayType(T.StructType(
    [T.StructField("tag", T.StringType()), *[T.StructField(n, T.IntegerType()) for n in ("i1", "i2", "j1", "j2")]]))


@F.pandas_udf(SCRIPT)
def _scripts(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    def one(r, h):
        r, h = list(r), list(h)
        return [dict(zip(("tag", "i1", "i2", "j1", "j2"), op)) for op in edit_script(matching_blocks(r, h), len(r), len(h))]

    return pd.Series([one(r, h) for r, h in zip(ref, hyp)])


def align(ref: Column, hyp: Column) -> Column:
    """Edit script of two word arrays as an array of (tag, i1, i2, j1, j2)."""
    return _scripts(ref, hyp)
