"""Edit distances between token sequences.

Pairs go in Arrow batches, one pair per row. Pairs that differ little are measured by their differences, others by a bit-vector pass; hit and
substitution counts, which a distance cannot give, run a banded dynamic programme there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions.manypairs import _run, distances as many_distances


def bind(value: Column, body) -> Column:
    """Evaluates ``value`` once and hands it to ``body``; without this a lambda re-evaluates it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def encode_pair(ref: list, hyp: list) -> tuple[np.ndarray, np.ndarray]:
    ids: dict = {}
    code = lambda seq: np.fromiter((ids.setdefault(t, len(ids)) for t in seq), dtype=np.int64, count=len(seq))
    return code(ref), code(hyp)


def edit_counts(ref: list, hyp: list) -> tuple[int, int]:
    """(distance, hits): the fewest edits and, among those alignments, the most matched tokens.

    One cost orders both: an edit costs ``unit``, a match -1.  Only a band around the diagonal is filled; it widens
    until the distance fits inside, which makes the result exact."""
    a, b = encode_pair(ref, hyp)
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if differs.size else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[::-1][:short] != b[::-1][:short])
    tail = int(differs[0]) if differs.size else short
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m), head + tail
    unit = n + m + 1
    band = max(256, abs(n - m))
    while True:
        cost = _banded(a, b, unit, band)
        distance = -(-cost // unit)
        if distance <= band or band >= max(n, m):
            return distance, head + tail + distance * unit - cost
        band *= 4


def _banded(a: np.ndarray, b: np.ndarray, unit: int, band: int) -> int:
    n, m = len(a), len(b)
    far = unit * (n + m + 2)
    row = np.full(m + 1, far, dtype=np.int64)
    lo, hi = 0, min(m, band)
    row[: hi + 1] = np.arange(hi + 1) * unit
    steps = np.arange(m + 1, dtype=np.int64) * unit
    for i in range(1, n + 1):
        lo, hi = max(0, i - band), min(m, i + band)
        cur = row[lo : hi + 1] + unit
        left = max(lo, 1)
        diagonal = row[left - 1 : hi] + np.where(b[left - 1 : hi] == a[i - 1], -1, unit)
        np.minimum(cur[left - lo :], diagonal, out=cur[left - lo :])
        ramp = steps[lo : hi + 1]
        row[lo : hi + 1] = np.minimum.accumulate(cur - ramp) + ramp
        if lo:
            row[lo - 1] = far
    return int(row[m])


def _numbers(ref, hyp) -> tuple[np.ndarray, np.ndarray]:
    """Both sequences as small numbers from 0 (texts: code points, squeezed where that saves bytes)."""
    if not isinstance(ref, str):
        return encode_pair(ref, hyp)
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in (ref, hyp))
    if max(a.max(), b.max()) > 255:
        both = np.unique(np.concatenate([a, b]), return_inverse=True)[1]
        a, b = both[: len(a)], both[len(a) :]
    return a, b


def _eights(seq: np.ndarray) -> np.ndarray:
    """The eight bytes that start at every place of a sequence, as one number; zeros behind the end."""
    padded = seq.tobytes() + bytes(8)
    return np.ascontiguousarray(np.ndarray((len(seq) + 1,), dtype="<u8", buffer=padded, strides=(seq.itemsize,)))


#: Measured microseconds of a wave, of a square of its number, of a bit-vector step and of a bit in it.
WAVE_US, CELL_US, STEP_US, BIT_US = 45.0, 0.025, 0.8, 0.0006


def _waves(ref, hyp, budget: float) -> int | None:
    """Edit distance by furthest places: how far 0, 1, 2, ... edits reach along each diagonal (Ukkonen 1985, Myers 1986). The work grows with the
    square of the distance, not with the lengths; None where by its progress it would take more than some ``budget`` microseconds."""
    a, b = _numbers(ref, hyp)
    n, m = len(a), len(b)
    narrow = np.uint8 if max(a.max(), b.max()) < 256 else np.uint32
    at_a, at_b = np.append(a.astype(np.int32), np.int32(-1)), np.append(b.astype(np.int32), np.int32(-2))
    a, b = a.astype(narrow), b.astype(narrow)
    near_a, near_b, bytes_a, bytes_b, size = _eights(a), _eights(b), a.tobytes(), b.tobytes(), a.itemsize
    # Diagonal k = i - j is at k + zero. A place behind an end is no further than that end.
    zero = m + 1
    diagonals = np.arange(-zero, n + 2)
    ends = np.minimum(n, m + diagonals)
    far = np.full(n + m + 3, -2)
    far[zero] = 0
    goal, low, high, edits = n - m + zero, zero, zero, 0
    while True:
        reached, ks, limit = far[low : high + 1], diagonals[low : high + 1], ends[low : high + 1]
        todo = (at_a.take(reached) == at_b.take(reached - ks)).nonzero()[0]
        if todo.size > 10:
            i, end = reached.take(todo), limit.take(todo)
            differ = near_a.take(i) ^ near_b.take(i - ks.take(todo))
            # The lowest bit that differs tells the first byte that does: the exponent of its float, 0 where none differs.
            ahead = ((differ & -differ).astype(np.float64).view(np.int64) >> 52) - 1023 >> 3
            same = ahead < 0
            ahead[same] = 8
            moved = np.minimum(i + (ahead if size == 1 else ahead // size), end)
            reached[todo] = moved
            todo = todo[same & (moved < end)]
        for d in todo.tolist():
            i, k = int(reached[d]), int(ks[d])
            reached[d] = i + _run(bytes_a, bytes_b, i * size, (i - k) * size) // size
        if far[goal] == n:
            return edits
        edits += 1
        if edits % 16 == 0:
            whole = edits * (n + m) / max(1, int((2 * reached - ks).max()))
            if WAVE_US * whole + CELL_US * whole * whole > budget:
                return None
        low, high = max(low - 1, 1), min(high + 1, n + zero)
        step = np.maximum(far[low - 1 : high], far[low : high + 1])
        step += 1
        np.maximum(step, far[low + 1 : high + 2], out=step)
        np.minimum(step, ends[low : high + 1], out=far[low : high + 1])


def pass_us(ref: int, hyp: int) -> float:
    """Microseconds of a bit-vector pass over texts of these lengths."""
    return hyp * (STEP_US + BIT_US * ref)


def edit_distances(refs: list, hyps: list) -> list[int]:
    """Edit distances of many pairs: together where they differ little, else one by one."""
    found = many_distances(refs, hyps, pass_us)
    return [edit_distance(r, h) if d is None else d for r, h, d in zip(refs, hyps, found)]


def edit_distance(ref, hyp) -> int:
    """Edit distance alone: by furthest places while that is less work than one pass of bit vectors, else by these."""
    ref, hyp = (x if isinstance(x, str) else list(x) for x in (ref, hyp))
    head = _run(ref, hyp, 0, 0)
    ref, hyp = ref[head:], hyp[head:]
    tail = _run(ref[::-1], hyp[::-1], 0, 0)
    ref, hyp = ref[: len(ref) - tail], hyp[: len(hyp) - tail]
    if not ref or not hyp:
        return max(len(ref), len(hyp))
    budget = pass_us(len(ref), len(hyp))
    found = _waves(ref, hyp, budget) if budget > 400 and WAVE_US * abs(len(ref) - len(hyp)) < budget else None
    return _bit_vectors(ref, hyp) if found is None else found


def _bit_vectors(ref, hyp) -> int:
    """Edit distance by bit vectors over the reference (Myers 1999, Hyyro 2003): one pass over the hypothesis with whole-column integer
    operations."""
    spots: dict = {}
    for i, token in enumerate(ref):
        spots.setdefault(token, []).append(i)
    size = len(ref) // 8 + 1
    match = {}
    for token, where in spots.items():
        bits = bytearray(size)
        for i in where:
            bits[i >> 3] |= 1 << (i & 7)
        match[token] = int.from_bytes(bits, "little")
    full, top = (1 << len(ref)) - 1, 1 << (len(ref) - 1)
    up, down, score = full, 0, len(ref)
    for token in hyp:
        eq = match.get(token, 0)
        flat = eq | down
        cross = (((eq & up) + up) ^ up) | eq
        rise = down | (full & ~(cross | up))
        fall = up & cross
        score += 1 if rise & top else -1 if fall & top else 0
        rise = ((rise << 1) | 1) & full
        up = ((fall << 1) & full) | (full & ~(flat | rise))
        down = rise & flat
    return score


@F.pandas_udf(T.LongType())
def _distance(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    return pd.Series([None if r is None or h is None else edit_distance(r, h) for r, h in zip(ref, hyp)], dtype="Int64")


TEXTS = T.StructType([T.StructField(n, T.LongType()) for n in ("words", "ref_words", "hyp_words", "chars", "ref_chars", "hyp_chars")])


def _text_distances(words: bool, chars: bool):
    @F.pandas_udf(TEXTS)
    def distances(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
        at = [k for k, (r, h) in enumerate(zip(ref, hyp)) if r is not None and h is not None]
        r, h = ([side[k] for k in at] for side in (ref.tolist(), hyp.tolist()))
        a, b = ([t.split(" ") if t else [] for t in side] for side in (r, h))
        none = [None] * len(at)
        columns = [edit_distances(a, b) if words else none, map(len, a), map(len, b), edit_distances(r, h) if chars else none, map(len, r), map(len, h)]
        out = [(None,) * 6] * len(ref)
        for k, row in zip(at, zip(*columns)):
            out[k] = row
        return pd.DataFrame(out, columns=TEXTS.names).astype("Int64")

    return distances


def text_distances(ref: Column, hyp: Column, words: bool = True, chars: bool = True) -> Column:
    """Word and character distances and lengths of two texts of single-spaced words, as a struct: each text is made and sent once for all of them."""
    return _text_distances(words, chars)(ref, hyp)


def rates(distances: Column) -> tuple[Column, Column]:
    """(word error rate, character error rate) of ``text_distances``; pass a materialised column."""
    return tuple(error_rate(distances[n], distances[f"ref_{n}"], distances[f"hyp_{n}"]) for n in ("words", "chars"))


COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("distance", "hits", "ref_len", "hyp_len")])


@F.pandas_udf(COUNTS)
def _pair_counts(ref: pd.Series, hyp: pd.Series) -> pd.DataFrame:
    out = []
    for r, h in zip(ref, hyp):
        if r is None or h is None:
            out.append((None, None, None, None))
        else:
            out.append((*edit_counts(list(r), list(h)), len(r), len(h)))
    return pd.DataFrame(out, columns=["distance", "hits", "ref_len", "hyp_len"]).astype("Int64")


def edit_breakdown(ref: Column, hyp: Column) -> Column:
    """Struct of hits, substitutions, deletions, insertions, distance for two word arrays.  The split of a given distance
    is not unique; the one with the most hits is taken."""
    c = _pair_counts(ref, hyp)
    ins = c["distance"] - c["ref_len"] + c["hits"]
    dels = ins + c["ref_len"] - c["hyp_len"]
    return F.struct(
        c["hits"].alias("hits"), (c["ref_len"] - c["hits"] - dels).alias("substitutions"), dels.alias("deletions"),
        ins.alias("insertions"), c["distance"].alias("distance"), c["ref_len"].alias("ref_words"), c["hyp_len"].alias("hyp_words"),
    )


def word_distance(ref: Column, hyp: Column) -> Column:
    """Word-level edit distance of two word arrays."""
    return _distance(ref, hyp)


def char_distance(ref: Column, hyp: Column) -> Column:
    """Character-level edit distance of two texts."""
    return _distance(ref, hyp)


def error_rate(distance: Column, ref_len: Column, hyp_len: Column) -> Column:
    """Distance per reference token; an empty reference scores 0 against nothing and 1 against anything."""
    return F.when(ref_len == 0, F.when(hyp_len == 0, 0.0).otherwise(1.0)).otherwise(distance / ref_len)


def word_error_rate(ref: Column, hyp: Column) -> Column:
    return error_rate(word_distance(ref, hyp), F.size(ref), F.size(hyp))


def char_error_rate(ref: Column, hyp: Column) -> Column:
    return error_rate(char_distance(ref, hyp), F.length(ref), F.length(hyp))
