"""Edit distances of many pairs of texts side by side.

Bit vectors of 64 characters (Myers 1999, blocks as Hyyro 2003) of all pairs of a batch, and of all blocks on a falling diagonal, go through one
numpy call. Only the blocks in reach of the largest limit are filled (Ukkonen 1985); pairs whose distance must exceed their limit leave early.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Numbers that a batch's match vectors may hold, pairs of a batch, and pairs below which an array call costs more than what it does.
VECTORS, MOST, FEW = 1 << 22, 4096, 24
#: Share of a limit that is tried first: pairs that differ little need few blocks.
FIRST = 6
ONE, ALL, TOP = np.uint64(1), np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(63)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points, and where each text begins (one more entry than texts)."""
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat, np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])


def _columns(flat: np.ndarray, start: np.ndarray, size: np.ndarray, none: int) -> np.ndarray:
    """One column a text, padded with `none`."""
    out = np.full((len(size), int(size.max())), none, flat.dtype)
    inside = np.arange(out.shape[1]) < size[:, None]
    ends = np.cumsum(size)
    out[inside] = flat[np.repeat(start - ends + size, size) + np.arange(ends[-1])]
    return np.ascontiguousarray(out.T)


def within(a: list[str], b: list[str], limits: np.ndarray, one: Callable[[str, str, int], bool]) -> np.ndarray:
    """For each pair whether its edit distance is its limit at most. `one` decides a single pair, where too few are alike in length to fill an array."""
    limits = np.asarray(limits, np.int64)
    (x, at), (y, to) = code_points(a), code_points(b)
    n, m = np.diff(at), np.diff(to)
    # The longer text is the pattern.
    swap = n < m
    flat, begin, other = np.concatenate([x, y]), np.where(swap, to[:-1] + len(x), at[:-1]), np.where(swap, at[:-1], to[:-1] + len(x))
    n, m = np.maximum(n, m), np.minimum(n, m)
    out = n <= limits
    todo = np.flatnonzero((n > limits) & (n - m <= limits) & (m > 0))
    if not len(todo):
        return out
    # Letters as small numbers.
    seen = np.zeros(int(flat.max()) + 1, np.int32)
    seen[flat] = 1
    letters = int(seen.sum())
    seen[seen > 0] = np.arange(letters)
    flat = seen[flat]
    todo = todo[np.argsort(n[todo], kind="stable")]
    for part in (FIRST, 1):
        tried, first = limits // part, 0
        if part > 1:
            later, todo = todo, todo[n[todo] - m[todo] <= tried[todo]]
        while first < len(todo):
            # A batch: pairs up to a quarter longer than its first, as many as its match vectors leave room for.
            last = min(int(np.searchsorted(n[todo], n[todo[first]] * 5 // 4 + 32, "right")), first + MOST)
            last = max(first + 1, min(last, first + VECTORS // ((letters + 1) * (int(n[todo[last - 1]]) // 64 + 1))))
            own = todo[first:last]
            first = last
            if len(own) >= FEW:
                own = own[np.argsort(-(m[own] + (n[own] - 1 >> 6)), kind="stable")]
                columns = (_columns(flat, start[own], size[own], letters) for start, size in ((begin, n), (other, m)))
                out[own], left = _batch(*columns, n[own], m[own], tried[own], letters)
                own = own[left]
            if part == 1:
                out[own] = [one(a[k], b[k], int(limits[k])) for k in own]
        if part > 1:
            todo = later[~out[later]]
    return out


def _batch(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, limits: np.ndarray, letters: int) -> tuple[np.ndarray, np.ndarray]:
    """`within` for columns of letters, and the pairs left undecided when they were too few for arrays. At time s block w of 64 rows is at column
    s - w; pairs stand in order of falling times at which their last block is at their last column."""
    pairs, columns = len(n), len(b)
    blocks, width = (len(a) + 63) // 64, letters + 1
    # A path within the limit keeps so near to the diagonal of equal places, rows behind and ahead.
    behind, ahead = int((limits - (n - m)).max()) // 2, int((limits + n - m).max()) // 2
    base = np.arange(pairs) * width
    match = np.zeros((blocks, pairs * width), np.uint64)
    for i in range(len(a)):
        match[i >> 6][base + a[i]] |= ONE << np.uint64(i & 63)
    match, size = match.ravel(), pairs * width
    row = np.arange(blocks)[:, None] * size
    up, down = np.full((blocks, pairs), ALL), np.zeros((blocks, pairs), np.uint64)
    # What comes in from the block above at the next time: a step up, a step down.
    plus, minus = np.ones((blocks + 1, pairs), np.uint64), np.zeros((blocks + 1, pairs), np.uint64)
    score = np.full((blocks, pairs), 64)
    last = n - 1 >> 6
    ends = m + last
    out, number = np.zeros(pairs, bool), np.arange(pairs)
    live, s, top, gone = pairs, 0, 0, 0

    def value(block: np.ndarray, own: np.ndarray, rest: np.ndarray) -> np.ndarray:
        """Of pairs `own`, at row `rest` of a block: the value at its end, less the steps below that row."""
        beyond = np.where(rest == 63, np.uint64(0), ALL << (rest + 1).astype(np.uint64) % np.uint64(64))
        steps = [np.bitwise_count(x[block, own] & beyond).astype(np.int64) for x in (up, down)]
        return score[block, own] - steps[0] + steps[1]

    while live >= FEW // 2:
        s += 1
        low = max(0, s - columns, -(-(s - 64 - behind) // 65))
        high = min(blocks, s, (s + ahead - 1) // 65 + 1)
        for w in range(top, high):
            if w:
                score[w, :live] = score[w - 1, :live] - plus[w, :live].view(np.int64) + minus[w, :live].view(np.int64) + 64
        top = max(top, high)
        u, d, hp, hn = (x[low:high, :live] for x in (up, down, plus, minus))
        e = match.take(base[:live] + b[s - high - gone : s - low - gone, :live][::-1] + row[low:high])
        f = e | d
        e |= hn
        c = e & u
        c += u
        c ^= u
        c |= e
        r = c | u
        np.invert(r, out=r)
        r |= d
        c &= u
        more, less = r >> TOP, c >> TOP
        score[low:high, :live] += (more - less).view(np.int64)
        r <<= ONE
        r |= hp
        c <<= ONE
        c |= hn
        np.bitwise_and(r, f, out=d)
        r |= f
        np.invert(r, out=r)
        np.bitwise_or(c, r, out=u)
        plus[low + 1 : high + 1, :live], minus[low + 1 : high + 1, :live] = more, less
        plus[low, :live], minus[low, :live] = 1, 0
        # Pairs at their end.
        ended = live
        while ended and ends[ended - 1] == s:
            ended -= 1
        if ended < live:
            own = np.arange(ended, live)
            out[number[own]] = value(last[own], own, n[own] - 1 & 63) <= limits[own]
            live = ended
        # On the diagonal of the two ends values never fall: one over the limit tells that the last one is.
        if s % 32 == 0 and live:
            own = np.arange(live)
            block, rest = np.divmod(s + n[own] - m[own] - 1, 65)
            known = (block >= low) & (block < high) & (rest < 64)
            block[~known], rest[~known] = low, 0
            stay = ~known | (value(block, own, rest) <= limits[own])
            kept = int(np.count_nonzero(stay))
            if kept < live * 0.7:
                stay = np.flatnonzero(stay)
                # Columns that all blocks have behind them go too.
                b, gone = b[s - high - gone :], s - high
                up, down, plus, minus, score, b = (x.take(stay, axis=1) for x in (up, down, plus, minus, score, b))
                base, n, m, limits, number, last, ends = (x[stay] for x in (base, n, m, limits, number, last, ends))
                live = kept
    return out, number[:live]


# --- distances by furthest places ---------------------------------------------------------------------------------

#: Most edits, tokens and furthest places of a batch; microseconds of a place.
EDITS, TOKENS, PLACES, PLACE_US = 400, 1 << 20, 1 << 21, 0.06


def _run(a, b, i: int, j: int) -> int:
    """Length of the common run of ``a`` from i and ``b`` from j: doubling, then halving steps."""
    start, step = i, 16
    while i + step <= len(a) and j + step <= len(b) and a[i : i + step] == b[j : j + step]:
        i, j, step = i + step, j + step, step * 2
    while step > 1:
        step >>= 1
        if i + step <= len(a) and j + step <= len(b) and a[i : i + step] == b[j : j + step]:
            i, j = i + step, j + step
    return i - start


def _tokens(texts: list) -> list[np.ndarray]:
    """Texts (or lists of words) as small numbers from 0."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    if isinstance(texts[0], str):
        flat = code_points(texts)[0]
        seen = np.zeros(int(flat.max(initial=0)) + 1, np.uint32)
        seen[flat] = 1
        number = np.cumsum(seen, dtype=np.uint32) - np.uint32(1)
        flat = number[flat]
    else:
        ids: dict = {}
        flat = np.fromiter((ids.setdefault(w, len(ids)) for t in texts for w in t), np.uint32, int(sizes.sum()))
    return np.split(flat, np.cumsum(sizes)[:-1])


def distances(a: list, b: list, budget: Callable[[int, int], float]) -> list[int | None]:
    """Edit distance of each pair of texts (or lists of words), by how far 0, 1, 2, ... edits reach along each diagonal (Ukkonen 1985) of all pairs
    at once. None where that would take more than `budget` of the lengths, in microseconds, or more than EDITS edits."""
    out: list[int | None] = [None] * len(a)
    if not a:
        return out
    most = np.array([min(EDITS, int((budget(len(x), len(y)) / PLACE_US) ** 0.5)) for x, y in zip(a, b)])
    todo = [int(k) for k in np.argsort(most, kind="stable") if abs(len(a[k]) - len(b[k])) <= most[k]]
    while todo:
        own, tokens = [], 0
        while todo and tokens < TOKENS and (len(own) + 1) * (2 * most[todo[-1]] + 3) < PLACES * (1 if own else 8):
            own.append(todo.pop())
            tokens += len(a[own[-1]]) + len(b[own[-1]])
        for k, d in zip(own, _furthest([a[k] for k in own], [b[k] for k in own], most[own])):
            out[k] = None if d < 0 else int(d)
    return out


def _furthest(a: list, b: list, most: np.ndarray) -> np.ndarray:
    """Edit distances, -1 where they are above `most`."""
    heads = [_run(x, y, 0, 0) for x, y in zip(a, b)]
    a, b = ([x[k:] for x, k in zip(side, heads)] for side in (a, b))
    tails = [_run(x[::-1], y[::-1], 0, 0) for x, y in zip(a, b)]
    a, b = ([x[: len(x) - k] for x, k in zip(side, tails)] for side in (a, b))
    every = _tokens(a + b)
    top = max(int(x.max(initial=0)) for x in every)
    kind = np.uint8 if top < 254 else np.uint32
    # Ends that match nothing, in `a` and in `b`.
    stops = [np.full(1, np.iinfo(kind).max - k, kind) for k in (0, 1)]
    eights, begins, raw = [], [], []
    for side, stop in zip((every[: len(a)], every[len(a) :]), stops):
        flat = np.concatenate([x for t in side for x in (t.astype(kind), stop)] + [np.zeros(8, kind)])
        begins.append(np.cumsum([0] + [len(t) + 1 for t in side])[:-1])
        raw.append(flat.tobytes())
        eights.append(np.ascontiguousarray(np.ndarray((len(flat) - 8,), "<u8", raw[-1], strides=(flat.itemsize,))))
    wide = np.dtype(kind).itemsize
    n, m = (np.fromiter(map(len, side), np.int32, len(side)) for side in (a, b))
    out, number, zero = np.full(len(a), -1), np.arange(len(a)), int(most.max()) + 2
    far = np.full((len(a), 2 * zero + 1), -(1 << 30), np.int32)
    far[:, zero], e = 0, 0
    while True:
        low, high = zero - e, zero + e + 1
        reached, diagonal = far[:, low:high], np.arange(-e, e + 1, dtype=np.int32)
        limit = np.minimum(n[:, None], m[:, None] + diagonal)
        np.minimum(reached, limit, out=reached)
        # How far the tokens are equal from each place on, eight bytes at a time.
        row, at = np.nonzero((reached >= 0) & (reached < limit) & (reached >= diagonal))
        i = reached[row, at]
        x, y = begins[0][row] + i, begins[1][row] + i - diagonal[at]
        while len(row) > 12:
            differ = eights[0][x] ^ eights[1][y]
            # The lowest bit that differs tells the first byte that does: the exponent of its float.
            same = ((differ & -differ).astype(np.float64).view(np.int64) >> 52) - 1023 >> 3
            on = differ == 0
            same[on] = 8
            same //= wide
            reached[row, at] += same
            on = np.flatnonzero(on)
            row, at, x, y = row[on], at[on], x[on] + 8 // wide, y[on] + 8 // wide
        for p, k, i, j in zip(row.tolist(), at.tolist(), x.tolist(), y.tolist()):
            reached[p, k] += _run(*raw, i * wide, j * wide) // wide
        done = far[np.arange(len(number)), n - m + zero] >= n
        out[number[done & (out[number] < 0)]] = e
        e += 1
        stay = ~done & (most >= e)
        kept = int(np.count_nonzero(stay))
        if not kept:
            break
        if kept < 0.85 * len(number):
            far, number, n, m, most = far[stay], number[stay], n[stay], m[stay], most[stay]
            begins = [x[stay] for x in begins]
        low, high = zero - e, zero + e + 1
        # A deletion and a substitution go one place on, an insertion stays there.
        step = np.maximum(far[:, low - 1 : high - 1], far[:, low:high]) + 1
        far[:, low:high] = np.maximum(step, far[:, low + 1 : high + 1])
    return out
