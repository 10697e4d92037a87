"""Progressive JPEG in numpy: scans of many files are coded in lockstep, one lane per restart interval.

The decoder takes any Huffman-coded progressive file of 8-bit samples with one or three components: it accumulates spectral-selection and
successive-approximation scans into coefficient arrays. Files of one structure (tables, scan script, sampling) are decoded together. The encoder
writes coefficient arrays with a fixed scan script, 4:2:0 sampling, and a restart interval of one unit so that lanes are short.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np


def zigzag() -> np.ndarray:
    """Raster index of each place of the zigzag order."""
    cells = sorted(((x, y) for x in range(8) for y in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * r + c for r, c in cells])


ZIGZAG = zigzag()
#: Scans the encoder writes: components, first and last place, bit position before and of the scan.
SCRIPT = (
    ((0, 1, 2), 0, 0, 0, 1),
    *(((c,), lo, hi, 0, 1) for lo, hi in ((1, 8), (9, 63)) for c in range(3)),
    ((0, 1, 2), 0, 0, 1, 0),
    *(((c,), 1, 63, 1, 0) for c in range(3)),
)
SAMPLING = ((2, 2), (1, 1), (1, 1))
#: Code lengths by symbol: 4 bits for what is frequent here, 12 bits for the rest.
DC_LENGTHS = {s: 4 for s in range(12)}
AC_LENGTHS = {**{s: 4 for s in range(9)}, **{r << 4 | s: 12 for r in range(16) for s in range(1, 11) if r or s > 8}, 0xF0: 12}


def table_bytes(lengths: dict[int, int]) -> bytes:
    """Counts by length and the symbols in code order, as a DHT segment has them."""
    order = sorted(lengths, key=lambda s: (lengths[s], s))
    return bytes(sum(n == k for n in lengths.values()) for k in range(1, 17)) + bytes(order)


def codes(spec: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Canonical code and length of each symbol."""
    code, value, at = np.zeros(256, np.uint64), 0, 16
    length = np.zeros(256, np.int64)
    for n in range(1, 17):
        for _ in range(spec[n - 1]):
            code[spec[at]], length[spec[at]] = value, n
            value, at = value + 1, at + 1
        value <<= 1
    return code, length


def lookup(spec: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and code length for every 16 bits ahead."""
    code, length = codes(spec)
    symbol, size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for s in spec[16:]:
        lo = int(code[s]) << (16 - int(length[s]))
        symbol[lo : lo + (1 << (16 - int(length[s])))] = s
        size[lo : lo + (1 << (16 - int(length[s])))] = length[s]
    return symbol, size


DC_TABLE, AC_TABLE = table_bytes(DC_LENGTHS), table_bytes(AC_LENGTHS)
BIT_LENGTH = np.array([i.bit_length() for i in range(1 << 12)])


class Writer:
    """Bits of many lanes."""

    def __init__(self, lanes: int, words: int) -> None:
        self.words, self.flat = words, np.zeros(lanes * words, np.uint32)
        self.base, self.at = np.arange(lanes) * words, np.zeros(lanes, np.int64)

    def put(self, lanes, code: np.ndarray, length: np.ndarray) -> None:
        """Appends codes of 1 to 32 bits to the lanes."""
        at = self.at[lanes]
        value = code << (64 - length - (at & 31)).astype(np.uint64)
        spot = self.base[lanes] + (at >> 5)
        self.flat[spot] |= (value >> np.uint64(32)).astype(np.uint32)
        self.flat[spot + 1] |= value.astype(np.uint32)
        self.at[lanes] = at + length

    def stream(self, number: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stuffed bytes of all lanes with restart markers between them (none after a `last` lane), and where each lane ends."""
        full = (self.at + 7) >> 3
        pad = full * 8 - self.at
        some = np.flatnonzero(pad)
        self.put(some, (np.uint64(1) << pad[some].astype(np.uint64)) - np.uint64(1), pad[some])
        table = self.flat.byteswap().view(np.uint8).reshape(len(full), self.words * 4)
        raw = table[np.arange(self.words * 4) < full[:, None]]
        ff = raw == 255
        ends = np.cumsum(full)
        marks = np.where(last, 0, 2)
        lane = np.repeat(np.arange(len(full)), full)
        place = np.arange(len(raw)) + np.cumsum(ff) - ff + (np.cumsum(marks) - marks)[lane]
        stuffed = np.concatenate([[0], np.cumsum(ff)])
        stop = ends + stuffed[ends] + np.cumsum(marks)
        out = np.zeros(int(stop[-1]) if len(stop) else 0, np.uint8)
        out[place] = raw
        m = np.flatnonzero(~last)
        out[stop[m] - 2], out[stop[m] - 1] = 255, 0xD0 + number[m] % 8
        return out, stop


def _signed(value: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bits that stand for a value of the given bit length."""
    return np.where(value < 0, value + (1 << size) - 1, value).astype(np.uint64)


def _write_dc(w: Writer, dc: list[np.ndarray], component: list[int], refine: bool, low: int) -> None:
    """dc: for each block of a unit, the value of every lane."""
    every, code, length = slice(None), *codes(DC_TABLE)
    before = {c: np.zeros(len(w.at), np.int64) for c in component}
    for values, c in zip(dc, component, strict=True):
        v = values.astype(np.int64) >> low
        if refine:
            w.put(every, (v & 1).astype(np.uint64), np.ones(len(v), np.int64))
            continue
        apart = v - before[c]
        before[c] = v
        size = BIT_LENGTH[np.abs(apart)]
        w.put(every, (code[size] << size.astype(np.uint64)) | _signed(apart, size), length[size] + size)


def _write_ac(w: Writer, rows: np.ndarray, lo: int, hi: int, low: int) -> None:
    """First scan of places lo to hi; rows: place by lane."""
    code, length = codes(AC_TABLE)
    run = np.zeros(rows.shape[1], np.int64)
    for k in range(lo, hi + 1):
        v = rows[k].astype(np.int64)
        v = np.sign(v) * (np.abs(v) >> low)
        here = np.flatnonzero(v)
        while len(far := here[run[here] > 15]):
            w.put(far, np.full(len(far), code[0xF0]), np.full(len(far), length[0xF0]))
            run[far] -= 16
        x = v[here]
        size = BIT_LENGTH[np.abs(x)]
        symbol = run[here] << 4 | size
        w.put(here, (code[symbol] << size.astype(np.uint64)) | _signed(x, size), length[symbol] + size)
        run += 1
        run[here] = 0
    rest = np.flatnonzero(run)
    w.put(rest, np.full(len(rest), code[0]), np.full(len(rest), length[0]))


def _put_kept(w: Writer, lanes: np.ndarray, kept: np.ndarray, n: np.ndarray) -> None:
    """Appends the correction bits that wait (at most 63 to a lane)."""
    for _ in range(2):
        some = lanes[n[lanes] > 0]
        if not len(some):
            return
        take = np.minimum(n[some], 32)
        rest = n[some] - take
        w.put(some, (kept[some] >> rest.astype(np.uint64)) & ((np.uint64(1) << take.astype(np.uint64)) - np.uint64(1)), take)
        n[some] = rest
    kept[lanes] = 0


def _write_refined(w: Writer, rows: np.ndarray, lo: int, hi: int, low: int) -> None:
    """Further bit of places lo to hi."""
    code, length = codes(AC_TABLE)
    lanes = rows.shape[1]
    run, kept, n = np.zeros(lanes, np.int64), np.zeros(lanes, np.uint64), np.zeros(lanes, np.int64)
    size = np.abs(rows.astype(np.int16)) >> low
    final = np.zeros(lanes, np.int64)
    for k in range(lo, hi + 1):
        final[size[k] == 1] = k
    for k in range(lo, hi + 1):
        s = size[k]
        while len(far := np.flatnonzero((s > 0) & (run > 15) & (k <= final))):
            w.put(far, np.full(len(far), code[0xF0]), np.full(len(far), length[0xF0]))
            run[far] -= 16
            _put_kept(w, far, kept, n)
        old = s > 1
        kept = np.where(old, kept << np.uint64(1) | (s & 1).astype(np.uint64), kept)
        n += old
        run += s == 0
        new = np.flatnonzero(s == 1)
        if len(new):
            symbol = run[new] << 4 | 1
            w.put(new, code[symbol] << np.uint64(1) | (rows[k][new] > 0).astype(np.uint64), length[symbol] + 1)
            _put_kept(w, new, kept, n)
            run[new] = 0
    rest = np.flatnonzero((run > 0) | (n > 0))
    w.put(rest, np.full(len(rest), code[0]), np.full(len(rest), length[0]))
    _put_kept(w, rest, kept, n)


def _segment(marker: int, body: bytes) -> bytes:
    return bytes([255, marker]) + (len(body) + 2).to_bytes(2, "big") + body


@dataclass
class Grid:
    """Units across and down of each file, and its first block; a file's planes follow each other, 4 + 1 + 1 blocks to a unit."""

    wide: np.ndarray
    high: np.ndarray
    first: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.first = np.concatenate([[0], np.cumsum(6 * self.wide * self.high)])

    @staticmethod
    def fitting(blocks: np.ndarray) -> Grid:
        units = -(-blocks // 6)
        wide = np.ceil(np.sqrt(units)).astype(np.int64)
        if wide.max(initial=0) > 4095:
            raise ValueError("too large for one image")
        return Grid(wide, -(-units // wide))

    def unit_blocks(self) -> tuple[np.ndarray, list[np.ndarray]]:
        """File of every unit, and the six blocks of every unit."""
        units = self.wide * self.high
        f = np.repeat(np.arange(len(units)), units)
        n = np.arange(units.sum()) - np.concatenate([[0], np.cumsum(units)])[f]
        y, x = n // self.wide[f], n % self.wide[f]
        luma = [self.first[f] + (2 * y + v) * 2 * self.wide[f] + 2 * x + h for v in (0, 1) for h in (0, 1)]
        return f, [*luma, self.first[f] + 4 * units[f] + n, self.first[f] + 5 * units[f] + n]

    def planes(self) -> tuple[np.ndarray, np.ndarray]:
        """File times three plus component of every block, and its number within that plane."""
        sizes = (self.wide * self.high)[:, None] * np.array([4, 1, 1])
        plane = np.repeat(np.arange(sizes.size), sizes.ravel())
        return plane, np.arange(len(plane)) - np.concatenate([[0], np.cumsum(sizes.ravel())])[plane]


def encode(rows: np.ndarray, grid: Grid, comments: list[bytes]) -> list[bytes]:
    """Files of coefficients; rows: zigzag place by block, all files' blocks in order."""
    files = len(grid.wide)
    f, blocks = grid.unit_blocks()
    units_last = np.append(f[1:] != f[:-1], True)[: len(f)]
    units_at = np.arange(len(f)) - np.searchsorted(f, f)
    plane, number = grid.planes()
    plane_last = np.append(plane[1:] != plane[:-1], True)[: len(plane)]
    bands: dict[tuple, tuple[np.ndarray, np.ndarray]] = {}
    parts: list[list[bytes]] = [[] for _ in range(files)]
    for components, lo, hi, high, low in SCRIPT:
        head = bytes([len(components)]) + b"".join(bytes([c + 1, 0x00]) for c in components) + bytes([lo, hi, high << 4 | low])
        if lo == 0:
            w = Writer(len(f), 6)
            _write_dc(w, [rows[0][b] for b in blocks], [0, 0, 0, 0, 1, 2], high > 0, low)
            out, stop = w.stream(units_at, units_last)
            ends = stop[np.flatnonzero(units_last)]
        else:
            if (lo, hi, high) not in bands:
                w = Writer(rows.shape[1], 44)
                (_write_refined if high else _write_ac)(w, rows, lo, hi, low)
                out, stop = w.stream(number, plane_last)
                bands[lo, hi, high] = out, stop[np.flatnonzero(plane_last)]
            out, ends = bands[lo, hi, high]
        sos, data = _segment(0xDA, head), out.tobytes()
        for i in range(files):
            k = i if lo == 0 else 3 * i + components[0]
            parts[i] += [sos, data[ends[k - 1] if k else 0 : ends[k]]]
    tables = _segment(0xDB, b"\0" + b"\1" * 64) + _segment(0xC4, b"\0" + DC_TABLE) + _segment(0xC4, b"\x10" + AC_TABLE) + _segment(0xDD, b"\0\1")
    result = []
    for i in range(files):
        size = (16 * int(grid.high[i])).to_bytes(2, "big") + (16 * int(grid.wide[i])).to_bytes(2, "big")
        frame = b"\x08" + size + b"\x03" + b"".join(bytes([c + 1, h << 4 | v, 0]) for c, (h, v) in enumerate(SAMPLING))
        result.append(b"\xff\xd8" + _segment(0xFE, comments[i]) + _segment(0xC2, frame) + tables + b"".join(parts[i]) + b"\xff\xd9")
    return result


@dataclass
class Parsed:
    """What the markers of a file say; scan data as ranges of the file."""

    height: int = 0
    width: int = 0
    comment: bytes = b""
    components: tuple = ()
    quant: tuple = ()
    scans: list = field(default_factory=list)
    ranges: list = field(default_factory=list)

    def structure(self) -> tuple:
        return self.components, self.quant, tuple(self.scans)


_SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]")


def parse(data: bytes) -> Parsed:
    out, at, tables, quant, interval = Parsed(), 2, {}, {}, 0
    if data[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG file")
    while data[at + 1] != 0xD9:
        marker, size = data[at + 1], int.from_bytes(data[at + 2 : at + 4], "big")
        body, at = data[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xC2:
            if body[0] != 8 or body[5] not in (1, 3):
                raise ValueError("8-bit samples of one or three components only")
            out.height, out.width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
            out.components = tuple((body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(body[5]))
        elif marker == 0xFE:
            out.comment = body
        elif marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = tuple(body[1:65]) if not wide else tuple(int.from_bytes(body[1 + 2 * i : 3 + 2 * i], "big") for i in range(64))
                body = body[129 if wide else 65 :]
        elif marker == 0xC4:
            while body:
                n = 17 + sum(body[1:17])
                tables[body[0]] = bytes(body[1:n])
                body = body[n:]
        elif marker == 0xDD:
            interval = int.from_bytes(body, "big")
        elif marker == 0xDA:
            n, ids = body[0], [c[0] for c in out.components]
            parts = tuple((ids.index(body[1 + 2 * i]), tables.get(body[2 + 2 * i] >> 4), tables.get(0x10 | body[2 + 2 * i] & 15)) for i in range(n))
            lo, hi, bits = body[1 + 2 * n : 4 + 2 * n]
            stop = _SCAN_END.search(data, at).start()
            out.scans.append((parts, lo, hi, bits >> 4, bits & 15, interval))
            out.ranges.append((at, stop))
            at = stop
        elif marker in (0xC0, 0xC1, 0xC3, *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
            raise ValueError("not a progressive Huffman-coded file")
    out.quant = tuple(sorted(quant.items()))
    return out


class Reader:
    """Bits of many lanes: lanes begin at each file's scan data and after each restart marker."""

    def __init__(self, parts: list[bytes]) -> None:
        data = np.frombuffer(b"".join(parts) + b"\0" * 8, np.uint8)
        first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        n = int(first[-1])
        after = np.zeros(n, bool)
        after[1:] = data[: n - 1] == 255
        after[first[(first > 0) & (first < n)]] = False
        restart = np.flatnonzero(after & (data[:n] >= 0xD0) & (data[:n] <= 0xD7))
        keep = ~(after & (data[:n] == 0))
        keep[restart] = keep[restart - 1] = False
        kept = np.concatenate([[0], np.cumsum(keep)])
        begin = np.sort(np.concatenate([first[:-1], restart + 1]))
        self.file = np.searchsorted(first, begin, "right") - 1
        self.pos = kept[begin] * 8
        clean = np.concatenate([data[:n][keep], np.zeros(16, np.uint8)])
        self._clean = clean
        self.ahead = np.ndarray((len(clean) - 8,), ">u8", clean.data, strides=(1,))

    def peek(self, pos: np.ndarray) -> np.ndarray:
        """At least 57 bits ahead, at the top."""
        return self.ahead[np.minimum(pos >> 3, len(self.ahead) - 1)].astype(np.uint64) << (pos & 7).astype(np.uint64)


def _value(bits: np.ndarray, length: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Signed value of `size` bits that come after `length` bits."""
    raw = ((bits << length.astype(np.uint64)) >> np.uint64(1) >> (63 - size).astype(np.uint64)).astype(np.int64)
    return np.where((raw >> np.maximum(size - 1, 0)) > 0, raw, raw - (1 << size) + 1) * (size > 0)


def _read_dc(r: Reader, rows, targets, specs, refine: bool, low: int) -> None:
    """targets: per step the lanes, their blocks and the component, in coding order."""
    looks = {c: lookup(s) for c, s in specs.items() if s}
    before = {c: np.zeros(len(r.pos), np.int64) for c in specs}
    for lanes, blocks, c in targets:
        bits = r.peek(r.pos[lanes])
        if refine:
            rows[c][0][blocks] |= ((bits >> np.uint64(63)).astype(np.int16) << low).astype(np.int16)
            r.pos[lanes] += 1
            continue
        symbol, size = looks[c][0][bits >> np.uint64(48)], looks[c][1][bits >> np.uint64(48)]
        before[c][lanes] += _value(bits, size, symbol)
        rows[c][0][blocks] = (before[c][lanes] << low).astype(np.int16)
        r.pos[lanes] += size + symbol


def _read_ac(r: Reader, rows, steps, spec, lo: int, hi: int, low: int) -> None:
    """First scan of a band. steps: lanes and their blocks, block after block."""
    symbols, sizes = lookup(spec)
    skip = np.zeros(len(r.pos), np.int64)
    for lanes, blocks in steps:
        live = skip[lanes] == 0
        skip[lanes[~live]] -= 1
        lane, block = lanes[live], blocks[live]
        pos, run, value = r.pos[lane], np.full(len(lane), -1), np.zeros(len(lane), np.int64)
        for k in range(lo, hi + 1):
            if not len(lane):
                break
            need = np.flatnonzero(run < 0)
            if len(need):
                at = pos[need]
                bits = r.peek(at)
                symbol, length = symbols[bits >> np.uint64(48)], sizes[bits >> np.uint64(48)]
                size = symbol & 15
                zeros = symbol >> 4
                end = (size == 0) & (zeros < 15)
                extra = np.where(end, zeros, size)
                got = _value(bits, length, size)
                value[need] = np.sign(got) * (np.abs(got) << low)
                run[need] = zeros
                pos[need] = at + length + extra
                if end.any():
                    e = need[end]
                    more = (bits[end] << length[end].astype(np.uint64)) >> np.uint64(1) >> (63 - zeros[end]).astype(np.uint64)
                    skip[lane[e]] = (1 << zeros[end]) - 1 + np.where(zeros[end] > 0, more.astype(np.int64), 0)
                    r.pos[lane[e]] = pos[e]
                    stay = np.ones(len(lane), bool)
                    stay[e] = False
                    lane, block, pos, run, value = lane[stay], block[stay], pos[stay], run[stay], value[stay]
            put = np.flatnonzero(run == 0)
            rows[k][block[put]] = value[put]
            run -= 1
        r.pos[lane] = pos


def _read_refined(r: Reader, rows, steps, spec, lo: int, hi: int, low: int) -> None:
    """Further bit of a band."""
    symbols, sizes = lookup(spec)
    bit = 1 << low
    skip = np.zeros(len(r.pos), np.int64)
    for lane, block in steps:
        over = skip[lane] > 0
        skip[lane[over]] -= 1
        pos, run, value = r.pos[lane], np.full(len(lane), -1), np.zeros(len(lane), np.int64)
        for k in range(lo, hi + 1):
            need = np.flatnonzero(~over & (run < 0))
            if len(need):
                bits = r.peek(pos[need])
                symbol, length = symbols[bits >> np.uint64(48)], sizes[bits >> np.uint64(48)]
                size, zeros = symbol & 15, symbol >> 4
                end = (size == 0) & (zeros < 15)
                rest = bits << length.astype(np.uint64)
                value[need] = np.where(size == 0, 0, np.where(rest >> np.uint64(63), bit, -bit))
                run[need] = zeros
                more = (rest >> np.uint64(1) >> (63 - zeros).astype(np.uint64)).astype(np.int64)
                pos[need] += length + np.where(end, zeros, size)
                e = need[end]
                over[e] = True
                skip[lane[e]] = ((1 << zeros) - 1 + np.where(zeros > 0, more, 0))[end]
            now = rows[k][block].astype(np.int64)
            old = np.flatnonzero(now)
            if len(old):
                set_ = (r.peek(pos[old]) >> np.uint64(63)).astype(bool)
                pos[old] += 1
                x = now[old]
                rows[k][block[old]] = np.where(set_ & ((np.abs(x) & bit) == 0), x + np.sign(x) * bit, x)
            fresh = (now == 0) & ~over
            put = np.flatnonzero(fresh & (run == 0))
            rows[k][block[put]] = value[put]
            run[fresh] -= 1
        r.pos[lane] = pos


@dataclass
class Decoded:
    """Coefficients of one file: per component, zigzag place by block (raster order of its grid), and the grid's blocks across."""

    parsed: Parsed
    rows: list[np.ndarray]
    across: list[int]


def decode(files: list[bytes]) -> list[Decoded]:
    parsed = [parse(x) for x in files]
    groups: dict[tuple, list[int]] = {}
    for i, p in enumerate(parsed):
        groups.setdefault(p.structure(), []).append(i)
    out: list[Decoded | None] = [None] * len(files)
    for (components, _, scans), members in groups.items():
        hmax, vmax = max(c[1] for c in components), max(c[2] for c in components)
        wide = np.array([-(-parsed[i].width // (8 * hmax)) for i in members])
        high = np.array([-(-parsed[i].height // (8 * vmax)) for i in members])
        across = [wide * c[1] for c in components]
        first = [np.concatenate([[0], np.cumsum(wide * high * c[1] * c[2])]) for c in components]
        rows = [np.zeros((64, int(x[-1])), np.int16) for x in first]
        for s, (parts, lo, hi, was, low, interval) in enumerate(scans):
            r = Reader([files[i][slice(*parsed[i].ranges[s])] for i in members])
            if len(parts) > 1:
                units, tall = wide * high, None
            else:
                c = parts[0][0]
                wide_c = np.array([-(-(-(-parsed[i].width * components[c][1] // hmax)) // 8) for i in members])
                tall = np.array([-(-(-(-parsed[i].height * components[c][2] // vmax)) // 8) for i in members])
                units = wide_c * tall
            per = np.where(interval > 0, interval, np.maximum(units, 1))
            lanes = -(-units // per)
            if not np.array_equal(np.bincount(r.file, minlength=len(members)), lanes):
                raise ValueError("restart markers do not fit the image")
            own = np.arange(len(r.file)) - np.concatenate([[0], np.cumsum(lanes)])[r.file]
            begin, f = own * per[r.file], r.file
            steps = []
            for j in range(int(np.minimum(per, units).max(initial=0))):
                lane = np.flatnonzero((begin + j < units[f]) & (j < per[f]))
                n, g = begin[lane] + j, f[lane]
                if tall is not None:
                    steps.append((lane, first[c][g] + n // wide_c[g] * across[c][g] + n % wide_c[g], c))
                    continue
                for c, _, _ in parts:
                    for v in range(components[c][2]):
                        for h in range(components[c][1]):
                            y, x = n // wide[g] * components[c][2] + v, n % wide[g] * components[c][1] + h
                            steps.append((lane, first[c][g] + y * across[c][g] + x, c))
            if lo == 0:
                _read_dc(r, rows, steps, {c: dc for c, dc, _ in parts}, was > 0, low)
            else:
                c = parts[0][0]
                (_read_refined if was else _read_ac)(r, rows[c], [x[:2] for x in steps], parts[0][2], lo, hi, low)
        for k, i in enumerate(members):
            out[i] = Decoded(parsed[i], [x[:, a[k] : a[k + 1]] for x, a in zip(rows, first, strict=True)], [int(x[k]) for x in across])
    return out


def _inverse() -> np.ndarray:
    """Samples by zigzag coefficients of a block."""
    u = np.arange(8)
    one = np.cos((2 * u[:, None] + 1) * u[None, :] * np.pi / 16) * np.where(u == 0, np.sqrt(1 / 8), 0.5)
    return np.kron(one, one)[:, ZIGZAG].astype(np.float32)


INVERSE = _inverse()


def to_rgb(x: Decoded) -> np.ndarray:
    """Height by width by 3, 8-bit: inverse transform, chroma raised to full resolution, colour conversion."""
    p, quant = x.parsed, dict(x.parsed.quant)
    hmax, vmax = max(c[1] for c in p.components), max(c[2] for c in p.components)
    planes = []
    for (_, h, v, q), rows, across in zip(p.components, x.rows, x.across, strict=True):
        samples = INVERSE @ (rows * np.array(quant[q], np.float32)[:, None])
        plane = samples.reshape(8, 8, -1, across).transpose(2, 0, 3, 1).reshape(-1, across * 8)
        plane = np.clip(np.rint(plane + 128), 0, 255)
        planes.append(plane.repeat(vmax // v, 0).repeat(hmax // h, 1)[: p.height, : p.width])
    if len(planes) == 1:
        planes = planes * 3
    else:
        y, b, r = planes[0], planes[1] - 128, planes[2] - 128
        planes = [y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b]
    return np.clip(np.rint(np.stack(planes, -1)), 0, 255).astype(np.uint8)
