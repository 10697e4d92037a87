"""Wavelet matrix of a run of token ids in numpy, one compressed file.

Plane 0 holds the highest bit of every id in order; each next plane holds the next bit after the ids whose bit was 0 have been moved, in
order, ahead of those whose bit was 1. A plane is cut into blocks of `BLOCK` bits that are compressed each by themselves; the number of ones
ahead of every block is in the header. Rank takes one block, select a search over those numbers and one block, so `access`, `count` and
`positions` open the blocks they need only.

File: 8 marker bytes, then 64-bit numbers: ids, planes, blocks of a plane, documents; documents' ids with a flag for null, their first
positions; zeros of each plane; ones ahead of each block; ends of the compressed blocks; then the blocks.
"""

from __future__ import annotations

import numpy as np
import zstandard

MARK = b"CWWAVE01"
#: Bits of a block; a multiple of 64.
BLOCK = 1 << 16


class Writer:
    """Collects documents and gives the file."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.parts.append(ids)
        self.size += len(ids)

    def content(self) -> bytes:
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.uint32)
        starts = np.concatenate([[0], np.cumsum([len(p) for p in self.parts])]).astype("<i8")
        names = np.array([d if d is not None else 0 for d in self.docs], "<i8")
        nulls = np.array([d is None for d in self.docs], "<i8")
        planes = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        ids = ids.astype(np.uint16) if planes <= 16 else ids
        blocks = -(-len(ids) // BLOCK)
        zeros, ones, ends, packed, at = [], [], [], [], 0
        squeeze = zstandard.ZstdCompressor(level=1)
        for level in range(planes - 1, -1, -1):
            bit = (ids & ids.dtype.type(1 << level)) != 0
            bits = np.packbits(bit, bitorder="little")
            bits = np.pad(bits, (0, blocks * BLOCK // 8 - len(bits)))
            count = np.bitwise_count(bits.view("<u8")).reshape(blocks, BLOCK // 64).sum(axis=1, dtype=np.int64)
            ones.append(np.concatenate([[0], np.cumsum(count)]))
            for k in range(blocks):
                packed.append(squeeze.compress(bits[k * BLOCK // 8 : (k + 1) * BLOCK // 8].tobytes()))
                at += len(packed[-1])
                ends.append(at)
            low = ids[~bit]
            zeros.append(len(low))
            ids = np.concatenate([low, ids[bit]])
        head = [np.array([len(ids), planes, blocks, len(names)]), names, nulls, starts, np.array(zeros), *ones, np.array(ends)]
        return MARK + b"".join(np.asarray(h, "<i8").tobytes() for h in head) + b"".join(packed)


class WaveletMatrix:
    """Reads the file."""

    def __init__(self, content: bytes) -> None:
        if content[:8] != MARK:
            raise ValueError("not a wavelet matrix file")
        self.content, self.at = content, 8
        self.size, self.planes, self.blocks, docs = self._numbers(4).tolist()
        names, nulls = self._numbers(docs), self._numbers(docs)
        self.docs = [None if z else d for d, z in zip(names.tolist(), nulls.tolist())]
        self.starts = self._numbers(docs + 1)
        self.zeros = self._numbers(self.planes)
        self.ones = self._numbers(self.planes * (self.blocks + 1)).reshape(self.planes, -1)
        self.ends = np.concatenate([[0], self._numbers(self.planes * self.blocks)])
        self.open_: dict[tuple[int, int], np.ndarray] = {}

    def _numbers(self, n: int) -> np.ndarray:
        out = np.frombuffer(self.content, "<i8", n, self.at)
        self.at += 8 * n
        return out

    def _words(self, level: int, block: int) -> np.ndarray:
        """64-bit words of a block, with the ones ahead of each word in the block."""
        key = (level, block)
        if key not in self.open_:
            k = level * self.blocks + block
            raw = zstandard.ZstdDecompressor().decompress(self.content[self.at + int(self.ends[k]) : self.at + int(self.ends[k + 1])])
            words = np.frombuffer(raw, "<u8")
            self.open_[key] = np.stack([words, np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.uint64)])[:-1].astype(np.uint64)])
        return self.open_[key]

    def bit(self, level: int, i: int) -> int:
        words = self._words(level, i // BLOCK)[0]
        return int(words[i % BLOCK // 64]) >> (i % 64) & 1

    def rank(self, level: int, i: int) -> int:
        """Ones of a plane ahead of place i."""
        block, inside = divmod(i, BLOCK)
        ahead = int(self.ones[level, block])
        if not inside:
            return ahead
        words = self._words(level, block)
        return ahead + int(words[1, inside // 64]) + (int(words[0, inside // 64]) & (1 << inside % 64) - 1).bit_count()

    def select(self, level: int, value: int, n: int) -> int:
        """Place of the n-th (from 0) bit that equals value."""
        ahead = self.ones[level] if value else np.arange(self.blocks + 1) * BLOCK - self.ones[level]
        block = int(np.searchsorted(ahead, n, "right")) - 1
        words = self._words(level, block)
        before = words[1].astype(np.int64) if value else np.arange(len(words[1])) * 64 - words[1].astype(np.int64)
        left = n - int(ahead[block])
        k = int(np.searchsorted(before, left, "right")) - 1
        bits = np.unpackbits(words[0, k : k + 1].view(np.uint8), bitorder="little")
        return block * BLOCK + 64 * k + int(np.flatnonzero(bits == value)[left - int(before[k])])

    def access(self, i: int) -> int:
        """The id at place i."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        out = 0
        for level in range(self.planes):
            b = self.bit(level, i)
            out = out << 1 | b
            ones = self.rank(level, i)
            i = int(self.zeros[level]) + ones if b else i - ones
        return out

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        """The places past the last plane of the occurrences of token among start to end."""
        if token >> self.planes:
            return 0, 0
        for level in range(self.planes):
            s, e = self.rank(level, start), self.rank(level, end)
            if token >> (self.planes - 1 - level) & 1:
                start, end = int(self.zeros[level]) + s, int(self.zeros[level]) + e
            else:
                start, end = start - s, end - e
            if start >= end:
                break
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of token among the places start to end."""
        s, e = self._range(token, start, self.size if end is None else end)
        return max(0, e - s)

    def positions(self, token: int, start: int = 0, end: int | None = None) -> list[int]:
        """Places of the occurrences, ascending: each is followed up through the planes by select."""
        s, e = self._range(token, start, self.size if end is None else end)
        out = []
        for i in range(s, e):
            for level in range(self.planes - 1, -1, -1):
                b = token >> (self.planes - 1 - level) & 1
                i = self.select(level, b, i - int(self.zeros[level]) if b else i)
            out.append(i)
        return out

    def everything(self) -> np.ndarray:
        """All ids in order: the planes are undone from the last to the first."""
        kind = np.uint16 if self.planes <= 16 else np.uint32
        out = np.zeros(self.size, kind)
        for level in range(self.planes - 1, -1, -1):
            k, z = level * self.blocks, zstandard.ZstdDecompressor()
            raw = b"".join(z.decompress(self.content[self.at + int(self.ends[j]) : self.at + int(self.ends[j + 1])]) for j in range(k, k + self.blocks))
            bit = np.unpackbits(np.frombuffer(raw, np.uint8), count=self.size, bitorder="little").astype(bool)
            up = np.empty_like(out)
            up[~bit] = out[: self.zeros[level]]
            up[bit] = out[self.zeros[level] :] | kind(1 << (self.planes - 1 - level))
            out = up
        return out.astype(np.uint32)
