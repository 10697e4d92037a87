"""Minimal perfect hash of 64-bit keys in numpy: levels of bits, the rank of a key's bit is its index.

On each level the keys left fall on `SPREAD` times as many places; a key alone on its place sets the bit, the others go to the next level.
"""

from __future__ import annotations

import numpy as np

from callweave.llm.common import mix

SPREAD = 2
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix(keys + _STEP * np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)


def build(keys: np.ndarray) -> bytes:
    """The hash of distinct keys, serialised: number of levels, their sizes in 64-bit words, then their bits."""
    rest, sizes, planes = np.asarray(keys, np.uint64), [], []
    while len(rest):
        words = max(1, -(-SPREAD * len(rest) // 64))
        at = _places(rest, len(sizes), 64 * words)
        alone = np.bincount(at, minlength=64 * words) == 1
        planes.append(np.packbits(alone, bitorder="little").tobytes())
        sizes.append(words)
        rest = rest[~alone[at]]
    return np.array([len(sizes), *sizes], "<i8").tobytes() + b"".join(planes)


class PerfectHash:
    """`index` gives each key's place, 0 to n - 1; for a key that was not built in, any place or -1."""

    def __init__(self, content: bytes) -> None:
        levels = int(np.frombuffer(content, "<i8", 1)[0])
        self.sizes = np.frombuffer(content, "<i8", levels, 8).tolist()
        self.words = np.frombuffer(content, "<u8", -1, 8 * (levels + 1))
        self.first = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.ahead = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def __len__(self) -> int:
        return int(self.ahead[-1])

    def index(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = _places(keys[open_], level, 64 * size)
            word, bit = self.first[level] + (at >> 6), (at & 63).astype(np.uint64)
            content = self.words[word]
            hit = (content >> bit) & np.uint64(1) == 1
            below = content[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.ahead[word[hit]] + np.bitwise_count(below)
            open_ = open_[~hit]
        return out
