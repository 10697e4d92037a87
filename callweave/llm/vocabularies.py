"""Two tokenizers as tasks use them, each from the content of its vocabulary file, with the bytes of every id.

A byte-level BPE file of the `tokenizers` library merges by rank inside pre-tokens. Where the merges come in the order of their results' ids
(checked when the file is read), the rank coder of `tiktoken` gives the same ids several times as fast and is taken; else, and for texts that
hold an added token's string where that counts, the library itself encodes.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import sentencepiece
import tiktoken
from pyspark.sql import SparkSession
from tokenizers import Tokenizer

from callweave.llm.bpe import FROM_SHOWN, VOCABULARY_LIMIT

#: Pre-tokens of the byte-level vocabulary (fixed value of that format).
PRE_TOKEN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE_MARK = "▁"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
#: Units that a generation of a worker's memory holds: when it is full it becomes the old one, from which units in use move on to the next
#: (memory only, results do not change).
REMEMBERED = 500_000
#: Characters from which the library encodes a text: the rank coder's patterns may run out of stack on endless runs of one kind.
LONG_TEXT = 1_000_000


def sent_file(spark: SparkSession, path: str):
    """A vocabulary file, read on the driver and broadcast; its size is checked, it does not grow with the data."""
    with open(path, "rb") as f:
        content = f.read(VOCABULARY_LIMIT + 1)
    if len(content) > VOCABULARY_LIMIT:
        raise ValueError(f"vocabulary file over {VOCABULARY_LIMIT} bytes")
    return spark.sparkContext.broadcast(content)


class ByteLevel:
    """A byte-level BPE file of the `tokenizers` library."""

    def __init__(self, content: bytes) -> None:
        text = content.decode()
        described = json.loads(text)
        self.library, self.plain = Tokenizer.from_str(text), Tokenizer.from_str(text)
        self.plain.encode_special_tokens = True
        added = {t["id"]: t["content"] for t in described["added_tokens"]}
        shown = [self.library.id_to_token(i) for i in range(self.library.get_vocab_size())]
        self.tokens = [added[i].encode() if i in added else bytes(FROM_SHOWN[c] for c in s) for i, s in enumerate(shown)]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.added = list(added.values())
        pairs = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        ids = [described["model"]["vocab"][a + b] for a, b in pairs]
        self.ranks = None
        if ids == list(range(256, 256 + len(ids))):
            ranks = {self.tokens[i]: i for i in range(256 + len(ids))}
            self.ranks = tiktoken.Encoding("own", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids; added tokens' strings inside the text are text."""
        if self.ranks is None or len(text) >= LONG_TEXT:
            return np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        return self.ranks.encode_to_numpy(text, disallowed_special=())

    def encode_as_library(self, text: str) -> np.ndarray:
        """As the library's defaults do it: an added token's string inside the text is that token."""
        if any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.encode(text)


class Pieces:
    """A sentencepiece BPE model that puts a space mark ahead of a text.

    Merges cross a place only where the vocabulary has a piece that spans it. No piece has a space mark after another character (checked), so a
    text is cut before every space that follows another character; each such unit is encoded once by the library and remembered.
    """

    def __init__(self, content: bytes) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in names):
            raise ValueError("a piece has a space after another character: texts cannot be cut into units")
        bytes_of = lambda p: bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace(SPACE_MARK, " ").encode()
        self.tokens = [bytes_of(p) for p in names]
        self.sizes = np.array([len(t) for t in self.tokens], np.int64)
        self.unit = re.compile(f"[ {SPACE_MARK}]+[^ {SPACE_MARK}]*")
        self.space = [self.library.piece_to_id(SPACE_MARK)]
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        #: Units whose ids are not their bytes.
        self.lossy: set[str] = set()

    def _learn(self, units: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known, self.old = {}, self.known
            self.lossy &= self.old.keys()
        fresh = []
        for u in units.difference(self.known):
            ids = self.old.get(u)
            if ids is None:
                fresh.append(u)
            else:
                self.known[u] = ids
        # The library writes a unit's first space itself, but not ahead of nothing.
        found = self.library.encode([u[1:] for u in fresh], num_threads=1) if fresh else []
        found = [x if len(u) > 1 else self.space for u, x in zip(fresh, found, strict=True)]
        packed, at = np.array([i for x in found for i in x], "<u4").tobytes(), 0
        for unit, ids in zip(fresh, found):
            self.known[unit] = packed[at : (at := at + 4 * len(ids))]
            if b"".join([self.tokens[i] for i in ids]) != unit.encode():
                self.lossy.add(unit)

    def encode(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text with its space ahead, or None where their joined bytes are not that text's."""
        cut = [self.unit.findall(" " + t) for t in texts]
        self._learn(set().union(*cut))
        out = []
        for text, units in zip(texts, cut):
            ids = np.frombuffer(b"".join([self.known[u] for u in units]), "<u4")
            if self.lossy and not self.lossy.isdisjoint(units):
                ids = ids if b"".join(map(self.tokens.__getitem__, ids.tolist())) == (" " + text).encode() else None
            out.append(ids)
        return out


_LOADED: dict[tuple, ByteLevel | Pieces] = {}


def loaded(kind: type, content: bytes) -> ByteLevel | Pieces:
    key = (kind, hashlib.sha256(content).digest())
    if key not in _LOADED:
        _LOADED[key] = kind(content)
    return _LOADED[key]
