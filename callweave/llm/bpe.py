"""Operator 5: byte-level BPE through a sentencepiece model that is written directly from a rank vocabulary.

Every byte is shown as one printable character; a piece is a vocabulary entry so written, scored by its negative rank. With identity
normalisation, sentencepiece then merges in rank order inside each pre-token. Decoding maps pieces back to bytes.

Null texts encode as no tokens. A null id stays null; equal rows give equal rows; an empty table gives an empty table; other columns pass
through. Texts are encoded whole, whatever their length.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm import common

#: Most bytes of a vocabulary file that is sent to every task.
VOCABULARY_LIMIT = 64 << 20
#: Pre-tokens whose ids a worker remembers; beyond that it starts anew (memory only, results do not change).
REMEMBERED = 400_000


def shown_bytes() -> list[str]:
    """A printable character for each byte: itself where it prints, else the next one from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(spare)) for b in range(256)]


SHOWN = shown_bytes()
TO_SHOWN = dict(enumerate(SHOWN))
FROM_SHOWN = {c: b for b, c in enumerate(SHOWN)}


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | bytes | float) -> bytes:
    """One protobuf field: varint, float or length-delimited."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in content.splitlines() if line.strip())}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """A serialised sentencepiece BPE model whose piece ids are the ranks; the unknown piece takes the next free id."""
    order = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in order] != list(range(len(order))):
        raise ValueError("ranks must run from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every byte must be a token")
    out = bytearray()
    for token in order:
        piece = "".join(SHOWN[b] for b in token).encode()
        out += _field(1, _field(1, piece) + _field(2, -float(ranks[token])) + _field(3, 1))
    out += _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    n = len(order)
    trainer = _field(3, 2) + _field(4, n + 1) + _field(40, n) + _field(41, -1) + _field(42, -1) + _field(43, -1)
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return bytes(out + _field(2, trainer) + _field(3, normalizer))


def narrow(pattern: str) -> re.Pattern:
    """The same pattern for texts of code points below 256, with the Unicode classes spelt out as bit maps (several times faster)."""
    inside = {c: "".join(re.escape(chr(i)) for i in range(256) if regex.match(c, chr(i))) for c in (r"\p{L}", r"\p{N}", r"\s")}
    out = re.sub(r"\[\^((?:\\s|\\p\{[LN]\})+)\]", lambda m: "[^" + "".join(inside[c] for c in re.findall(r"\\s|\\p\{.\}", m[1])) + "]", pattern)
    for c, members in inside.items():
        out = out.replace(c, f"[{members}]")
    return re.compile(out.replace(r"\S", f"[^{inside[chr(92) + 's']}]"))


class Codec:
    """Encodes and decodes with one model; remembers pre-tokens."""

    def __init__(self, model: bytes, pattern: str) -> None:
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pattern, self.narrow = regex.compile(pattern), narrow(pattern)
        n = self.pieces.get_piece_size() - 1
        self.direct = {self.pieces.id_to_piece(i): i for i in range(n)}
        self.bytes = [bytes(FROM_SHOWN[c] for c in self.pieces.id_to_piece(i)) for i in range(n)]
        self.known: dict[str, bytes] = {}

    def _learn(self, tokens: set[str]) -> None:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        tokens = [t for t in tokens if t not in self.known]
        shown = [t.encode().decode("latin-1").translate(TO_SHOWN) for t in tokens]
        # A pre-token that is itself in the vocabulary is one token, as in the rank encoder.
        ids = [[self.direct[s]] if s in self.direct else None for s in shown]
        rest = [k for k, x in enumerate(ids) if x is None]
        for k, x in zip(rest, self.pieces.encode([shown[k] for k in rest], num_threads=1) if rest else [], strict=True):
            ids[k] = x
        packed, at = np.array([i for x in ids for i in x], "<u4").tobytes(), 0
        for token, x in zip(tokens, ids, strict=True):
            self.known[token] = packed[at : (at := at + 4 * len(x))]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        try:
            text.encode("latin-1")
            tokens = self.narrow.findall(text)
        except UnicodeEncodeError:
            tokens = self.pattern.findall(text)
        try:
            return b"".join(map(self.known.__getitem__, tokens))
        except KeyError:
            self._learn(set(tokens))
            return b"".join(map(self.known.__getitem__, tokens))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple, Codec] = {}


def codec(model: bytes, pattern: str) -> Codec:
    key = (hashlib.sha256(model).digest(), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(model, pattern)
    return _CODECS[key]


def sent_model(spark: SparkSession, path: str):
    """The model of a vocabulary file, read on the driver and broadcast; its size is checked, it does not grow with the data."""
    with open(path, "rb") as f:
        content = f.read(VOCABULARY_LIMIT + 1)
    if len(content) > VOCABULARY_LIMIT:
        raise ValueError(f"vocabulary file over {VOCABULARY_LIMIT} bytes")
    return spark.sparkContext.broadcast(model_bytes(read_ranks(content)))


def _mapped(df: DataFrame, name: str, kind: T.DataType, arrow: pa.DataType, source: str, work) -> DataFrame:
    """Appends a column that a worker computes from another one, batch by batch."""
    schema = T.StructType([f for f in df.schema if f.name != name] + [T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do = None
        for piece in common.pieces(batches, source):
            do = do or work()
            value = pa.array([do(x) for x in piece.column(source).to_pylist()], arrow)
            kept = [c for c in piece.column_names if c != name]
            yield from piece.select(kept).append_column(name, value).to_batches()

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", out: str = "token_ids") -> DataFrame:
    """Adds `out`: the ids of the whole text as little-endian unsigned 32-bit integers (see `as_array`)."""
    model = sent_model(docs.sparkSession, path)

    def work():
        c = codec(model.value, pattern)
        return lambda x: c.encode(x or "")

    return _mapped(docs, out, T.BinaryType(), pa.binary(), text, work)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "token_ids", out: str = "decoded") -> DataFrame:
    """Adds `out`: the bytes that the ids stand for. Null ids decode as no bytes."""
    model = sent_model(df.sparkSession, path)

    def work():
        c = codec(model.value, pattern)
        return lambda x: c.decode(x or b"")

    return _mapped(df, out, T.BinaryType(), pa.binary(), ids, work)


def as_array(df: DataFrame, ids: str = "token_ids") -> DataFrame:
    """Turns packed ids into array<long>."""
    def number(i):
        four = F.hex(F.substring(F.col(ids), (i * 4 - 3).cast("int"), F.lit(4)))
        return F.conv(F.concat(*(F.substring(four, at, 2) for at in (7, 5, 3, 1))), 16, 10).cast("long")

    digits = F.transform(F.sequence(F.lit(1), F.floor(F.octet_length(ids) / 4)), number)
    return df.withColumn(ids, F.when(F.octet_length(ids) > 0, digits).otherwise(F.array().cast("array<long>")))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count and digests of ids and decoded bytes per document."""
    both = decode(encode(docs.select("doc_id", "text"), path, pattern).drop("text"), path, pattern)
    return both.select(
        "doc_id",
        F.floor(F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return digests(common.table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


QUERIES = {"op5_byte_bpe": op5_byte_bpe}
ORACLE: dict[str, str] = {}
