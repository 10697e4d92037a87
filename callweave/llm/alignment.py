"""Operator 11: alignment of two tokenizers over the same texts, with corpus-wide counts of the id pairs that end together.

A text with a space ahead is encoded by a byte-level vocabulary (A) and a sentencepiece model (B). The byte offsets where tokens of both end
cut the two sequences into groups; the two tokens that end at such an offset are a link.

Counting: every task adds up its links by pair and writes the sums. The distinct pairs are dealt by hash into segments of about `SEGMENT`
pairs; each segment gets a minimal perfect hash and its pairs in hash order. The written sums become dense count vectors, one per segment and
salt, indexed by the segment's hash, and are added up in a tree of fan-in `FAN`. A second pass aligns the documents again, finds each pair's
place by its segment's hash, verifies the pair there and takes the count. Up to `SENT` bytes the segments (hash, pairs, counts) are broadcast,
their size having been computed from the number of pairs; beyond that links are dealt to the segments by a shuffle. Both give the same rows.

Texts that are null, empty, or whose joined tokens of A or B are not the text's bytes have no tokens: zeros and empty groups. Texts are whole,
whatever their length. Null ids pass through; repeated rows are counted and returned as often as they occur; an empty table gives an empty
table. Other columns pass through, but those named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm import common, vocabularies
from callweave.llm.perfecthash import PerfectHash, build

#: Pairs of a segment, about.
SEGMENT = 1 << 15
#: Rows of written sums that one task turns into a dense vector.
SUMS = 1 << 18
#: Vectors added up by one task of the tree.
FAN = 16
#: Most bytes of segments that are broadcast.
SENT = 64 << 20
#: Distinct pairs that a task holds before it writes their sums.
HELD = 1 << 20
#: Bytes of a pair in a segment: the pair, its count, and under 8 bits of hash.
PAIR_BYTES = 17
COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@dataclass
class Aligned:
    """Tokens and links of several texts, one after the other; `rows_*` has each text's first entry (one more than texts)."""

    a: np.ndarray
    b: np.ndarray
    rows_a: np.ndarray
    rows_b: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    rows_links: np.ndarray


class Aligner:
    def __init__(self, content_a: bytes, content_b: bytes) -> None:
        self.one = vocabularies.loaded(vocabularies.ByteLevel, content_a)
        self.two = vocabularies.loaded(vocabularies.Pieces, content_b)
        n, m = len(self.one.tokens), len(self.two.tokens)
        self.width = m
        # Text of a token inside a group and at its end, A before B.
        self.texts = [f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + [f"{i}," for i in range(m)] + [f"{i};" for i in range(m)]

    def _whole(self, a: np.ndarray, text: str) -> bool:
        """Whether the tokens of A are the text's bytes with a space ahead. The rank coder merges just these bytes; the library may have a normaliser."""
        return self.one.ranks is not None or b"".join(map(self.one.tokens.__getitem__, a.tolist())) == (" " + text).encode()

    def align(self, texts: list[str | None]) -> Aligned:
        some = [t for t in texts if t]
        found = zip([self.one.encode(" " + t) for t in some], self.two.encode(some), some)
        none = np.zeros(0, np.uint32)
        kept = iter([(a, b) if b is not None and self._whole(a, t) else (none, none) for a, b, t in found])
        ids = [next(kept) if t else (none, none) for t in texts]
        a, b = (np.concatenate([none, *(x[k] for x in ids)]).astype(np.int64) for k in (0, 1))
        rows_a, rows_b = (np.concatenate([[0], np.cumsum([len(x[k]) for x in ids], dtype=np.int64)]) for k in (0, 1))
        # Both sequences of a text have as many bytes, so the running sums over several texts still meet at each text's end.
        ends_a, ends_b = np.cumsum(self.one.sizes[a]), np.cumsum(self.two.sizes[b])
        place = np.zeros((int(ends_b[-1]) if len(b) else 0) + 1, np.int32)
        place[ends_b] = np.arange(1, len(b) + 1)
        at = place[ends_a]
        hit = at > 0
        link_a = np.flatnonzero(hit)
        links = np.concatenate([[0], np.cumsum(hit)])
        return Aligned(a, b, rows_a, rows_b, link_a, at[link_a].astype(np.int64) - 1, links[rows_a])

    def pairs(self, x: Aligned) -> np.ndarray:
        return x.a[x.link_a] * self.width + x.b[x.link_b]

    def groups(self, x: Aligned) -> list[str]:
        """`a1,a2|b1;a3|b2,b3` of each text."""
        n, m = len(self.one.tokens), self.width
        code_a, code_b = x.a.copy(), x.b + 2 * n
        code_a[x.link_a] += n
        code_b[x.link_b] += m
        # A group's place: the tokens of both sequences that end at the cut before it or earlier.
        before_a, before_b = np.zeros(len(x.a) + 1, np.int64), np.zeros(len(x.b) + 1, np.int64)
        before_a[x.link_a + 1] = before_b[x.link_b + 1] = 1
        before_a, before_b = np.cumsum(before_a)[:-1], np.cumsum(before_b)[:-1]
        upto_a, upto_b = x.link_a + 1, np.concatenate([[0], x.link_b + 1])
        order = np.empty(len(x.a) + len(x.b), np.int64)
        order[np.arange(len(x.a)) + upto_b[before_a]] = code_a
        order[np.arange(len(x.b)) + upto_a[before_b]] = code_b
        rows = x.rows_a + x.rows_b
        parts = list(map(self.texts.__getitem__, order.tolist()))
        return ["".join(parts[s:e])[:-1] for s, e in zip(rows[:-1].tolist(), rows[1:].tolist())]


def per_text(values: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of each text's entries."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[rows[1:]] - sums[rows[:-1]]


def _aligner(content_a, content_b) -> Aligner:
    key = (content_a.value, content_b.value)
    if _ALIGNERS.get("key") != key:
        _ALIGNERS.update(key=key, aligner=Aligner(*key))
    return _ALIGNERS["aligner"]


_ALIGNERS: dict = {}


def pair_sums(docs: DataFrame, content_a, content_b) -> DataFrame:
    """pair, n: links by pair, added up inside each task. pair = id of A times B's vocabulary size plus id of B."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held, size = _aligner(content_a, content_b), [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            sums = np.zeros(len(keys), np.int64)
            np.add.at(sums, at, np.concatenate([n for _, n in held]))
            return keys, sums

        for piece in common.pieces(batches):
            found = np.unique(aligner.pairs(aligner.align(piece.column("text").to_pylist())), return_counts=True)
            held.append(found)
            size += len(found[0])
            if size > 2 * HELD:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["pair", "n"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged()], ["pair", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "pair long, n long")


def _vectors_added(counts: DataFrame, fan: int) -> DataFrame:
    def add(t: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x, "<i8") for x in t.column("counts").to_pylist()], axis=0, dtype="<i8")
        return pa.table({"segment": t.column("segment")[:1], "salt": t.column("salt")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    up = counts.withColumn("salt", F.floor(F.col("salt") / fan).cast("long"))
    return up.groupBy("segment", "salt").applyInArrow(add, "segment long, salt long, counts binary")


def counted(sums: DataFrame) -> tuple[DataFrame, int]:
    """segment, hash, pairs, counts (packed 64-bit integers in the hash's order) of all distinct pairs, and the number of segments."""
    sums = common.written(sums)
    pairs = common.written(sums.select("pair").distinct())
    n_segments = max(1, -(-pairs.count() // SEGMENT))
    segment = F.pmod(F.xxhash64("pair"), F.lit(n_segments)).alias("segment")

    def hashed(t: pa.Table) -> pa.Table:
        keys = t.column("pair").to_numpy()
        content = build(keys)
        ordered = np.empty(len(keys), "<i8")
        ordered[PerfectHash(content).index(keys)] = keys
        columns = {"segment": t.column("segment")[:1], "hash": pa.array([content], pa.binary()), "pairs": pa.array([ordered.tobytes()], pa.binary())}
        return pa.table(columns)

    hashes = common.written(pairs.select(segment, "pair").groupBy("segment").applyInArrow(hashed, "segment long, hash binary, pairs binary"))
    salts = max(1, -(-sums.count() // (SUMS * n_segments)))

    def dense(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = np.zeros(len(right.column("pairs")[0].as_py()) // 8, "<i8")
        np.add.at(out, PerfectHash(right.column("hash")[0].as_py()).index(left.column("pair").to_numpy()), left.column("n").to_numpy())
        return pa.table({"segment": right.column("segment"), "salt": right.column("salt"), "counts": pa.array([out.tobytes()], pa.binary())})

    salted = sums.select(segment, F.pmod(F.xxhash64("pair", "n", F.spark_partition_id()), F.lit(salts)).alias("salt"), "pair", "n")
    sides = hashes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    counts = salted.groupBy("segment", "salt").cogroup(sides.groupBy("segment", "salt")).applyInArrow(dense, "segment long, salt long, counts binary")
    while salts > 1:
        counts, salts = _vectors_added(counts, FAN), -(-salts // FAN)
    return common.written(hashes.join(counts.select("segment", "counts"), "segment")), n_segments


def highest(segments: DataFrame, width: int) -> np.ndarray:
    """Highest count of each id of B: as many numbers as B has ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = np.zeros(width, np.int64)
        for batch in batches:
            for pairs, counts in zip(batch.column("pairs").to_pylist(), batch.column("counts").to_pylist()):
                np.maximum.at(most, np.frombuffer(pairs, "<i8") % width, np.frombuffer(counts, "<i8"))
        seen = np.flatnonzero(most)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(most[seen])], ["b", "most"])

    top = segments.select("pairs", "counts").mapInArrow(run, "b long, most long").groupBy("b").agg(F.max("most").alias("most")).toArrow()
    out = np.zeros(width, np.int64)
    out[top.column("b").to_numpy()] = top.column("most").to_numpy()
    return out


class Counts:
    """Verified look-up of pairs in all segments, or in one. Segments stand one behind the other; `index` adds a segment's first place."""

    def __init__(self, rows: list[tuple[int, bytes, bytes, bytes]]) -> None:
        self.parts = {s: (PerfectHash(h), np.frombuffer(p, "<i8"), np.frombuffer(c, "<i8")) for s, h, p, c in rows}

    def of(self, pairs: np.ndarray, segments: np.ndarray) -> np.ndarray:
        out = np.zeros(len(pairs), np.int64)
        order = np.argsort(segments, kind="stable")
        first = np.flatnonzero(np.diff(segments[order], prepend=-1))
        for s, e in zip(first, np.append(first[1:], len(order))):
            at = order[s:e]
            hash_, keys, counts = self.parts[int(segments[at[0]])]
            place = hash_.index(pairs[at])
            if not np.array_equal(keys[place], pairs[at]):
                raise ValueError("a pair is not in its segment")
            out[at] = counts[place]
        return out


def _xxhash64(values: np.ndarray, seed: int = 42) -> np.ndarray:
    """Spark's xxhash64 of a long (fixed values of that hash), so that tasks find a pair's segment by themselves."""
    p1, p2, p3, p4, p5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rot = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = np.uint64(seed) + p5 + np.uint64(8)
        h = h ^ (rot(values.astype(np.uint64) * p2, 31) * p1)
        h = rot(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
        return (h ^ (h >> np.uint64(32))).view(np.int64)


def alignments(docs: DataFrame, path_a: str, path_b: str, sent: int = SENT) -> DataFrame:
    """`docs` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups (see the module's text)."""
    spark = docs.sparkSession
    content_a, content_b = vocabularies.sent_file(spark, path_a), vocabularies.sent_file(spark, path_b)
    width = len(vocabularies.loaded(vocabularies.Pieces, content_b.value).tokens)
    segments, n_segments = counted(pair_sums(docs, content_a, content_b))
    best = spark.sparkContext.broadcast(highest(segments, width))
    # The number of pairs is at most twice SEGMENT a segment but for chance; the broadcast is decided by it before anything is fetched.
    size = (segments.agg(F.sum(F.octet_length("pairs"))).first()[0] or 0) // 8 * PAIR_BYTES
    kept = [f for f in docs.schema if f.name not in COLUMNS]
    if size <= sent:
        t = segments.toArrow()
        table = spark.sparkContext.broadcast(list(zip(*(t.column(c).to_pylist() for c in ("segment", "hash", "pairs", "counts")))))
        return _looked_up(docs.select(*(F.col(f"`{f.name}`") for f in kept)), kept, content_a, content_b, best, table, n_segments)
    return _dealt(docs.select(*(F.col(f"`{f.name}`") for f in kept)), kept, content_a, content_b, best, segments, n_segments)


def _looked_up(docs, kept, content_a, content_b, best, table, n_segments) -> DataFrame:
    schema = T.StructType([*kept, *(T.StructField(c, T.LongType()) for c in COLUMNS[:-1]), T.StructField("groups", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, counts = _aligner(content_a, content_b), Counts(table.value)
        for piece in common.pieces(batches):
            x = aligner.align(piece.column("text").cast(pa.string()).to_pylist())
            pairs, back = np.unique(aligner.pairs(x), return_inverse=True)
            n = counts.of(pairs, np.mod(_xxhash64(pairs), n_segments))
            links = np.diff(x.rows_links)
            top = (n == best.value[pairs % aligner.width])[back]
            values = [np.diff(x.rows_a), np.diff(x.rows_b), links, links, per_text(top, x.rows_links), per_text(n[back], x.rows_links)]
            arrays = [*(pa.array(v.astype(np.int64)) for v in values), pa.array(aligner.groups(x), pa.string())]
            for name, value in zip(COLUMNS, arrays):
                piece = piece.append_column(name, value)
            yield from piece.to_batches()

    return docs.mapInArrow(run, schema)


def _dealt(docs, kept, content_a, content_b, best, segments, n_segments) -> DataFrame:
    """The second pass where the segments are too large to broadcast: links go to their segment's rows by a salted shuffle."""
    part = T.ArrayType(T.StructType([T.StructField("segment", T.LongType()), T.StructField("pairs", T.BinaryType()), T.StructField("times", T.BinaryType())]))
    plain = [T.StructField(c, T.LongType()) for c in COLUMNS[:4]] + [T.StructField("groups", T.StringType())]
    schema = T.StructType([*kept, T.StructField("__row", T.LongType()), *plain, T.StructField("__parts", part)])
    arrow = pa.list_(pa.struct([("segment", pa.int64()), ("pairs", pa.binary()), ("times", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(content_a, content_b)
        for piece in common.pieces(batches):
            x = aligner.align(piece.column("text").cast(pa.string()).to_pylist())
            pairs, parts = aligner.pairs(x), []
            for s, e in zip(x.rows_links[:-1], x.rows_links[1:]):
                own, times = np.unique(pairs[s:e], return_counts=True)
                segment = np.mod(_xxhash64(own), n_segments)
                order = np.argsort(segment, kind="stable")
                first = np.flatnonzero(np.diff(segment[order], prepend=-1))
                cuts = zip(first, np.append(first[1:], len(order)))
                parts.append([{"segment": int(segment[order[i]]), "pairs": own[order[i:j]].astype("<i8").tobytes(), "times": times[order[i:j]].astype("<i8").tobytes()} for i, j in cuts])
            links = np.diff(x.rows_links)
            values = [np.diff(x.rows_a), np.diff(x.rows_b), links, links]
            arrays = [*(pa.array(v.astype(np.int64)) for v in values), pa.array(aligner.groups(x), pa.string()), pa.array(parts, arrow)]
            for name, value in zip((*COLUMNS[:4], "groups", "__parts"), arrays):
                piece = piece.append_column(name, value)
            yield from piece.to_batches()

    # The row numbers hold because the rows are written before they are used twice.
    rows = common.written(docs.withColumn("__row", F.monotonically_increasing_id()).mapInArrow(run, schema))
    links = rows.select(F.col("__row").alias("row"), F.inline("__parts"))
    salts = max(1, -(-links.count() // (SUMS * n_segments)))
    salted = links.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)))
    sides = segments.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))

    def look(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("row", "n_best", "count_sum")})
        counts = Counts([tuple(right.column(c)[0].as_py() for c in ("segment", "hash", "pairs", "counts"))])
        lists = [[np.frombuffer(v, "<i8") for v in left.column(c).to_pylist()] for c in ("pairs", "times")]
        pairs, times = map(np.concatenate, lists)
        n = counts.of(pairs, np.full(len(pairs), right.column("segment")[0].as_py()))
        rows_ = np.concatenate([[0], np.cumsum([len(v) for v in lists[0]])])
        top = times * (n == best.value[pairs % len(best.value)])
        return pa.table({"row": left.column("row"), "n_best": pa.array(per_text(top, rows_)), "count_sum": pa.array(per_text(times * n, rows_))})

    found = salted.groupBy("segment", "salt").cogroup(sides.groupBy("segment", "salt")).applyInArrow(look, "row long, n_best long, count_sum long")
    total = found.groupBy(F.col("row").alias("__row")).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = rows.drop("__parts").join(total, "__row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return out.select(*(F.col(f"`{f.name}`") for f in kept), *COLUMNS[:4], zero("n_best"), zero("count_sum"), "groups")


def op11_align(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    found = alignments(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), *COLUMNS[:-1], digest.alias("groups_sha256"))


QUERIES = {"op11_align": op11_align}
ORACLE: dict[str, str] = {}
