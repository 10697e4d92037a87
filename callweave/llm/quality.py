"""Operator 6: quality classifier from supervised subword embeddings.

A text is the multiset of its words, of the byte n-grams inside words (with marks at word ends) and, for each of the `lags`, of a token for
every word that equals the word so many places before it; each is hashed to one of 2**bits vectors.
The mean vector goes through a softmax layer; vectors and layer are learnt together by mini-batch stochastic gradient descent in numpy.
Because the layer is linear in the mean, a learnt model is kept as one log-odds weight per bucket and scores texts of any length whole.

Learning takes a bounded, documented sample: `max_rows` labelled documents, those of the smallest hash of the id, as long as together they
have `max_features` distinct features of a text at most (8 bytes each at the driver). Scores see the text only.
Texts without words score by the bias alone. Null texts are empty. Null ids are scored but never learnt from; repeated rows give repeated
results; without usable labels every score is 0.5 (predicted 1: nothing is rejected unlearnt). Other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm import common


@dataclass(frozen=True)
class Settings:
    bits: int = 17
    grams: tuple[int, ...] = (3, 4)
    lags: tuple[int, ...] = (1, 2, 3)
    width: int = 8
    max_rows: int = 4000
    max_features: int = 16_000_000
    epochs: int = 6
    batch: int = 32
    rate: float = 0.5
    seed: int = 7


_HASHER = common.Hasher(fold=True, seed=6)


def features(texts: pa.ChunkedArray, s: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For the words, each n-gram length and each lag: bucket of every feature, and each row's first feature (one more entry than rows)."""
    data, offsets = common.flat(texts)
    sums = _HASHER.sums(data)
    starts, ends, rows = _HASHER.word_bounds(data, offsets)
    shift = np.uint64(64 - s.bits)
    words = _HASHER.runs(sums, starts, ends)
    yield (words >> shift).astype(np.int64), rows
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    for lag in s.lags:
        again = np.flatnonzero((words[lag:] == words[: max(0, len(words) - lag)]) & (row[lag:] == row[: max(0, len(words) - lag)]))
        yield np.full(len(again), lag, np.int64), np.searchsorted(again + lag, rows)
    for n in s.grams:
        # Runs of n bytes of a word; one that opens or closes the word is told apart by its marks.
        count = np.maximum(ends - starts - n + 1, 0)
        first = np.concatenate([[0], np.cumsum(count)])
        word = np.repeat(np.arange(len(starts)), count)
        at = np.arange(first[-1]) - first[word] + starts[word]
        edge = (at == starts[word]).astype(np.uint64) + np.uint64(2) * (at + n == ends[word])
        h = _HASHER.runs(sums, at, at + n) + edge * np.uint64(0x632BE59BD9B4E019) + np.uint64(n)
        yield (common.mix(h) >> shift).astype(np.int64), first[rows]


def _bags(texts: pa.ChunkedArray, s: Settings) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and counts of each text."""
    parts = list(features(texts, s))
    return [np.unique(np.concatenate([b[r[k] : r[k + 1]] for b, r in parts]), return_counts=True) for k in range(len(texts))]


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, float]:
    """Log-odds weight per bucket and the bias. Deterministic for given rows in a given order."""
    draw = np.random.default_rng(s.seed)
    vectors = draw.uniform(-1 / s.width, 1 / s.width, (1 << s.bits, s.width)).astype(np.float32)
    layer, bias = np.zeros((s.width, 2), np.float32), np.zeros(2, np.float32)
    n, steps = len(bags), 0
    total = max(1, s.epochs * -(-n // s.batch))
    means = [c.astype(np.float32) / max(1, c.sum()) for _, c in bags]
    for _ in range(s.epochs):
        order = draw.permutation(n)
        for lo in range(0, n, s.batch):
            pick = order[lo : lo + s.batch]
            rate = s.rate * (1 - steps / total)
            steps += 1
            mean = np.stack([means[i] @ vectors[bags[i][0]] for i in pick])
            z = mean @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            back = p @ layer.T
            layer -= rate * (mean.T @ p)
            bias -= rate * p.sum(0) * 0.1
            for k, i in enumerate(pick):
                # Mean pooling makes each vector's share small; the step is scaled by the vectors a text has.
                vectors[bags[i][0]] -= rate * len(bags[i][0]) ** 0.5 * means[i][:, None] * back[k]
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def learning_row(doc_id: Column) -> Column:
    """True where a row's label may be learnt from: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(common.key_of(doc_id) % 3 != 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Learns from at most `max_rows` labelled documents outside the held-out fold."""
    marks = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .where(F.col("quality").isin(0, 1) & learning_row(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.max_rows)
    )
    # The left side has max_rows rows at most whatever the input, so it may be broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    schema = "doc_id long, quality int, digest long, buckets array<int>, counts array<int>"

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches):
            found = _bags(piece.column("text"), s)
            lists = [pa.array([x[k].astype(np.int32) for x in found], pa.list_(pa.int32())) for k in (0, 1)]
            digest = pa.array([int(common.mix(b.astype(np.uint64) * np.uint64(31) + c.astype(np.uint64)).sum() >> np.uint64(1)) for b, c in found])
            yield from pa.table([piece.column("doc_id").combine_chunks(), piece.column("quality").combine_chunks(), digest, *lists], schema_names).to_batches()

    schema_names = ["doc_id", "quality", "digest", "buckets", "counts"]
    found = common.written(rows.mapInArrow(bags, schema))
    # Sizes first: the rows that come to the driver are bounded by features as well as in number.
    sizes = found.groupBy("doc_id").agg(F.min_by(F.struct("digest", F.size("buckets").alias("n")), "digest").alias("x"))
    upto = F.sum("x.n").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    taken = sizes.withColumn("upto", upto).where(F.col("upto") <= s.max_features).select("doc_id", "x.digest")
    sample = found.join(F.broadcast(taken), ["doc_id", "digest"]).toArrow().sort_by([("doc_id", "ascending")])
    first = np.unique(sample.column("doc_id").to_numpy(), return_index=True)[1]
    sample = sample.take(pa.array(first))
    quality = sample.column("quality").to_numpy().astype(np.int64)
    if len(set(quality)) < 2:
        return np.zeros(1 << s.bits, np.float32), 0.0
    lists = ([np.asarray(x.values, np.int32) for x in sample.column(c)] for c in ("buckets", "counts"))
    return train(list(zip(*lists, strict=True)), quality, s)


def score(docs: DataFrame, model: tuple[np.ndarray, float], s: Settings = Settings(), out: str = "score") -> DataFrame:
    """Adds the probability of label 1. The model has 2**bits weights whatever the corpus, so it is broadcast."""
    schema = T.StructType([f for f in docs.schema if f.name != out] + [T.StructField(out, T.DoubleType())])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = sent.value
        for piece in common.pieces(batches):
            total, count = np.zeros(piece.num_rows), np.zeros(piece.num_rows)
            for buckets, rows in features(piece.column("text"), s):
                # Summed row by row: equal texts then get equal scores wherever they stand.
                got = weights[buckets]
                full = np.flatnonzero(np.diff(rows))
                if len(full):
                    total[full] += np.add.reduceat(got.astype(np.float64), rows[full])
                count += np.diff(rows)
            p = 1 / (1 + np.exp(-(total / np.maximum(count, 1) + bias)))
            kept = [c for c in piece.column_names if c != out]
            yield from piece.select(kept).append_column(out, pa.array(p)).to_batches()

    return docs.mapInArrow(run, schema)


def classified(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Documents with `score` and `predicted` (1 where the score is 0.5 or more)."""
    return score(docs, fit(docs, labels, s), s).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, common.table(spark, folder, "labels"))).drop("text")
    held = F.coalesce(common.key_of(F.col("doc_id")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op6_quality": op6_quality}
ORACLE: dict[str, str] = {}
