"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = r"[\x20\x09-\x0D]+"
#: Text bytes that a Python task works on at a time; a longer document is a piece of its own.
PIECE_BYTES = 1 << 21


def settings(spark: SparkSession) -> SparkSession:
    """Arrow batches are kept short because rows are whole documents; a finished step's shuffle files go."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    settings(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole(text: Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Runs of characters other than space and x09 to x0D."""
    parts = F.split(F.concat(F.lit(" "), whole(text), F.lit(" ")), SPACE)
    return (F.size(parts) - 2).cast("long")


def key_of(doc_id: Column) -> Column:
    """crc32 of the id as text; null ids give null."""
    return F.crc32(doc_id.cast("string").cast("binary"))


def named(docs: DataFrame) -> DataFrame:
    """Adds `id` (doc_id as text, never null) and `mark` (hash of the text): the identity of a document where ids repeat or are null.
    Rows equal in both are one document."""
    return docs.withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).withColumn("mark", F.xxhash64(whole(F.col("text"))))


def session_folder(spark: SparkSession) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    from uuid import uuid4

    from callweave.session import shared_folder

    return f"{shared_folder(spark).rstrip('/')}/llm-{uuid4().hex}"


def written(df: DataFrame, partition_by: list[str] | None = None, **options) -> DataFrame:
    """The rows as a Parquet table in the shared folder: cuts lineage, survives lost executors, computed once."""
    path = session_folder(df.sparkSession)
    writer = df.write.options(**options)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = df.sparkSession.read.parquet(path)
    _FOLDERS[id(out)] = weakref.ref(out), path
    return out


_FOLDERS: dict[int, tuple] = {}


def removed(*tables: DataFrame) -> None:
    """Deletes the folders of tables made by `written` that nothing reads any more; other tables are left alone."""
    for df in tables:
        ref, path = _FOLDERS.pop(id(df), (lambda: None, ""))
        if ref() is not df:
            continue
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def flat(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.Table]:
    """Runs of rows with about `size` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
            yield pa.Table.from_batches([batch.slice(start, stop - start)])
            start = stop


class Hasher:
    """64-bit hashes of words and of byte runs, for a whole column at once.

    A run's hash is a polynomial over a fixed random table of bytes, taken from prefix sums, then mixed. `fold` makes A-Z equal a-z.
    """

    RATE = 0x9E3779B97F4A7C15

    def __init__(self, fold: bool = True, seed: int = 20) -> None:
        self.values = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold:
            self.values[65:91] = self.values[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.up = self.down = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            for name, rate in (("up", self.RATE), ("down", pow(self.RATE, -1, 1 << 64))):
                run = np.full(n, rate, np.uint64)
                run[0] = 1
                setattr(self, name, np.cumprod(run))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._powers(max(1, len(data)))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.down[starts])

    def word_bounds(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of words, and for each row the index of its first word (one more entry than rows)."""
        n = len(data)
        word = ~self.space[data]
        begins = np.zeros(n + 1, bool)
        begins[offsets] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | begins[1:n]
        last[:-1] &= ~word[1:] | begins[1:n]
        starts = np.flatnonzero(first)
        return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)

    def words(self, texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word of a column, and each row's first word index (one more entry than rows)."""
        data, offsets = flat(texts)
        starts, ends, rows = self.word_bounds(data, offsets)
        return self.runs(self.sums(data), starts, ends), rows


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
