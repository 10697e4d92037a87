"""Operator 13: token ids in files, each a compressed wavelet matrix (see `wavelet.py`) that is also read by position and by token.

Texts are encoded whole with the ids of the `tokenizers` library's file (see `vocabularies.py`), the end id is appended, and documents are dealt in ascending order of their id
(null first; repeated ids by the text's hash, then by row) to ranges. A range's documents are written one after the other; a file ends with
the document that brings it to `FILE_TOKENS` ids. Each file is one row, and one Parquet file, of a table in the shared folder: range, its
number in the range, number of ids, content. It holds the documents' ids and first positions as well.

Positions over all files are sums over ranges (one row per range), then inside each range. Null and empty texts are the end id alone; a
table without rows gives no files; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callweave.llm import common, vocabularies
from callweave.llm.wavelet import WaveletMatrix, Writer

FILE_TOKENS = 1 << 21
END = 2
FILES = "part long, number long, n_tokens long, content binary"


def encoded(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id, mark (hash of the text), ids (packed unsigned integers of 16 bits, or of 32 where the vocabulary is larger), n_tokens."""
    content = vocabularies.sent_file(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabularies.loaded(vocabularies.ByteLevel, content.value)
        kind = "<u2" if max(len(coder.tokens) - 1, end) < 1 << 16 else "<u4"
        for piece in common.pieces(batches):
            last, width = np.array([end], kind).tobytes(), np.dtype(kind).itemsize
            ids = [coder.encode_as_library(t).astype(kind).tobytes() + last if t else last for t in piece.column("text").to_pylist()]
            columns = [piece.column("doc_id"), piece.column("mark"), pa.array(ids, pa.binary()), pa.array([len(x) // width for x in ids], pa.int64())]
            yield from pa.table(columns, ["doc_id", "mark", "ids", "n_tokens"]).to_batches()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(common.whole(F.col("text"))).alias("mark"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, ids binary, n_tokens long")


def files(docs: DataFrame, path: str, end: int = END, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Writes the files and returns their table: part, number, n_tokens, content."""
    rows = common.written(encoded(docs, path, end).withColumn("row", F.monotonically_increasing_id()), compression="zstd")
    n = rows.agg(F.sum("n_tokens")).first()[0] or 0
    parts = max(1, -(-n // file_tokens))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, writer = TaskContext.get().partitionId(), 0, Writer()

        def done() -> pa.RecordBatch:
            columns = [pa.array([x], pa.int64()) for x in (part, number, writer.size)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([writer.content()], pa.binary())], ["part", "number", "n_tokens", "content"])

        for batch in batches:
            for doc_id, ids, size in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ids", "n_tokens"))):
                writer.add(doc_id, np.frombuffer(ids, f"<u{len(ids) // size}").astype(np.uint32))
                if writer.size >= file_tokens:
                    yield done()
                    number, writer = number + 1, Writer()
        if writer.size:
            yield done()

    # The row number last: a repeated document is dealt to several ranges as well.
    order = ["doc_id", "mark", "row"]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    out = common.written(ranged.select("doc_id", "ids", "n_tokens").mapInArrow(run, FILES), maxRecordsPerFile=1, compression="none")
    common.removed(rows)
    return out


def offsets(table: DataFrame) -> DataFrame:
    """part, number, base: ids of all files before it. One window runs over ranges, one inside each."""
    sizes = table.select("part", "number", "n_tokens")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select("part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    own = sizes.select("part", "number", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)).alias("own"))
    return own.join(parts, "part").select("part", "number", (F.col("first") + F.col("own")).alias("base"))


def documents(table: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids (packed 32-bit) of every document, read back from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                matrix = WaveletMatrix(batch.column("content")[k].as_py())
                ids, starts = matrix.everything().astype("<u4"), matrix.starts
                for at in range(0, len(matrix.docs), 256):
                    to = min(at + 256, len(matrix.docs))
                    where = [np.full(to - at, batch.column(c)[k].as_py()) for c in ("part", "number")]
                    columns = [*where, pa.array(matrix.docs[at:to], pa.int64()), starts[at:to], np.diff(starts[at : to + 1])]
                    content = [ids[s:e].tobytes() for s, e in zip(starts[at:to], starts[at + 1 : to + 1])]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(content, pa.binary())], ["part", "number", "doc_id", "local", "n_tokens", "ids"])

    return table.mapInArrow(run, "part long, number long, doc_id long, local long, n_tokens long, ids binary")


def token_counts(table: DataFrame, tokens: list[int]) -> DataFrame:
    """token, n: occurrences over all files, by rank."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(tokens), np.int64)
        for batch in batches:
            for content in batch.column("content").to_pylist():
                matrix = WaveletMatrix(content)
                total += [matrix.count(t) for t in tokens]
        yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(total)], ["token", "n"])

    return table.select("content").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(table: DataFrame, tokens: list[int]) -> DataFrame:
    """token, position: every place over all files, by select."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                matrix = WaveletMatrix(batch.column("content")[k].as_py())
                for t in tokens:
                    at = matrix.positions(t)
                    where = [np.full(len(at), x) for x in (batch.column("part")[k].as_py(), batch.column("number")[k].as_py(), t)]
                    yield pa.RecordBatch.from_arrays([*(pa.array(w, pa.int64()) for w in where), pa.array(at, pa.int64())], ["part", "number", "token", "local"])

    found = table.select("part", "number", "content").mapInArrow(run, "part long, number long, token long, local long")
    return found.join(offsets(table), ["part", "number"]).select("token", (F.col("base") + F.col("local")).alias("position"))


def tokens_at(table: DataFrame, positions: DataFrame) -> DataFrame:
    """position, token for a table of positions: each goes to the file it lies in, by slots of FILE_TOKENS positions, and is read by access."""
    base = offsets(table).join(table.select("part", "number", "n_tokens"), ["part", "number"])
    step = F.lit(FILE_TOKENS)
    last = F.col("base") + F.col("n_tokens") - 1
    spans = base.withColumn("slot", F.explode(F.sequence(F.floor(F.col("base") / step), F.floor(last / step))))
    wanted = positions.select("position").distinct().withColumn("slot", F.floor(F.col("position") / step))
    inside = (F.col("position") >= F.col("base")) & (F.col("position") <= last)
    found = wanted.join(spans, "slot").where(inside).groupBy("part", "number").agg(F.collect_list(F.struct("position", (F.col("position") - F.col("base")).alias("local"))).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                matrix, want = WaveletMatrix(batch.column("content")[k].as_py()), batch.column("wanted")[k].values
                got = [matrix.access(i) for i in want.field("local").to_pylist()]
                yield pa.RecordBatch.from_arrays([want.field("position"), pa.array(got, pa.int64())], ["position", "token"])

    return table.join(found, ["part", "number"]).select("content", "wanted").mapInArrow(run, "position long, token long")


def op13_wavelet(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    table = files(common.table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    rows = documents(table).select("part", "number", "doc_id", "local", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    out = rows.join(offsets(table), ["part", "number"])
    return out.select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


QUERIES = {"op13_wavelet": op13_wavelet}
ORACLE: dict[str, str] = {}
