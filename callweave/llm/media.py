"""Operator 4: media columns of progressive JPEG.

`stored` keeps a payload losslessly in a picture: its bytes, less 128, are the quantised coefficients of 8x8 blocks (one byte a coefficient, in
zigzag order; step 1), written in spectral-selection and successive-approximation scans. `loaded` reads any progressive JPEG: it accumulates
the scans into coefficient arrays, returns the payload that they hold, inverse-transforms them, raises chroma to full resolution and gives the
RGB tensor and a feature of it. A payload is the text's UTF-8 bytes with zeros up to a positive multiple of 64.

Null texts are empty: 64 zero bytes. Null ids and repeated rows stay as they are; equal texts give equal files, tensors and features. An empty
table gives an empty table; other columns pass through, those named like results are replaced. A null or foreign medium gives null results where
it has no payload comment, and a null medium nulls throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm import common, jpeg

BLOCK = 64
NOTE = b"payload "


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % BLOCK if raw else BLOCK)


def pictures(payloads: list[bytes]) -> list[bytes]:
    """A picture for each payload of whole blocks; blocks past its end are zero."""
    grid = jpeg.Grid.fitting(np.array([len(p) // BLOCK for p in payloads], np.int64))
    flat = np.full(int(grid.first[-1]) * BLOCK, 128, np.uint8)
    for first, p in zip(grid.first, payloads):
        flat[first * BLOCK : first * BLOCK + len(p)] = np.frombuffer(p, np.uint8)
    rows = np.ascontiguousarray((flat.astype(np.int16) - 128).reshape(-1, BLOCK).T)
    return jpeg.encode(rows, grid, [NOTE + str(len(p)).encode() for p in payloads])


def payload(x: jpeg.Decoded) -> bytes | None:
    """The bytes that a picture of `pictures` holds."""
    if not x.parsed.comment.startswith(NOTE):
        return None
    values = np.concatenate(x.rows, 1).T + 128
    return values.astype(np.uint8).tobytes()[: int(x.parsed.comment[len(NOTE) :])]


def feature(rgb: np.ndarray) -> str:
    """Size, channel means and deviations, and a hash of 64 brightness cells against their mean."""
    grey = rgb.mean(2)
    rows, cols = (np.linspace(0, n, 9).astype(int)[:-1] for n in grey.shape)
    cells = np.add.reduceat(np.add.reduceat(grey, rows, 0), cols, 1)
    sizes = np.diff(np.append(rows, grey.shape[0]))[:, None] * np.diff(np.append(cols, grey.shape[1]))
    cells = cells / sizes
    marks = np.packbits((cells > cells.mean()).ravel()).tobytes().hex()
    flat = rgb.reshape(-1, 3)
    stats = [f"{v:.3f}" for v in (*flat.mean(0), *flat.std(0))]
    return ":".join([f"{rgb.shape[1]}x{rgb.shape[0]}", *stats, marks])


def stored(docs: DataFrame, text: str = "text", out: str = "media") -> DataFrame:
    """Adds `out`: the picture that holds the text's payload."""
    schema = T.StructType([f for f in docs.schema if f.name != out] + [T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, text):
            made = pictures([padded((x or "").encode()) for x in piece.column(text).to_pylist()])
            kept = [c for c in piece.column_names if c != out]
            yield from piece.select(kept).append_column(out, pa.array(made, pa.binary())).to_batches()

    return docs.mapInArrow(run, schema)


def loaded(df: DataFrame, media: str = "media", tensor: bool = True) -> DataFrame:
    """Adds payload, height, width, feature and, with `tensor`, rgb: height x width x 3 bytes in row order."""
    fields = [("payload", T.BinaryType(), pa.binary()), ("height", T.IntegerType(), pa.int32()), ("width", T.IntegerType(), pa.int32()), ("feature", T.StringType(), pa.string())]
    fields += [("rgb", T.BinaryType(), pa.binary())] * tensor
    names = [f[0] for f in fields]
    schema = T.StructType([f for f in df.schema if f.name not in names] + [T.StructField(n, t) for n, t, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, media):
            files = piece.column(media).to_pylist()
            there = [k for k, x in enumerate(files) if x is not None]
            values: list[list] = [[None] * len(files) for _ in names]
            for k, x in zip(there, jpeg.decode([files[k] for k in there]), strict=True):
                rgb = jpeg.to_rgb(x)
                row = [payload(x), x.parsed.height, x.parsed.width, feature(rgb), rgb.tobytes() if tensor else None]
                for column, value in zip(values, row):
                    column[k] = value
            kept = piece.select([c for c in piece.column_names if c not in names])
            for (name, _, arrow), column in zip(fields, values, strict=True):
                kept = kept.append_column(name, pa.array(column, arrow))
            yield from kept.to_batches()

    return df.mapInArrow(run, schema)


def op4_jpeg(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    rows = loaded(stored(docs).select("doc_id", F.octet_length(common.whole(F.col("text"))).cast("long").alias("n_bytes"), "media"), tensor=False)
    return rows.select(
        "doc_id", "n_bytes",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -BLOCK, BLOCK)).alias("tail_crc32"),
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        "feature",
    )


QUERIES = {"op4_jpeg": op4_jpeg}
ORACLE: dict[str, str] = {}
