"""Operator 12: centroid clustering over whole numbers by an incremental distance matrix.

Every vector keeps its exact integer dot product with every centroid. When centroids move, only their components that changed are multiplied:
the change times the vector's component is added to the dot product; then the nearest centroid is found anew from
|c|^2 - 2 * dot (the vector's own |x|^2 is the same for all). Vectors, dot products and clusters are one row, written after every round to the
shared folder and read once more for the clusters' sums; the round before it is removed then. What comes to the driver is the sums: clusters
times components, whatever the number of vectors.

Kept are vectors of exactly `width` components, none null or non-finite, whose components stay within 2**LIMIT_BITS after scaling (beyond that a
squared distance is no long). Centroids start as the kept vectors of smallest sha256 of `salt:id`; ties (repeated ids) go by the components, and a
null id is the word null. With fewer vectors than centroids there are as many centroids as vectors. No vectors give no rows; repeated rows are
separate vectors. Other columns are not carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm import common

LIMIT_BITS = 27
#: Whole numbers that a double holds exactly.
EXACT = 1 << 53
STATE = "vec_id long, square long, vector binary, dots binary, cluster int"


@dataclass(frozen=True)
class Settings:
    clusters: int = 40
    width: int = 64
    scale: int = 256
    rounds: int = 5
    salt: str = "2"


def whole_numbers(vectors: DataFrame, s: Settings) -> DataFrame:
    """vec_id, vector: the kept vectors as packed little-endian 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            if isinstance(lists, pa.ExtensionArray):
                lists = lists.storage
            sizes = np.diff(lists.offsets.to_numpy())
            good = lists.is_valid().to_numpy(zero_copy_only=False) & (sizes == s.width)
            flat = lists.filter(pa.array(good)).flatten()
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, s.width)
            # A null component comes out as NaN.
            fine = np.isfinite(values).all(axis=1)
            scaled = np.floor(values[fine] * s.scale)
            low = (np.abs(scaled) <= 1 << LIMIT_BITS).all(axis=1)
            ids = batch.column("vec_id").filter(pa.array(good)).filter(pa.array(fine)).filter(pa.array(low))
            whole = scaled[low].astype("<i8")
            yield pa.RecordBatch.from_arrays([ids.cast(pa.int64()), pa.array([v.tobytes() for v in whole], pa.binary())], ["vec_id", "vector"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(run, "vec_id long, vector binary")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers; by doubles where these are exact."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def moved(state: DataFrame, before: np.ndarray | None, after: np.ndarray, s: Settings) -> DataFrame:
    """`state` with dot products and clusters of the centroids `after`. `before` is None in the first round: all components are new."""
    change = after if before is None else after - before
    sent = state.sparkSession.sparkContext.broadcast((change, (after * after).sum(axis=1)))
    first = before is None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        delta, squares = sent.value
        touched = np.flatnonzero(delta.any(axis=1))
        for batch in batches:
            x = _matrix(batch.column("vector"), s.width)
            if first:
                dots, own = _product(x, delta), (x * x).sum(axis=1)
            else:
                dots, own = _matrix(batch.column("dots"), len(delta)).copy(), batch.column("square").to_numpy()
                for k in touched:
                    at = np.flatnonzero(delta[k])
                    dots[:, k] += _product(x[:, at], delta[k : k + 1, at])[:, 0]
            # argmin takes the first of equal distances.
            cluster = np.argmin(squares[None, :] - 2 * dots, axis=1).astype(np.int32)
            arrays = [batch.column("vec_id"), pa.array(own, pa.int64()), batch.column("vector"), pa.array([d.tobytes() for d in dots], pa.binary()), pa.array(cluster)]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "square", "vector", "dots", "cluster"])

    return state.mapInArrow(run, STATE)


def _sums(state: DataFrame, clusters: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Component sums and sizes of the clusters, exact: a task's sums stay far inside a long, those over tasks are decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = np.zeros((clusters, s.width), np.int64), np.zeros(clusters, np.int64)
        for batch in batches:
            x, c = _matrix(batch.column("vector"), s.width), batch.column("cluster").to_numpy()
            order = np.argsort(c, kind="stable")
            first = np.flatnonzero(np.diff(c[order], prepend=-1))
            if len(first):
                total[c[order][first]] += np.add.reduceat(x[order], first, axis=0)
                size += np.bincount(c, minlength=clusters)
        k = np.flatnonzero(size)
        rows = np.concatenate([total[k], size[k, None]], axis=1)
        ids = [np.repeat(k, s.width + 1), np.tile(np.arange(s.width + 1), len(k)), rows.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(v.astype(np.int64)) for v in ids], ["cluster", "component", "n"])

    partial = state.select("vector", "cluster").mapInArrow(run, "cluster long, component long, n long")
    found = partial.groupBy("cluster", "component").agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n")).collect()
    out = np.zeros((clusters, s.width + 1), object)
    for r in found:
        out[r.cluster, r.component] = int(r.n)
    return out[:, : s.width], out[:, s.width]


def starting(vectors: DataFrame, s: Settings) -> np.ndarray:
    """The first centroids: at most `clusters` rows, found by their hash."""
    key = F.sha2(F.concat(F.lit(f"{s.salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))).cast("binary"), 256)
    rows = vectors.select(key.alias("key"), "vector").orderBy("key", "vector").limit(s.clusters).collect()
    return np.array([np.frombuffer(bytes(r.vector), "<i8") for r in rows], np.int64).reshape(-1, s.width)


def clustered(vectors: DataFrame, s: Settings = Settings()) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every kept vector, and the final centroids."""
    spark = vectors.sparkSession
    state = common.written(whole_numbers(vectors, s))
    old, now = None, starting(state, s)
    if not len(now):
        return state.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), now
    for turn in range(s.rounds + 1):
        fresh = common.written(moved(state, old, now, s), compression="zstd")
        common.removed(state)
        state = fresh
        if turn < s.rounds:
            total, size = _sums(state, len(now), s)
            old, now = now, np.array([[t // n for t in row] if n else list(c) for row, n, c in zip(total, size, now)], np.int64)
    sent = spark.sparkContext.broadcast((now * now).sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dots, c = _matrix(batch.column("dots"), len(sent.value)), batch.column("cluster").to_numpy()
            distance = batch.column("square").to_numpy() - 2 * dots[np.arange(len(c)), c] + sent.value[c]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("cluster"), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"])

    return state.mapInArrow(run, "vec_id long, cluster int, distance long"), now


def described(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds cluster_inertia, inertia and centroid_sha256. There is one row per centroid, so that table is joined as it is; sums that
    leave a long are null."""
    spark = rows.sparkSession
    rows = common.written(rows)
    digests = [(k, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for k, c in enumerate(centroids)]
    names = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own"))
    total = sums.agg(F.sum("own").alias("all"))
    long = lambda c: F.expr(f"try_cast({c} AS long)")
    each = sums.crossJoin(F.broadcast(total)).join(names, "cluster")
    each = each.select("cluster", long("own").alias("cluster_inertia"), long("all").alias("inertia"), "centroid_sha256")
    return rows.join(F.broadcast(each), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return described(*clustered(common.table(spark, folder, "embeddings")))


def _sql(s: Settings = Settings()) -> str:
    """DuckDB form: every round's distances in full. Sums of products of such numbers are exact in doubles."""
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, [floor(x::DOUBLE * {s.scale}) for x in embedding] AS x FROM embeddings"
        f" WHERE len(embedding) = {s.width} AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{s.salt}:' || vec_id), x) - 1 AS k, x AS c FROM v"
        f" QUALIFY k < {s.clusters})",
    ]
    for t in range(s.rounds + 1):
        parts.append(
            f"a{t} AS MATERIALIZED (SELECT vec_id, x, arg_min(k, d * {s.clusters} + k) AS k, min(d) AS d FROM (SELECT vec_id, x, row, k,"
            " list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c) AS d"
            f" FROM (SELECT *, row_number() OVER () AS row FROM v), c{t}) GROUP BY vec_id, x, row)"
        )
        if t < s.rounds:
            means = ", ".join(f"floor(sum(x[{j}]) / count(*))" for j in range(1, s.width + 1))
            parts.append(f"m{t} AS (SELECT k, [{means}] AS c FROM a{t} GROUP BY k)")
            parts.append(f"c{t + 1} AS MATERIALIZED (SELECT k, coalesce(m{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN m{t} USING (k))")
    last = s.rounds
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT vec_id, k::INT AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia,"
        " (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string([x::BIGINT for x in c], ',')) AS centroid_sha256"
        f" FROM a{last} JOIN c{last} USING (k)"
    )


QUERIES = {"op12_clusters": op12_clusters}
ORACLE = {"op12_clusters": _sql()}
