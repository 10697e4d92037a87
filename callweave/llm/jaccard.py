"""Operator 7: n-gram Jaccard join by universe partitioning.

A document is its set of word n-grams. Sizes fall into bands so narrow that only equal or neighbouring bands can be similar. In a band's scheme
the hash space of n-grams is cut into segments; two sets of the scheme that reach the threshold differ in at most H elements, so of m segments
with d of them compared up to one element, some agree as soon as m + d exceeds H. Each set is indexed under its segments' subsets, and under the
one-deletion neighbourhood of the d segments; m and d are chosen by cost (index rows, and candidate pairs seen on a bounded sample) for each
band. There are enough segments for some spare agreements, so that a set's few empty segments need not be indexed; a set with more empty
segments than that indexes them all, so nothing is lost.

Candidates are then held against an exact bound from segment counts and verified exactly; components.grouped keeps their number near the size
of a group of near copies without losing a connection.

Sets are 64-bit hashes of n-grams; equal sets are one node. Null and wordless texts have the empty set, linked with nothing. A text of fewer
than n words is one n-gram. Rows of a null id are linked with nothing and have a null component. Repeated rows give repeated results; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm import common, components

_HASHER = common.Hasher(fold=True, seed=7)
#: Counters of the exact bound, one byte each.
COUNTERS = 64
#: Documents whose sets the cost model looks at.
SAMPLE = 1500
#: Weight of a candidate pair against an index row in the cost model.
PAIR_COST = 20.0


def shingles(texts: pa.ChunkedArray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of all rows, sorted within a row, and each row's first (one more entry than rows)."""
    words, rows = _HASHER.words(texts)
    count = np.diff(rows)
    grams = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    first = np.concatenate([[0], np.cumsum(grams)])
    row = np.repeat(np.arange(len(count)), grams)
    at = rows[row] + np.arange(first[-1]) - first[row]
    h = np.zeros(len(at), np.uint64)
    for k in range(n):
        there = k < count[row]
        h = np.where(there, common.mix(h + words[np.minimum(at + k, max(0, len(words) - 1))] * np.uint64(2 * k + 3)) if len(words) else h, h)
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[keep], row[keep]
    return h, np.searchsorted(row, np.arange(len(count) + 1))


class Scheme:
    """Size bands and, for each, the number of segments and of one-deletion segments."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.tops = [0]
        #: Band to (segments, one-deletion segments, spare agreements).
        self.plan: dict[int, tuple[int, int, int]] = {}

    def band(self, sizes: np.ndarray) -> np.ndarray:
        """Index of the band that holds each size; band k covers sizes tops[k-1]+1 to tops[k]."""
        most = int(sizes.max(initial=0))
        while self.tops[-1] < most:
            low = self.tops[-1] + 1
            self.tops.append(low * 100 // self.percent)
        return np.searchsorted(np.array(self.tops), sizes)

    def apart(self, band: int) -> int:
        """Most elements in which two sets differ that are similar, the smaller one of this band."""
        while len(self.tops) <= band:
            self.tops.append((self.tops[-1] + 1) * 100 // self.percent)
        small = self.tops[band]
        large = small * 100 // self.percent
        return (100 - self.percent) * (small + large) // (100 + self.percent)

    def option(self, band: int, d: int | None) -> tuple[int, int, int]:
        """Segments with d of them compared up to one element; None: all of them, as few as that allows."""
        need = self.apart(band) + 1
        if d is None:
            m = -(-need // 2)
            return m, m, 0
        spare, low = 0, self.tops[band - 1] + 1
        while True:
            m = max(need + spare + min(spare, d) - d, d, 1)
            # Empty segments of the smallest set: Poisson mean and a wide margin.
            empty = m * np.exp(-low / m)
            wanted = min(int(np.ceil(empty + 5 * empty**0.5 + 1)), need + 2)
            if wanted <= spare:
                return m, d, spare
            spare = wanted

    def of(self, band: int) -> tuple[int, int, int]:
        if band not in self.plan:
            self.plan[band] = self.option(band, 0)
        return self.plan[band]


def signatures(h: np.ndarray, first: np.ndarray, scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Index keys of all sets, and each set's first key. A set is indexed in its own band's scheme and in the one below."""
    sizes = np.diff(first)
    bands = scheme.band(sizes)
    keys, owner = [], []
    for shift in (0, 1):
        own = bands - shift
        for b in np.unique(own[(sizes > 0) & (own > 0)]):
            docs = np.flatnonzero((own == b) & (sizes > 0))
            m, d, spare = scheme.of(int(b))
            n = sizes[docs]
            of = np.repeat(np.arange(len(docs)), n)
            start = np.concatenate([[0], np.cumsum(n)])
            x = common.mix(h[first[docs][of] + np.arange(start[-1]) - start[of]])
            flat = of * m + (x % np.uint64(m)).astype(np.int64)
            value = common.mix(x + np.uint64(11))
            # Additive set hash: a subset's hash is the sum over its elements, so deleting one is a subtraction.
            order = np.argsort(flat, kind="stable")
            total = np.zeros(len(docs) * m, np.uint64)
            cuts = np.flatnonzero(np.diff(flat[order], prepend=-1))
            if len(cuts):
                total[flat[order][cuts]] = np.add.reduceat(value[order], cuts)
            filled = np.bincount(flat, minlength=len(docs) * m).reshape(len(docs), m) > 0
            # Empty exact segments are left out where a set has few of them.
            shown = filled | ((~filled[:, d:]).sum(1) > spare)[:, None] | (np.arange(m) < d)
            salt = common.mix(np.arange(m, dtype=np.uint64) + np.uint64(int(b) << 32))
            whole = common.mix(total.reshape(len(docs), m) + salt)
            r, c = np.nonzero(shown)
            keys.append(whole[r, c])
            owner.append(docs[r])
            if d:
                seg = flat % m
                part = np.flatnonzero(seg < d)
                keys.append(common.mix(total[flat[part]] - value[part] + salt[seg[part]]))
                owner.append(docs[of[part]])
    if not keys:
        return np.zeros(0, np.int64), np.zeros(len(sizes) + 1, np.int64)
    keys, owner = np.concatenate(keys), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return keys[order].view(np.int64), np.searchsorted(owner[order], np.arange(len(sizes) + 1))


def allocate(sets: list[np.ndarray], total: int, scheme: Scheme) -> Scheme:
    """Chooses each band's one-deletion segments by cost on sample sets, scaled to `total` sets. It never changes results."""
    if not sets:
        return scheme
    bands = scheme.band(np.array([len(s) for s in sets]))
    scale = max(1.0, total / len(sets))
    for b in np.unique(bands[bands > 0]):
        mine = [s for s, k in zip(sets, bands, strict=True) if k == b]
        h, first = np.concatenate(mine), np.concatenate([[0], np.cumsum([len(s) for s in mine])])
        costs = {}
        for d in (0, 1, 2, None):
            scheme.plan[int(b)] = option = scheme.option(int(b), d)
            keys, _ = signatures(h, first, scheme)
            _, times = np.unique(keys, return_counts=True)
            costs[option] = scale * len(keys) + PAIR_COST * scale**2 * float((times * (times - 1) // 2).sum())
        scheme.plan[int(b)] = min(costs, key=costs.get)
    return scheme


def _counters(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each set, how many elements fall into each of COUNTERS hash cells (at most 255 shown; a cell at 255 bounds nothing)."""
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    cell = (common.mix(h + np.uint64(5)) % np.uint64(COUNTERS)).astype(np.int64)
    counts = np.bincount(row * COUNTERS + cell, minlength=(len(first) - 1) * COUNTERS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, COUNTERS)


def indexed(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, node (64-bit hash of the set, null for the empty set), n, counters, keys: one row per document, written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    few = rows.where(F.length(F.trim("text")) > 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches):
            h, first = shingles(piece.column("text"), n)
            yield pa.RecordBatch.from_arrays([pa.array([h[a:b].view(np.int64) for a, b in zip(first, first[1:])], pa.list_(pa.int64()))], ["set"])

    sample = [np.asarray(r["set"], np.int64).view(np.uint64) for r in few.mapInArrow(sets_of, "set array<long>").toLocalIterator() if r["set"]]
    scheme = allocate(sample, rows.count(), Scheme(percent))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches):
            h, first = shingles(piece.column("text"), n)
            size = np.diff(first)
            keys, at = signatures(h, first, scheme)
            full = np.flatnonzero(size)
            node = np.zeros(len(size), np.uint64)
            if len(full):
                node[full] = np.add.reduceat(common.mix(h + np.uint64(3)), first[full])
            node = common.mix(node).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id").combine_chunks(),
                    pa.array(node, mask=(size == 0) | pc.is_null(piece.column("doc_id")).to_numpy()),
                    pa.array(size.astype(np.int64)),
                    pa.array([c.tobytes() for c in _counters(h, first)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(keys)),
                ],
                ["doc_id", "node", "n", "counters", "keys"],
            )

    return common.written(rows.mapInArrow(work, "doc_id long, node long, n long, counters binary, keys array<long>"))


def _possible(pairs: DataFrame, sized: DataFrame, percent: int) -> DataFrame:
    """Drops pairs that the sizes or the counters rule out: sum |x - y| never exceeds the true difference."""
    left = sized.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("counters").alias("ca"))
    right = sized.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("counters").alias("cb"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COUNTERS).astype(np.int16) for c in ("ca", "cb"))
            apart = np.where((x == 255) | (y == 255), 0, np.abs(x - y)).sum(1)
            ok = (100 + percent) * apart <= (100 - percent) * (batch.column("na").to_numpy() + batch.column("nb").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(ok))

    near = f"abs(na - nb) * {100 + percent} <= {100 - percent} * (na + nb)"
    return pairs.join(left, "a").join(right, "b").where(near).select("a", "b", "na", "nb", "ca", "cb").mapInArrow(work, "a long, b long")


def _verified(pairs: DataFrame, rows: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Pairs of nodes that truly reach the threshold; one document's text stands for a node."""
    used = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    shown = rows.join(used, "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(shown, "doc_id")
    # Should an id repeat with different texts, each text stands for the node that its own set has.
    texts = common.written(texts.select("node", "text"))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, "ta"):
            (ha, fa), (hb, fb) = (shingles(piece.column(c), n) for c in ("ta", "tb"))
            a, b = (piece.column(c).to_numpy() for c in ("a", "b"))
            ok = np.zeros(len(a), bool)
            for k in range(len(a)):
                x, y = ha[fa[k] : fa[k + 1]], hb[fb[k] : fb[k + 1]]
                if common.mix(common.mix(x + np.uint64(3)).sum(keepdims=True)).view(np.int64)[0] != a[k]:
                    continue
                if common.mix(common.mix(y + np.uint64(3)).sum(keepdims=True)).view(np.int64)[0] != b[k]:
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[k] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]).filter(pa.array(ok))

    return pairs.join(right, "b").join(left, "a").mapInArrow(work, "a long, b long").distinct()


def near_classes(docs: DataFrame, n: int = 5, percent: int = 80, passes: int = 1) -> DataFrame:
    """doc_id, n_shingles, component_id: the least doc_id reachable over pairs with 100 * intersection >= percent * union. The index goes
    through the shuffle in so many passes."""
    rows = indexed(docs, n, percent)
    index = rows.where("node IS NOT NULL").select(F.explode("keys").alias("key"), "node")
    sized = common.written(rows.where("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("size"), F.first("counters").alias("counters")))
    traits = sized.select("node", F.concat(F.unhex(F.lpad(F.hex("size"), 16, "0")), "counters").alias("trait"))

    def may(x: list[bytes], y: list[bytes]) -> np.ndarray:
        """Whether sizes and counters allow each pair to reach the threshold."""
        x, y = (np.frombuffer(b"".join(z), np.uint8).reshape(-1, 8 + COUNTERS) for z in (x, y))
        nx, ny = (np.ascontiguousarray(z[:, :8]).view(">i8").ravel().astype(np.int64) for z in (x, y))
        apart = np.abs(nx[:, None] - ny[None, :])
        full = x[:, None, 8:].astype(np.int16) - y[None, :, 8:].astype(np.int16)
        full[(x[:, None, 8:] == 255) | (y[None, :, 8:] == 255)] = 0
        return (100 + percent) * np.maximum(apart, np.abs(full).sum(2)) <= (100 - percent) * (nx[:, None] + ny[None, :])

    found = components.grouped(
        components.shared_keys(index, passes), lambda pairs: _verified(common.written(_possible(pairs, sized, percent)), rows, docs, n, percent), traits, may
    )

    named = rows.join(found, "node", "left").withColumn("class", F.coalesce("component", "node"))
    least = named.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    out = common.written(named.join(least, "class", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id")
    ))
    common.removed(rows, sized)
    return out


def op7_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_classes(common.table(spark, folder, "documents"), n=3, percent=90)


QUERIES = {"op7_jaccard": op7_jaccard}
ORACLE = {"op7_jaccard": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
c AS (SELECT list_sort(s) AS s, min(doc_id) AS rep, len(s) AS n FROM s GROUP BY ALL),
u AS (SELECT rep, n, unnest(s) AS g FROM c WHERE n > 0),
f AS (SELECT g, count(*) AS f FROM u GROUP BY g),
p AS (SELECT rep, n, g, row_number() OVER (PARTITION BY rep ORDER BY f, g) AS i FROM u JOIN f USING (g)),
q AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM p a JOIN p b ON a.g = b.g AND a.rep < b.rep
  WHERE a.i <= a.n - ceil(0.9 * a.n) + 1 AND b.i <= b.n - ceil(0.9 * b.n) + 1 AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n)),
l AS (SELECT a, b FROM (SELECT q.a, q.b, len(list_intersect(x.s, y.s)) AS k, x.n + y.n AS n FROM q JOIN c x ON x.rep = q.a JOIN c y ON y.rep = q.b) WHERE 100 * k >= 90 * (n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(x, y) AS (SELECT rep, rep FROM c WHERE n > 0 UNION SELECT r.x, e.b FROM r JOIN e ON r.y = e.a),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, CASE WHEN c.n = 0 THEN s.doc_id ELSE m.y END AS component_id
FROM s JOIN c ON list_sort(s.s) = c.s LEFT JOIN m ON m.x = c.rep"""}
