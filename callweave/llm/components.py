"""Links between the members of groups, and connected components by alternating large-star and small-star steps, each a grouped minimum and a join."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callweave.llm import common


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """Points each node's neighbours at the least of the neighbourhood: the larger ones (large star), or the smaller ones and itself (small star)."""
    if small:
        sides = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = sides.join(least, "u")
    if small:
        out = met.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a != b").distinct()


def _settled(edges: DataFrame) -> bool:
    """True where every node on the larger side of an edge has one edge and is on no smaller side: each component is a star."""
    sides = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    sides = sides.unionByName(edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return sides.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up > 0 AND down > 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node reachable) of every node on an edge. `edges` has long columns a and b; loops and repeats do no harm.

    Each round is a table in the shared folder; only whether it is the last comes to the driver.
    """
    now = common.written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct())
    while not _settled(now):
        before, now = now, common.written(_stars(_stars(now, small=False), small=True))
        common.removed(before)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


#: Members of a key that one task puts in order to find chain partners; larger keys are salted.
CHAIN = 512
#: Members of a key that are compared with so many others at a time.
CHUNK = 256


def shared_keys(index: DataFrame, passes: int = 1) -> DataFrame:
    """key, node, hub, times of the keys that several nodes have; hub is a key's least node. `index` has long columns key and node, keys being hashes.

    Most keys have one node. The grouped minimum combines before its shuffle, so a key of very many rows is no single task's. With several
    `passes` each takes its share of the keys, so that no shuffle holds the whole index.
    """
    shares = []
    for k in range(passes):
        part = index if passes == 1 else index.where(F.pmod("key", F.lit(passes)) == k)
        hubs = part.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"), F.count(F.lit(1)).alias("times"))
        hubs = common.written(hubs.where("hub != last").select("key", "hub", "times"))
        shares.append(common.written(part.join(hubs, "key").select("key", "node", "hub", "times").distinct()))
        common.removed(hubs)
    if passes == 1:
        return shares[0]
    every = common.written(reduce(DataFrame.unionByName, shares))
    common.removed(*shares)
    return every


def chained(members: DataFrame, seed: int) -> DataFrame:
    """Every member of a key with the next one in a random order of the key's own: about as many pairs as members."""
    draw = F.xxhash64("key", "node", F.lit(seed))
    salted = members.withColumn("draw", draw).withColumn("salt", F.pmod(draw, F.ceil(F.col("times") / CHAIN)))
    after = Window.partitionBy("key", "salt").orderBy(F.xxhash64("draw"), "node")
    columns = [c for c in ("component",) if c in members.columns]
    pairs = salted.select("node", *columns, F.lead("node").over(after).alias("other"), *(F.lead(c).over(after).alias(f"other_{c}") for c in columns))
    pairs = pairs.where("other IS NOT NULL")
    if columns:
        pairs = pairs.where("component != other_component")
    return pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def split(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members, with their components, of the keys that still hold several; a node on no link is its own component."""
    member = shared.join(found, "node", "left").select("key", "node", "hub", "times", F.coalesce("component", "node").alias("component"))
    member = common.written(member)
    split = member.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("key")
    out = common.written(member.join(split, "key"))
    common.removed(member)
    return out


def _sooner(x: pa.ListArray, y: pa.ListArray, key: int) -> np.ndarray:
    """Matrix that says which lists of `x` and of `y` have a key below `key` in common."""
    sides = []
    for lists in (x, y):
        keys, row = np.asarray(lists.flatten()), np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths()))
        sides.append((keys[keys < key], row[keys < key], len(lists)))
    common_ = np.intersect1d(sides[0][0], sides[1][0])
    has = []
    for keys, row, size in sides:
        at = np.minimum(np.searchsorted(common_, keys), max(len(common_) - 1, 0))
        hit = common_[at] == keys if len(common_) else np.zeros(len(keys), bool)
        has.append(np.zeros((size, len(common_)), np.float32))
        has[-1][row[hit], at[hit]] = 1
    return has[0] @ has[1].T > 0


def crossed(rest: DataFrame, traits: DataFrame, may: Callable) -> DataFrame:
    """Pairs of nodes of different components with a common key that `may` be linked by their traits.

    A key's members are dealt into chunks of about CHUNK; a task compares two chunks and gives only what `may` leaves, each pair under its
    least common key, so the pairs of a large group are never rows. `may` takes two arrays of traits (bytes) and returns a matrix.
    """
    own = rest.groupBy("node").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    rows = rest.select("key", "node", "component", "times").join(traits, "node").join(own, "node")
    chunk = F.pmod(F.xxhash64("node", "key"), F.ceil(F.col("times") / CHUNK))
    dealt = rows.groupBy("key", chunk.alias("chunk")).agg(F.collect_list(F.struct("node", "component", "trait", "keys")).alias("members"))
    one = dealt.select("key", F.col("chunk").alias("ca"), F.col("members").alias("ma"))
    two = dealt.select("key", F.col("chunk").alias("cb"), F.col("members").alias("mb"))
    both = one.join(two, "key").where("ca <= cb").select("key", "ma", "mb")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for k in range(batch.num_rows):
                key, (x, y) = batch.column("key")[k].as_py(), (batch.column(c)[k].values for c in ("ma", "mb"))
                n, m = (np.asarray(z.field("node")) for z in (x, y))
                ok = may(x.field("trait").to_pylist(), y.field("trait").to_pylist())
                ok &= np.asarray(x.field("component"))[:, None] != np.asarray(y.field("component"))[None, :]
                ok &= n[:, None] != m[None, :]
                if ok.any():
                    ok &= ~_sooner(x.field("keys"), y.field("keys"), key)
                    i, j = np.nonzero(ok)
                    a.append(np.minimum(n[i], m[j])), b.append(np.maximum(n[i], m[j]))
            if a:
                found = pa.table([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])
                yield from found.group_by(["a", "b"]).aggregate([]).select(["a", "b"]).to_batches()

    return both.mapInArrow(work, "a long, b long").distinct()


def grouped(shared: DataFrame, check: Callable[[DataFrame], DataFrame], traits: DataFrame, may: Callable, rounds: int = 2) -> DataFrame:
    """node, component over the links that `check` leaves of all pairs of nodes with a common key; nodes on no link are left out.

    First every node is held against its key's hub and against a random other member, then in further `rounds` against random members of
    other components. The links so found join a group of near copies for about its size in pairs, not its square. Only what keys then still
    hold in several components is compared in full, across components (see `crossed`), so no connection is lost. `traits` has node and
    trait; `may` must hold for every pair that `check` keeps.
    """
    star = shared.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = common.written(check(star.unionByName(chained(shared, 0)).distinct()))
    found = components(links)
    for seed in range(1, rounds + 2):
        rest = split(shared, found)
        if rest.isEmpty():
            common.removed(rest)
            break
        more = common.written(check(chained(rest, seed) if seed <= rounds else crossed(rest, traits, may)))
        if not more.isEmpty():
            links = common.written(links.unionByName(more))
            found = components(links)
        common.removed(rest)
    common.removed(shared)
    return found
