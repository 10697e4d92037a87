"""Operator 2: hierarchical Pitman-Yor language model.

The model predicts a text's tokens byte by byte: words in lower case (A-Z), a space after each, and one end symbol. A restaurant is a context of up
to five bytes; its parent is the context without its farthest byte, down to the empty one, which rests on the uniform law. Customers of the longest contexts
are the corpus counts; every table of a restaurant is a customer of its parent. Seatings are sampled: the chain starts with a
table for every dish, each Gibbs step takes a random share of the customers from their tables and seats them anew, and the seating is carried
from sweep to sweep (customers that the tables below bring or take come and go). Predictive probabilities are averaged over samples.

Counts are gathered from all training documents by grouped sums. Contexts of one last pair of bytes form a subtree; subtrees are sampled side
by side, one after the other inside a partition (small ones together). A pair of more than `together` counts is sampled by its third bytes, whose
tables are the pair's customers. The contexts of one byte and none have 256**2 counts at most, which is proven small enough for the driver. Both parts are sampled in turn. Texts are scored in blocks of bounded size that look up just the n-grams and words they hold.

Null texts are empty and consist of the end symbol. A null id is neither held out nor learnt from. Repeated rows give repeated results; an empty table gives
an empty table; other columns are ignored. Texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callweave.llm import common

END, DEPTH = 0xFF, 5
#: Text bytes of a scoring block.
BLOCK_BYTES = 24 << 20
#: Text bytes whose n-grams are made at a time (an n-gram is eight bytes), and keys that a gathering task holds.
GRAM_BYTES, HELD = 1 << 19, 1_000_000

_HASHER = common.Hasher(fold=True, seed=2)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Hash that stands for the end token among words; word keys are negative, n-gram keys are not.
_WORD = np.uint64(1 << 63)


@dataclass(frozen=True)
class Settings:
    """Discount and strength by context length; Gibbs sweeps before and while samples are kept; steps a sweep
    and the share of customers that each moves; n-grams that a task samples at a time."""

    discount: tuple[float, ...] = (0.2, 0.3, 0.4, 0.5, 0.5, 0.5)
    strength: tuple[float, ...] = (1.0, 1.0, 1.0, 1.0, 0.5, 0.5)
    burn: int = 2
    samples: int = 4
    steps: int = 3
    share: float = 0.3
    rounds: int = 2
    together: int = 400_000
    seed: int = 11


def grams(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Key of each symbol with its context (six bytes of an integer), and each row's first symbol (one more entry than rows)."""
    # Ends ahead of a row stand for the symbols that its first contexts lack.
    closed = pc.binary_join_element_wise(pa.scalar(b"\xff" * DEPTH), pc.fill_null(texts, "").cast(pa.binary()), pa.scalar(b" \xff"), pa.scalar(b""))
    if isinstance(closed, pa.ChunkedArray):
        closed = closed.combine_chunks()
    data = _LOWER[np.frombuffer(b"".join(closed.to_pylist()), np.uint8)]
    space = _HASHER.space[data]
    solid = ~space & (data != END)
    keep = ~space
    keep[1:] |= space[1:] & solid[:-1]
    data[space] = 32
    symbols = data[keep]
    ends = np.flatnonzero(symbols == END).reshape(-1, DEPTH + 1)
    key = symbols.astype(np.int64)
    for j in range(1, DEPTH + 1):
        key[j:] |= symbols[:-j].astype(np.int64) << (8 * j)
    own = np.ones(len(symbols), bool)
    own[ends[:, :-1]] = False
    return key[own], np.concatenate([[0], np.cumsum(ends[:, -1] - ends[:, -2])])


def words(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Key of every word, and each row's first word (one more entry than rows); the end token is not among them."""
    h, rows = _HASHER.words(texts)
    return (h | _WORD).view(np.int64), rows


END_WORD = int((common.mix(np.array([20], np.uint64)) | _WORD).view(np.int64)[0])


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, n of the texts of a task: every word and n-gram, and how often it stands where `learn` holds. Keys may come more than once."""
    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for piece in common.pieces(batches, size=GRAM_BYTES):
        learn = piece.column("learn").to_numpy().astype(bool)
        for of in (grams, words):
            key, rows = of(piece.column("text"))
            learnt = np.repeat(learn, np.diff(rows))
            kept.append(np.unique(key[learnt], return_counts=True))
            rest = _distinct(key[~learnt])
            kept.append((rest, np.zeros(len(rest), np.int64)))
        kept.append((np.array([END_WORD]), np.array([learn.sum()])))
        if sum(len(u) for u, _ in kept) > 2 * HELD:
            kept = [_merged(kept)]
            if len(kept[0][0]) > HELD:
                yield from _batches(*kept.pop())
    if kept:
        yield from _batches(*_merged(kept))


def gathered(docs: DataFrame) -> DataFrame:
    """key, n: how often every word and n-gram of the corpus stands in training documents (0 for those of other documents alone)."""
    return common.written(docs.select("learn", "text").mapInArrow(counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")))


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The keys once each, sorted. `np.unique` of numpy 2.3 hashes whole numbers, which takes several times as long."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def _looked_up(gram: np.ndarray, key: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The value of each n-gram, all of which are among the sorted keys. Sought in order, with the place in a run of n-grams as the low 16 bits."""
    out = np.empty(len(gram))
    for lo in range(0, len(gram), 1 << 16):
        run = gram[lo : lo + (1 << 16)].astype(np.uint64) << np.uint64(16)
        run = np.sort(run | np.arange(len(run), dtype=np.uint64))
        out[lo + (run & np.uint64(0xFFFF)).astype(np.int64)] = value[np.searchsorted(key, (run >> np.uint64(16)).astype(np.int64))]
    return out


def _merged(kept: list) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate([u for u, _ in kept]), np.concatenate([c for _, c in kept])
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(n, first)


def _batches(keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(keys), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(keys[lo : lo + (1 << 16)]), pa.array(n[lo : lo + (1 << 16)])], ["key", "n"])


class Level:
    """Restaurants of one context length. The seating is kept: `dish` and `size` of every table, in order of dishes, and `number` of tables of each dish."""

    def __init__(self, room: np.ndarray, discount: float, strength: float, draw: np.random.Generator) -> None:
        self.room, self.rooms = room, int(room.max(initial=-1)) + 1
        self.discount, self.strength, self.draw = discount, strength, draw
        self.customers, self.number = np.zeros(len(room), np.int64), np.zeros(len(room), np.int64)
        self.dish = self.size = np.zeros(0, np.int64)

    def _first(self) -> np.ndarray:
        first = np.zeros(len(self.room) + 1, np.int64)
        np.cumsum(self.number, out=first[1:])
        return first

    def leave(self, dish: np.ndarray, k: np.ndarray) -> None:
        """k[i] customers of dish[i], drawn at random, leave; empty tables go."""
        at, one = self._first()[dish], self.number[dish] == 1
        # They all leave a dish's only table.
        self.size[at[one]] -= k[one]
        open_ = np.flatnonzero(~one & (k > 0))
        at, rest, whole = at[open_], k[open_], self.customers[dish[open_]]
        while len(at):
            own = self.size[at]
            others = whole - own
            small = whole < 1_000_000_000
            if small.all():
                gone = self.draw.hypergeometric(own, others, rest)
            else:
                gone = np.zeros(len(at), np.int64)
                gone[small] = self.draw.hypergeometric(own[small], others[small], rest[small])
                # Beyond the sizes that numpy's hypergeometric law takes, the binomial one is as good.
                gone[~small] = self.draw.binomial(rest[~small], own[~small] / whole[~small])
            gone = np.clip(gone, np.maximum(rest - others, 0), np.minimum(own, rest))
            self.size[at] -= gone
            rest = rest - gone
            more = rest > 0
            at, rest, whole = at[more] + 1, rest[more], others[more]
        self.customers[dish] -= k
        keep = self.size > 0
        np.subtract.at(self.number, self.dish[~keep], 1)
        self.dish, self.size = self.dish[keep], self.size[keep]

    def _join(self, k: np.ndarray, dish: np.ndarray, first: np.ndarray) -> None:
        """k[i] customers choose among the tables of dish[i] by size less discount: table after table, a binomial share of those left."""
        at, number = first[dish], self.number[dish]
        one = (number == 1) & (k > 0)
        self.size[at[one]] += k[one]
        open_ = np.flatnonzero((number > 1) & (k > 0))
        at, rest, number = at[open_], k[open_], number[open_]
        whole = self.customers[dish[open_]] - self.discount * number
        while len(at):
            weight = self.size[at] - self.discount
            share = np.where(number == 1, 1.0, np.minimum(weight / np.maximum(whole, 1e-300), 1))
            got = self.draw.binomial(rest, share)
            self.size[at] += got
            rest = rest - got
            more = rest > 0
            at, rest, number, whole = at[more] + 1, rest[more], number[more] - 1, (whole - weight)[more]

    def enter(self, dish: np.ndarray, k: np.ndarray, base: np.ndarray, blocks: int = 2) -> None:
        """k[i] customers of dish[i] are seated in turn; rates stay the same inside one of the blocks, which double where few are seated."""
        some = np.flatnonzero(k > 0)
        d, rest, most = dish[some], k[some], np.maximum(-(-k[some] // blocks), 1)
        total, first = np.bincount(self.room, self.number, self.rooms), self._first()
        while len(d):
            seated, room = self.customers[d], self.room[d]
            many = np.minimum(np.minimum(rest, most), np.where(seated == 0, 1, seated // 4 + 1))
            fresh = (self.strength + self.discount * total[room]) * base[d]
            new = self.draw.binomial(many, np.where(seated == 0, 1.0, np.clip(fresh / (fresh + seated - self.discount * self.number[d]), 0, 1)))
            self._join(many - new, d, first)
            self.customers[d] += many
            made = np.flatnonzero(new)
            if len(made):
                added = np.repeat(d[made], new[made])
                spots = first[added + 1]
                self.dish, self.size = np.insert(self.dish, spots, added), np.insert(self.size, spots, 1)
                self.number[d] += new
                np.add.at(total, room[made], new[made])
                first = self._first()
            rest = rest - many
            more = rest > 0
            d, rest, most = d[more], rest[more], most[more]

    def arrange(self, customers: np.ndarray, base: np.ndarray) -> None:
        """Customers come or go until there are as many as given; all others keep their tables. The chain starts with one table a dish:
        from there the steps come near the law soonest, since tables of many customers rarely empty."""
        if not len(self.dish):
            self.customers, self.dish = customers.copy(), np.flatnonzero(customers)
            self.size, self.number = customers[self.dish].copy(), (customers > 0).astype(np.int64)
            return
        change = customers - self.customers
        gone, come = np.flatnonzero(change < 0), np.flatnonzero(change > 0)
        if len(gone):
            self.leave(gone, -change[gone])
        if len(come):
            self.enter(come, change[come], base)

    def step(self, base: np.ndarray, share: float) -> None:
        """A Gibbs step: of every dish a random share of the customers leaves and is seated anew given all others."""
        some = np.flatnonzero(self.customers > 1)
        k = self.draw.binomial(self.customers[some], share)
        some, k = some[k > 0], k[k > 0]
        if len(some):
            self.leave(some, k)
            self.enter(some, k, base)

    def predictive(self, base: np.ndarray) -> np.ndarray:
        tables = self.number
        c, t = np.bincount(self.room, self.customers, self.rooms)[self.room], np.bincount(self.room, tables, self.rooms)[self.room]
        return (np.maximum(self.customers - self.discount * tables, 0) + (self.strength + self.discount * t) * base) / (self.strength + c)


def sample(keys: np.ndarray, n: np.ndarray, depths: tuple[int, ...], base: np.ndarray, s: Settings, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Samples restaurants of the given context lengths, longest first, over counts of n-grams of the longest.

    `base` is the law below the shortest: the probability of each of its n-grams (sorted). One seating is carried through all sweeps. Returns
    the averaged predictive probability of every key, and the shortest length's n-grams with the tables of the last sample.
    """
    draw = np.random.default_rng([s.seed, seed])
    parts = [np.unique(keys & ((1 << (8 * (d + 1))) - 1), return_inverse=True) for d in depths]
    levels = []
    for d, (gram, _) in zip(depths, parts, strict=True):
        room = np.unique(gram >> 8, return_inverse=True)[1] if d else np.zeros(len(gram), np.int64)
        levels.append(Level(room, s.discount[d], s.strength[d], draw))
    up = [np.unique(gram & ((1 << (8 * (d + 1))) - 1), return_inverse=True)[1] for (gram, _), d in zip(parts[1:], depths[:-1])]
    counts = np.bincount(parts[-1][1], n, len(parts[-1][0])).astype(np.int64)
    law: list[np.ndarray] = [base]
    for k in range(len(levels) - 1):
        law.append(law[-1][up[k]])
    out = np.zeros(len(parts[-1][0]))
    for sweep in range(s.burn + s.samples):
        customers = counts
        for k in range(len(levels) - 1, -1, -1):
            levels[k].arrange(customers, law[k])
            for _ in range(s.steps):
                levels[k].step(law[k], s.share)
            if k:
                customers = np.bincount(up[k - 1], levels[k].number, len(parts[k - 1][0])).astype(np.int64)
        p = base
        for k, level in enumerate(levels):
            law[k] = p
            p = level.predictive(p)
            if k + 1 < len(levels):
                p = p[up[k]]
        if sweep >= s.burn:
            out += p
    return (out / s.samples)[parts[-1][1]], parts[0][0], levels[0].number


def _subtrees(batches: Iterator[pa.RecordBatch], together: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool, bool]]:
    """Runs of rows, as (keys, n, whether the run is a part of one pair, whether that pair ends with it).

    Rows come in order of pair, third byte and key. Pairs of fewer than `together` rows go together; a larger one is cut after a third byte.
    """
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def cut(keys: np.ndarray, n: np.ndarray, last: bool) -> Iterator:
        pair, third = (keys >> 8) & 0xFFFF, (keys >> 24) & 0xFF
        while len(keys):
            if not last and len(keys) <= together:
                break
            upto = np.flatnonzero(np.diff(pair, append=-1))
            whole = upto[upto < together] + 1 if not cut.inside else upto[:1][upto[:1] < together] + 1
            if not last and len(whole) and whole[-1] == len(keys):
                whole = whole[:-1]
            if len(whole) and not cut.inside:
                end, part, ends = int(whole[-1]), False, True
            else:
                pair_end = int(upto[0]) + 1
                thirds = np.flatnonzero(np.diff(third[:pair_end], append=-1)) + 1
                done = pair_end < len(keys) or last
                if not done:
                    thirds = thirds[:-1]
                if not len(thirds):
                    break
                fits = thirds[thirds <= together]
                end = int(fits[-1] if len(fits) else thirds[0])
                part, ends = True, done and end == pair_end
            yield keys[:end], n[:end], part, ends
            cut.inside = part and not ends
            keys, n, pair, third = keys[end:], n[end:], pair[end:], third[end:]
        held[:] = [(keys, n)] if len(keys) else []

    cut.inside = False
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column("key").to_numpy(), batch.column("n").to_numpy()))
            if sum(len(k) for k, _ in held) > 2 * together:
                yield from cut(*(np.concatenate(c) for c in zip(*held)), False)
    if held:
        yield from cut(*(np.concatenate(c) for c in zip(*held)), True)


def fit(counts: DataFrame, s: Settings = Settings()) -> DataFrame:
    """key, p: averaged predictive probability of every n-gram of the corpus.

    The first round gives the tables of the two-byte contexts and, for pairs that are sampled in parts, their own law; the last one the result.
    """
    rows = counts.where("key >= 0").select("key", "n", F.expr("shiftright(key, 8) & 65535").alias("pair"), F.expr("shiftright(key, 24) & 255").alias("third"))
    bits, gram2 = (1 << 16) - 1, (1 << 24) - 1

    def tables_of(top: np.ndarray | None, middle: tuple[np.ndarray, np.ndarray], out: bool, turn: int):
        def base_of(short: np.ndarray) -> np.ndarray:
            return (top[short & bits] if top is not None else np.full(len(short), 1 / 256)).astype(np.float64)

        def rows_of(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
            yield from pa.table([pa.array(a), pa.array(b.astype(np.float64))], ["key", "p"]).to_batches(max_chunksize=1 << 16)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.zeros(256, np.int64)
            for keys, n, part, ends in _subtrees(batches, s.together):
                order = np.argsort(keys)
                keys, n = keys[order], n[order]
                if not part:
                    p, gram, tables = sample(keys, n, tuple(range(2, DEPTH + 1)), base_of(np.unique(keys & gram2)), s, turn)
                    yield from rows_of(keys, p) if out else rows_of(gram & bits, tables)
                    continue
                # Contexts of three bytes and more, below the pair's law: that of the round before, or else the law below it.
                short = np.unique(keys & ((1 << 32) - 1)) & gram2
                law = base_of(short)
                if len(middle[0]):
                    at = np.minimum(np.searchsorted(middle[0], short), len(middle[0]) - 1)
                    law = np.where(middle[0][at] == short, middle[1][at], law)
                p, gram, tables = sample(keys, n, tuple(range(3, DEPTH + 1)), law, s, turn)
                if out:
                    yield from rows_of(keys, p)
                    continue
                np.add.at(own, gram & 255, tables)
                if ends:
                    two = (keys[0] & (bits << 8)) + np.flatnonzero(own)
                    p, gram, tables = sample(two, own[own > 0], (2,), base_of(two), s, turn)
                    yield from rows_of(gram & bits, tables)
                    yield from rows_of(-1 - two, p)
                    own[:] = 0

        return work

    # Partitions hold whole pairs, in order.
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    trees = rows.repartition(parts, "pair").sortWithinPartitions("pair", "third", "key").select("key", "n")
    top, middle = None, (np.zeros(0, np.int64), np.zeros(0))
    for turn in range(s.rounds - 1):
        found = trees.mapInArrow(tables_of(top, middle, False, turn), "key long, p double")
        # One row for a pair of bytes at most, 65,536, and 256 for a pair that is sampled in parts.
        pairs = found.groupBy("key").agg(F.sum("p").alias("p")).toArrow().sort_by("key")
        key, p = pairs.column("key").to_numpy(), pairs.column("p").to_numpy()
        low = key < 0
        middle = (-1 - key[low])[::-1], p[low][::-1]
        n = np.zeros(1 << 16)
        n[key[~low]] = p[~low]
        top, _, _ = sample(np.arange(1 << 16), n.astype(np.int64), (0, 1), np.full(256, 1 / 256), s, 1000 + turn)
    return common.written(trees.mapInArrow(tables_of(top, middle, True, s.rounds), "key long, p double"))


#: Rows of one id and text from which their scoring is spread over blocks.
REPEATS = 256


def blocked(rows: DataFrame, blocks: int) -> tuple[DataFrame, DataFrame]:
    """`rows` with the block that each is scored in, and the texts that each block has to know. Rows of one id and text share a block; where
    they are many, they are spread at random over several blocks, each of which knows the text."""
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    spread = F.least(F.lit(blocks), F.ceil(F.col("times") / REPEATS)).cast("int")
    many = rows.groupBy("h").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > REPEATS)
    many = common.written(many.select("h", spread.alias("spread")))
    met = rows.join(many, "h", "left").withColumn("spread", F.coalesce("spread", F.lit(1)))
    block = F.pmod(F.col("h") + F.col("salt"), F.lit(blocks)).cast("int")
    dealt = met.withColumn("salt", F.floor(F.rand(5) * F.col("spread"))).select("doc_id", "text", block.alias("block"))
    one = rows.join(many, "h", "left_anti").select("text", F.pmod("h", F.lit(blocks)).cast("int").alias("block"))
    some = rows.join(many, "h").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("spread") - 1))).select("text", block.alias("block"))
    return dealt, one.unionByName(some.dropDuplicates(["text", "block"]))


def scored(docs: DataFrame, learn: Column, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity (per token) of every document, learning where `learn` holds."""
    rows = docs.select("doc_id", common.whole(F.col("text")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = gathered(rows)
    model = fit(counts, s)
    total = counts.where("key < 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1)), F.max(F.when(F.col("key") == END_WORD, F.col("n")))).first()
    size, kinds, ends = (int(x or 0) for x in total)
    blocks = int((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BLOCK_BYTES) + 1
    dealt, texts = blocked(rows.select("doc_id", "text"), blocks)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every word and n-gram of a block once."""
        found: dict[int, list[np.ndarray]] = {}
        for piece in common.pieces(batches, size=GRAM_BYTES):
            block = piece.column("block").to_numpy()
            for key, first in (grams(piece.column("text")), words(piece.column("text"))):
                of = np.repeat(block, np.diff(first))
                for b in np.unique(block):
                    kept = found.setdefault(int(b), [])
                    kept.append(_distinct(key[of == b]))
                    # Merged now and then: the runs gathered since are as long as what is kept.
                    if sum(map(len, kept[1:])) > max(1_000_000, len(kept[0])):
                        found[int(b)] = [_distinct(np.concatenate(kept))]
        for b, kept in found.items():
            keys = _distinct(np.concatenate(kept))
            for lo in range(0, len(keys), 1 << 16):
                part = keys[lo : lo + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), b, np.int32)), pa.array(part)], ["block", "key"])

    needs = texts.repartition(blocks, "block").select("block", "text").mapInArrow(asked, "block int, key long")
    values = model.unionByName(counts.where("key < 0 AND n > 0").select("key", F.col("n").cast("double").alias("p")))
    known = common.written(needs.join(values, "key").select("block", "key", "p"))
    log_base = np.log10(size + 0.5 * (kinds + 1))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        key, value = right.column("key").to_numpy(), right.column("p").to_numpy()
        order = np.argsort(key)
        key, value = key[order], value[order]
        log = np.log10(np.maximum(value, 1e-300))
        out = []
        for piece in common.pieces(iter(left.combine_chunks().to_batches()), size=GRAM_BYTES):
            gram, first = grams(piece.column("text"))
            chance = np.add.reduceat(_looked_up(gram, key, log), first[:-1])
            word, rows = words(piece.column("text"))
            at = np.minimum(np.searchsorted(key, word), max(0, len(key) - 1))
            c = np.where(key[at] == word, value[at], 0.0) if len(word) else np.zeros(0)
            # The end token after each row's words; every row is summed by itself, so that equal texts have equal sums wherever they stand.
            share = np.insert(np.log10(c + 0.5), rows[1:], np.log10(ends + 0.5)) - log_base
            seen = np.concatenate([[0], np.cumsum(c > 0)])
            n = np.diff(rows) + 1
            base = np.add.reduceat(share, rows[:-1] + np.arange(len(n)))
            known_ = seen[rows[1:]] - seen[rows[:-1]] + (ends > 0)
            columns = [piece.column("doc_id").combine_chunks(), pa.array(n), pa.array(known_), pa.array(np.full(len(n), size)), pa.array(base), pa.array(chance), pa.array(10 ** np.minimum(300, -chance / n))]
            out.append(pa.table(columns, ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity"]))
        return pa.concat_tables(out) if out else empty

    kind = docs.schema["doc_id"].dataType.simpleString()
    empty = pa.table({"doc_id": pa.array([], pa.int64())} | {c: pa.array([], pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")} | {c: pa.array([], pa.float64()) for c in ("base_score", "score", "perplexity")})
    schema = f"doc_id {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
    return dealt.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(score, schema)


def op2_pitman_yor(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    out = scored(docs, common.key_of(F.col("doc_id")) % 5 != 1)
    held = F.coalesce(common.key_of(F.col("doc_id")) % 5 == 1, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


QUERIES = {"op2_pitman_yor": op2_pitman_yor}
ORACLE: dict[str, str] = {}
