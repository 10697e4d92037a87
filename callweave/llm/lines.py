r"""Operator 3: fuzzy line dedup.

Lines are the pieces of a text between line feeds. Their normal form is lower case with everything but letters taken as space. Lines of
`min_words` words or more take part, and so do lines of LONG characters or more that have as many units: in scripts written without spaces each
character is a unit. Other lines of LONG characters or more (long words, digits, marks) are one where they are equal but for case and
spaces; what is shorter (headings, list marks, a lone "yes") always stays: such lines repeat because the texts have the same make-up.

Each normal form has a SimHash of 128 bits over its runs of GRAM characters. It is cut into four blocks, and forms with a block in common are
candidates: by pigeonhole all forms that differ in three bits at most. An edit similarity of 0.8 goes along with many more bits (two changed
words in fifty move about ten), so that blocks alone miss most such pairs; a form therefore has further keys: a MinHash sample of KEYS of its
runs of RUN units, below MIDDLE words all its runs of one less, and below SHORT words its words with each one left out. Forms with a common key are candidates; those whose SimHash
differs in more than BITS bits (short ones: BRIEF_BITS), or whose lengths rule it out, go; all others are verified by edit similarity (1 - distance / longer length,
code points) of `similarity` or more. Of every connected group of lines the first occurrence by (doc_id, line) stays, in that document and place.

Null texts stay null and take no part. Null ids come last in the order; rows of one id and text are one document and get the same result;
equal ids with different texts are ordered by text hash. A text that loses all its lines becomes empty, its row stays. Other columns pass through.
An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions import manypairs
from callweave.llm import common, components

MIN_WORDS, SIMILARITY = 5, 0.8
#: Characters from which a line takes part whatever its words.
LONG = 20
#: Words of a run, runs sampled of a form, words from which a form has no keys with a word left out, and words from which it has no runs of one less:
#: three words changed in fifteen, or two in ten, may leave no longer run.
RUN, KEYS, SHORT, MIDDLE = 4, 12, 10, 16
#: Characters of a SimHash feature, and bits of 128 in which verified forms may differ; below BRIEF characters, where few features make a sign
#: uncertain and verifying is cheap, BRIEF_BITS.
GRAM, BITS, BRIEF, BRIEF_BITS = 5, 40, 160, 48
#: Members of a key from which its pairs are not all given by its least member and by neighbours.
FEW = 3
#: Text bytes whose numbers stay in a core's cache.
CACHED = 1 << 18
#: Passes in which the keys go through the shuffle, and most shares in which pairs do with their texts, from so many pairs on.
PASSES, SHARES, SHARE = 2, 8, 150_000

_HASHER = common.Hasher(fold=True, seed=3)
_HASHER.space = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])


#: Bytes as their lower case, or as a space where they are neither letters nor part of a longer character.
_TABLE = bytes(b if b > 127 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def normal(line: str) -> str:
    return b" ".join(line.encode().translate(_TABLE).split()).decode()


def forms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Normal forms of the lines that each text is asked for."""
    for piece in common.pieces(batches):
        nodes, forms = [], []
        for text, spots in zip(piece.column("text").to_pylist(), piece.column("spots").to_pylist(), strict=True):
            every = text.split("\n")
            for spot in spots:
                nodes.append(spot["node"]), forms.append(normal(every[spot["line"]]))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(forms, pa.string())], ["node", "form"])


def line_words(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lines that begin at `starts` (one more entry than lines): word hashes, word lengths in bytes, each line's first word."""
    begin, end, rows = _HASHER.word_bounds(data, starts)
    return _HASHER.runs(_HASHER.sums(data), begin, end), end - begin, rows


def line_units(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `line_words`, but each character of a script without spaces (Chinese, Japanese, Thai, Lao, Burmese, Khmer) is a word of its own."""
    after = np.concatenate([data[1:], np.zeros(1, np.uint8)])
    alone = (data >= 0xE3) & (data <= 0xE9)
    alone |= (data == 0xE0) & (after >= 0xB8) & (after <= 0xBB)
    alone |= (data == 0xE1) & (((after >= 0x80) & (after <= 0x82)) | (after == 0x9E) | (after == 0x9F))
    at = np.flatnonzero(alone)
    if not len(at):
        return line_words(data, starts)
    begin, end, _ = _HASHER.word_bounds(data, starts)
    # All these characters have three bytes; what lies between them in a word is a unit as well.
    end = np.unique(np.concatenate([end, at + 3, at[np.isin(at, begin, invert=True)]]))
    begin = np.unique(np.concatenate([begin, at, (at + 3)[np.isin(at + 3, _HASHER.word_bounds(data, starts)[1], invert=True)]]))
    return _HASHER.runs(_HASHER.sums(data), begin, end), end - begin, np.searchsorted(begin, starts)


def exact_form(line: bytes) -> int | None:
    """Hash of a line without regard to case and spaces; None below LONG characters."""
    text = " ".join(line.decode().lower().split())
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True) if len(text) >= LONG else None


def line_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For lines that begin at `starts` (one more entry than lines): words, hash of the normal form, characters of the normal form."""
    words, _, rows = line_words(data, starts)
    count = np.diff(rows)
    line = np.repeat(np.arange(len(count)), count)
    place = np.arange(len(words)) - rows[:-1][line]
    form = np.zeros(len(count), np.uint64)
    full = np.flatnonzero(count)
    if len(full):
        form[full] = np.add.reduceat(common.mix(words + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), rows[:-1][full])
    ends = np.concatenate([[0], np.cumsum(~_HASHER.space[data] & (data & 0xC0 != 0x80))])
    chars = ends[starts[1:]] - ends[starts[:-1]] + np.maximum(count - 1, 0)
    return count, common.mix(form), chars


#: For each byte its eight bits as the eight bytes of a number: sums of up to 255 of them count bits.
_LANES = (np.arange(256, dtype=np.uint8)[:, None] >> np.arange(8, dtype=np.uint8) & 1).copy().view(np.uint64).ravel()


#: Numbers whose bits are counted together: four planes hold the counts.
GROUP = 15


def _added(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Low and high bits of the sums of three bits."""
    half = x ^ y
    return half ^ z, (x & y) | (half & z)


def group_counts(rows: np.ndarray) -> list[np.ndarray]:
    """How many of the 15 numbers of each column have a bit: the counts' bits of weight 1, 2, 4 and 8, in numbers like these."""
    low, twos = _added(rows[:5], rows[5:10], rows[10:])
    one, two = _added(low[0], low[1], low[2])
    one, three = _added(one, low[3], low[4])
    pair, fours = _added(np.stack([twos[0], twos[1]]), np.stack([twos[2], twos[3]]), np.stack([twos[4], two]))
    twos, four = _added(pair[0], pair[1], three)
    fours, eights = _added(fours[0], fours[1], four)
    return [one, twos, fours, eights]


def line_signs(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """SimHash of each line's normal form: two 64-bit numbers. Its features are the runs of GRAM characters (bytes), a space before and after."""
    words, ends, rows = _HASHER.word_bounds(data, starts)
    lines = len(starts) - 1
    if not len(words):
        return np.zeros((lines, 2), np.uint64)
    # Words of all lines, one space ahead of each and one after the last of a line.
    line = np.repeat(np.arange(lines), np.diff(rows))
    size = ends - words + 1
    last = np.diff(line, append=-1) != 0
    at = np.concatenate([[0], np.cumsum(size + last)])
    flat = np.full(at[-1], 32, np.uint8)
    source = np.arange(at[-1]) - np.repeat(at[:-1], size + last)
    inside = (source > 0) & (source < np.repeat(size, size + last))
    flat[inside] = data[(np.repeat(words, size + last) + source - 1)[inside]]
    upper = (flat >= 65) & (flat <= 90)
    flat[upper] += 32
    full = np.flatnonzero(np.diff(rows))
    begin, end = at[rows[full]], at[rows[full + 1]]
    sums = _HASHER.sums(flat)
    # A form shorter than a run is one feature. Features go in groups of GROUP, a line's last one filled up.
    count = np.maximum(end - begin - GRAM + 1, 1)
    groups = -(-count // GROUP)
    first = np.concatenate([[0], np.cumsum(groups)])
    spot = np.arange(first[-1] * GROUP) + np.repeat(begin - first[:-1] * GROUP, groups * GROUP)
    stop = np.repeat(end, groups * GROUP)
    filling = np.flatnonzero(spot >= np.repeat(begin + count, groups * GROUP))
    spot[filling] = stop[filling] - 1
    gram = _HASHER.runs(sums, spot, np.minimum(spot + GRAM, stop))
    # Pieces of at most 255 features, so that a lane does not overflow.
    piece = 255 // GROUP
    heads = np.concatenate([[0], np.cumsum(-(-groups // piece))])
    pieces = np.arange(heads[-1]) * piece + np.repeat(first[:-1] - heads[:-1] * piece, np.diff(heads))
    out = np.zeros((lines, 2), np.uint64)
    for half in range(2):
        bits = common.mix(gram + np.uint64((half + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        bits[filling] = 0
        planes = [x.view(np.uint8).reshape(-1, 8) for x in group_counts(np.ascontiguousarray(bits.reshape(-1, GROUP).T))]
        ones = np.empty((len(full), 64), np.int64)
        for k in range(8):
            lanes = sum(_LANES[plane[:, k]] << np.uint64(power) for power, plane in enumerate(planes))
            lanes = np.add.reduceat(lanes, pieces).view(np.uint8).reshape(-1, 8)
            ones[:, 8 * k : 8 * k + 8] = np.add.reduceat(lanes.astype(np.int64), heads[:-1], axis=0)
        out[full, half] = np.packbits(2 * ones > count[:, None], axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def line_keys(words: np.ndarray, width: np.ndarray, rows: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """line and key of the keys of every line, sorted by line: its SimHash's blocks, its sampled runs, its words without one."""
    count = np.diff(rows)
    line = np.repeat(np.arange(len(count)), count)
    place, size = np.arange(len(words)) - rows[:-1][line], count[line]
    lines, keys = [], []
    for length in (RUN - 1, RUN):
        # Runs of words, the first KEYS of a line by a hash that long runs have shifted down; shorter lines also have runs of one word less.
        at = np.flatnonzero((place <= size - length) & ((length == RUN) | (size < MIDDLE)))
        run, wide = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
        for j in range(length):
            run = common.mix(run * np.uint64(0x9E3779B97F4A7C15) + words[at + j])
            wide += width[at + j]
        order = np.lexsort((run >> np.clip((wide - 8) // 3, 0, 10).astype(np.uint64), line[at]))
        own, run = line[at][order], run[order]
        fresh = np.ones(len(own), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (run[1:] != run[:-1])
        own, run = own[fresh], run[fresh]
        keep = np.arange(len(own)) - np.searchsorted(own, own) < (KEYS if length == RUN else MIDDLE)
        lines.append(own[keep])
        keys.append(run[keep])
    some = np.flatnonzero(count)
    for block in range(4):
        part = signs[some, block // 2] >> np.uint64(32 * (block % 2)) & np.uint64(0xFFFFFFFF)
        lines.append(some)
        keys.append(common.mix(part + np.uint64(block + 1 << 40)))
    # The words of a short line without one of them, and all of them: sums of hashes that know their place.
    for gone in range(SHORT):
        some = np.flatnonzero((size < SHORT) & (size >= gone) & (place != gone))
        if not len(some):
            continue
        spot = place[some] - (place[some] > gone)
        part = common.mix(words[some] + (spot + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        first = np.flatnonzero(np.diff(line[some], prepend=-1))
        lines.append(line[some][first])
        keys.append(common.mix(np.add.reduceat(part, first) + np.uint64(1)))
    out, key = np.concatenate(lines), np.concatenate(keys)
    order = np.argsort(out, kind="stable")
    return out[order], key[order]


def occurrences(docs: DataFrame, min_words: int) -> DataFrame:
    """id, mark, doc_id, line, node, chars, s1, s2 (SimHash) and keys of every line that takes part, written once."""
    rows = common.named(docs.where("text IS NOT NULL")).select("id", "mark", F.col("doc_id"), "text").where(F.length("text") > 0)
    schema = T.StructType(
        [rows.schema["id"], rows.schema["mark"], rows.schema["doc_id"]]
        + [T.StructField(c, T.LongType()) for c in ("line", "node", "chars", "s1", "s2")]
        + [T.StructField("keys", T.ArrayType(T.LongType()))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, size=CACHED):
            data, offsets = common.flat(piece.column("text"))
            # A line begins after each line feed and at each text's start; the feed itself counts as space.
            starts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 10) + 1]))
            count, form, chars = line_hashes(data, starts)
            row = np.searchsorted(offsets, starts[:-1], "right") - 1
            first = np.searchsorted(starts, offsets[:-1])
            units = line_units(data, starts)
            near, node = count >= min_words, form.view(np.int64)
            same = np.zeros(len(count), bool)
            for k in np.flatnonzero(~near & (np.diff(starts) >= LONG)):
                exact = exact_form(data[starts[k] : starts[k + 1]].tobytes())
                if exact is None:
                    continue
                if units[2][k + 1] - units[2][k] >= min_words:
                    near[k] = True
                else:
                    same[k], node[k] = True, exact
            keep = np.flatnonzero(near | same)
            own = piece.select(["id", "mark", "doc_id"]).take(pa.array(row[keep]))
            signs = line_signs(data, starts)
            out = {"line": keep - first[row[keep]], "node": node[keep], "chars": chars[keep], "s1": signs[keep, 0].view(np.int64), "s2": signs[keep, 1].view(np.int64)}
            for name, values in out.items():
                own = own.append_column(name, pa.array(values.astype(np.int64)))
            line, key = line_keys(*units, signs)
            has = near[line]
            ends = np.searchsorted(line[has], keep, "right")
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(key[has].view(np.int64)))
            yield from own.append_column("keys", lists).to_batches()

    return common.written(rows.mapInArrow(work, schema), compression="zstd")


def within(a: str, b: str, limit: int) -> bool:
    """True where the edit distance is `limit` at most. Bit vectors over a, column by column of b (Myers 1999); every 32 columns the value on
    the diagonal, less the difference in length, bounds the distance from below, so that unlike texts are left early."""
    short, head = min(len(a), len(b)), 0
    while head < short and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < short - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return False
    if max(n, m) <= limit:
        return True
    match: dict[str, int] = {}
    for i, c in enumerate(a):
        match[c] = match.get(c, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    for j, c in enumerate(b, 1):
        eq = match.get(c, 0)
        flat = eq | down
        cross = (((eq & up) + up) ^ up) | eq
        rise, fall = down | (full & ~(cross | up)), up & cross
        score += 1 if rise & top else -1 if fall & top else 0
        rise = ((rise << 1) | 1) & full
        up = ((fall << 1) & full) | (full & ~(flat | rise))
        down = rise & flat
        if not j & 31 and j <= n:
            low = (1 << j) - 1
            if j + (up & low).bit_count() - (down & low).bit_count() - abs(n - m) > limit:
                return False
    return score <= limit


def gathered(batches: Iterator[pa.RecordBatch], size: int = 1 << 24) -> Iterator[pa.Table]:
    """Batches put together up to about `size` bytes."""
    held, total = [], 0
    for batch in batches:
        held.append(batch)
        total += batch.nbytes
        if total >= size:
            yield pa.Table.from_batches(held)
            held, total = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _limit(n: Column, similarity: float) -> Column:
    return F.floor(n * (1 - similarity) + 1e-9).cast("int")


def line_groups(docs: DataFrame, found: DataFrame, shared: DataFrame, similarity: float) -> DataFrame:
    """node, component of the normal forms that have links; `shared` are the keys that several have."""
    used = shared.select("node").distinct()
    first = found.groupBy("node").agg(F.min(F.struct("id", "mark", "line")).alias("at"), F.first("chars").alias("chars"), F.first("s1").alias("s1"), F.first("s2").alias("s2"))
    forms = common.written(first.join(used, "node"), compression="zstd")
    traits = forms.select("node", "chars", "s1", "s2")
    # A document gives the lines it stands for; its text moves once.
    spots = forms.select("node", "at.*").groupBy("id", "mark").agg(F.collect_list(F.struct("line", "node")).alias("spots"))
    texts = common.named(docs.where("text IS NOT NULL")).select("id", "mark", "text").dropDuplicates(["id", "mark"]).join(spots, ["id", "mark"])
    texts = common.written(texts.select("text", "spots").mapInArrow(forms_of, "node long, form string"), compression="zstd")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in gathered(batches):
            x, y = (rows.column(c).to_pylist() for c in ("fa", "fb"))
            yield from rows.select(["a", "b"]).filter(pa.array(manypairs.within(x, y, rows.column("limit").to_numpy(), within))).to_batches()

    def likely(pairs: DataFrame) -> DataFrame:
        a, b = (traits.select(F.col("node").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in ("chars", "s1", "s2"))) for k in "ab")
        differ = F.bit_count(F.col("s1_a").bitwiseXOR(F.col("s1_b"))) + F.bit_count(F.col("s2_a").bitwiseXOR(F.col("s2_b")))
        apart = F.abs(F.col("chars_a") - F.col("chars_b"))
        bits = F.when(F.greatest("chars_a", "chars_b") < BRIEF, BRIEF_BITS).otherwise(BITS)
        return pairs.join(a, "a").join(b, "b").where((differ <= bits) & (apart <= _limit(F.greatest("chars_a", "chars_b"), similarity))).select("a", "b")

    def check(close: DataFrame) -> DataFrame:
        x, y = (texts.select(F.col("node").alias(k), F.col("form").alias(f"f{k}")) for k in "ab")
        both = close.join(x, "a").join(y, "b").withColumn("limit", _limit(F.greatest(F.char_length("fa"), F.char_length("fb")), similarity))
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return both.repartition(parts).mapInArrow(near, "a long, b long")

    def may(x: list[bytes], y: list[bytes]) -> np.ndarray:
        p, q = (np.frombuffer(b"".join(t), ">u8").reshape(-1, 3).astype(np.uint64) for t in (x, y))
        differ = sum(np.bitwise_count(p[:, None, k] ^ q[None, :, k]).astype(np.int16) for k in (1, 2))
        chars, others = p[:, None, 0].astype(np.int64), q[None, :, 0].astype(np.int64)
        bits = np.where(np.maximum(chars, others) < BRIEF, BRIEF_BITS, BITS)
        return (differ <= bits) & (np.abs(chars - others) <= np.floor(np.maximum(chars, others) * (1 - similarity) + 1e-9))

    # Every member of a key with the key's least one and with the next one in an order that is the same for all keys, so that lines which
    # share many keys are one pair.
    salted = shared.withColumn("salt", F.pmod(F.xxhash64("node"), F.ceil(F.col("times") / components.CHAIN)))
    after = Window.partitionBy("key", "salt").orderBy("node")
    chain = salted.select(F.col("node").alias("a"), F.lead("node").over(after).alias("b")).where("b IS NOT NULL")
    star = shared.where("node != hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    links = common.written(check(likely(star.unionByName(chain).distinct())))
    group = components.components(links)
    # Keys of FEW members are done: these pairs are all they have. Of the others, what is still in several components is compared in full.
    rest = components.split(shared.where(F.col("times") > FEW), group)
    common.removed(shared)
    if rest.isEmpty():
        common.removed(rest, links, forms, texts)
        return group
    packed = traits.select("node", F.concat(*(F.unhex(F.lpad(F.hex(c), 16, "0")) for c in ("chars", "s1", "s2"))).alias("trait"))
    pairs = common.written(components.crossed(rest, packed, may))
    common.removed(rest)
    # The texts of so many pairs at a time go through the shuffle.
    shares = min(SHARES, 1 + pairs.count() // SHARE)
    share = F.pmod(F.xxhash64("a", "b"), F.lit(shares))
    more = [common.written(check(pairs.where(share == k))) for k in range(shares)]
    every = reduce(DataFrame.unionByName, more)
    group = group if every.isEmpty() else components.components(links.unionByName(every))
    common.removed(pairs, *more, links, forms, texts)
    return group


def deduplicated(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """`docs` with the kept lines as text, and n_lines and n_dropped."""
    docs = docs.drop("n_lines", "n_dropped")
    keyed = occurrences(docs, min_words)
    # The keys are most of the table and of no use once the shared ones are known.
    shared = components.shared_keys(keyed.select(F.explode("keys").alias("key"), "node"), PASSES)
    found = common.written(keyed.drop("keys"), compression="zstd")
    common.removed(keyed)
    group = line_groups(docs, found, shared, similarity)
    spot = F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "mark", "line")
    lines = found.join(group, "node", "left").select("id", "mark", "doc_id", "line", F.coalesce("component", "node").alias("class"))
    lines = common.written(lines)
    common.removed(found)
    first = lines.groupBy("class").agg(F.min(spot).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").select("class", "first")
    drops = lines.join(first, "class").where(spot != F.col("first"))
    drops = common.written(drops.groupBy("id", "mark").agg(F.collect_set("line").alias("_drops")))
    common.removed(lines)
    names = docs.columns
    rows = common.named(docs.select(*(F.col(c).alias(f"_{k}") for k, c in enumerate(names)), F.col("doc_id"), F.col("text")))
    joined = rows.join(drops, ["id", "mark"], "left").drop("id", "mark", "doc_id").select(*(f"_{k}" for k in range(len(names))), "text", "_drops")
    own = names.index("text")
    schema = T.StructType([*(T.StructField(f"_{k}", f.dataType) for k, f in enumerate(docs.schema)), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    schema[f"_{own}"].dataType = T.StringType()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches):
            texts, counts, dropped = [], [], []
            for text, drop in zip(piece.column("text").to_pylist(), piece.column("_drops").to_pylist(), strict=True):
                if text is None:
                    texts.append(None), counts.append(0), dropped.append(0)
                    continue
                every, gone = text.split("\n"), set(drop or ())
                texts.append("\n".join(x for k, x in enumerate(every) if k not in gone) if gone else text)
                counts.append(len(every)), dropped.append(len(gone))
            out = piece.select([f"_{k}" for k in range(len(names))]).set_column(own, f"_{own}", pa.array(texts, pa.string()))
            yield from out.append_column("n_lines", pa.array(counts, pa.int64())).append_column("n_dropped", pa.array(dropped, pa.int64())).to_batches()

    return joined.mapInArrow(work, schema).toDF(*names, "n_lines", "n_dropped")


def op3_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = deduplicated(common.table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.char_length("text").cast("long").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op3_lines": op3_lines}
ORACLE: dict[str, str] = {}
