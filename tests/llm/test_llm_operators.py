"""Operators on odd rows, empty tables and small plain comparisons."""

import hashlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from callweave.llm import bpe, chat, common, components, jaccard, lines, media, mixing, pii, pitmanyor, quality, spotsigs
from odd_rows import CLASHING, ROWS

SMALL = "/root/testdata/sf0.001"
TOKENS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def kept(rows):
    """Columns with clashing names come through where the operator does not write them itself."""
    return all(r[c] == "kept" for r in rows for c in CLASHING if c in rows[0].__fields__ and not isinstance(r[c], (bytes, float, list, bytearray)))


def test_pii(spark, odd, none):
    out = pii.found(odd, pii.fit(odd)).collect()
    assert len(out) == len(ROWS) and kept(out) and all(not r.spans for r in out)
    assert pii.found(none, pii.fit(none)).count() == 0


def test_language_model(spark, odd, none):
    out = {r.doc_id: r for r in pitmanyor.scored(odd, common.key_of(F.col("doc_id")) % 5 != 1).collect()}
    assert out[3].n_tokens == out[2].n_tokens == 1 and out[2].score == out[3].score and out[6].n_tokens == 30001
    assert all(np.isfinite(r.score) and r.score < 0 for r in out.values())
    assert pitmanyor.scored(none, F.lit(True)).count() == 0


def test_lines(spark, odd, none):
    out = lines.deduplicated(odd).collect()
    assert len(out) == len(ROWS) and kept(out)
    texts = {r.doc_id: r.text for r in out}
    assert texts[1] == ROWS[0][1] and texts[5] == "" and texts[2] is None and texts[6] == ROWS[6][1]
    assert lines.deduplicated(none).count() == 0
    near = "this is a rather long line of text that many documents of the set share with a few small changes in it"
    docs = spark.createDataFrame([(3, f"first\n{near}"), (1, f"{near} x\nother line that is of no other document here"), (2, near.replace("rather", "rathEr")), (4, "short line\nshort line")], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.deduplicated(docs).collect()}
    assert got[1][1:] == (2, 0) and got[2] == ("", 1, 1) and got[3] == ("first", 2, 1) and got[4] == ("short line\nshort line", 2, 0)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines_recall(spark):
    """Pairs of lines with words changed, put in or left out: every pair within the edit similarity is found, and no other."""
    draw = np.random.default_rng(7)
    word = lambda: "".join(draw.choice(list("abcdefghijklmnopqrstuvwxyzé"), draw.integers(3, 9)))
    rows, near = [], set()
    for size, changes in ((5, 1), (6, 1), (9, 1), (10, 1), (10, 2), (15, 1), (15, 3), (25, 1), (25, 2), (50, 1), (50, 3)):
        for k in range(20):
            one = [word() for _ in range(size)]
            two = list(one)
            for at in sorted(draw.choice(size, changes, replace=False), reverse=True):
                two[at : at + 1] = [[word()], [], [two[at], word()]][k % 3 if size > 5 else 2 * (k % 2)]
            a, b = " ".join(one), " ".join(two)
            if edits(a, b) <= np.floor(max(len(a), len(b)) * 0.2 + 1e-9):
                near.add(len(rows) + 1)
            rows += [(len(rows), a), (len(rows) + 1, b)]
    assert len(near) > 120
    out = lines.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in out if r.n_dropped} == near


def test_long_lines_of_few_words(spark):
    """Lines without spaces or letters take part by their length; texts in scripts without spaces are compared by edit similarity."""
    draw = np.random.default_rng(3)
    han, thai = ("".join(chr(base + i) for i in draw.integers(0, 48, 60)) for base in (0x4E00, 0x0E01))
    han = "".join(chr(0x4E00 + i) for i in draw.integers(0, 3000, 60)) + han
    key, mark, short = "Q" * 300, "2024-01-02 03:04:05.678901 | 77", "\u7b2c\u4e00\u7ae0"
    first = [han, thai, key, mark, short, "-- --"]
    second = [han[:30] + "\u9fa0\u9fa1" + han[31:], thai[:20] + thai[22:], key.lower(), mark, short, "-- --"]
    third = ["".join(reversed(han)), "2024-01-02 03:04:05.678902 | 77", "R" * 300]
    docs = spark.createDataFrame([(i, "\n".join(x)) for i, x in enumerate((first, second, third))], "doc_id long, text string")
    got = {r.doc_id: (r.text, r.n_dropped) for r in lines.deduplicated(docs).collect()}
    assert got == {0: ("\n".join(first), 0), 1: (f"{short}\n-- --", 4), 2: ("\n".join(third), 0)}


def test_media(spark, odd, none):
    out = media.loaded(media.stored(odd)).collect()
    assert len(out) == len(ROWS)
    for r in out:
        raw = (r.text or "").encode()
        assert bytes(r.payload) == media.padded(raw) and len(r.rgb) == 3 * r.height * r.width
    assert len({r.feature for r in out if r.doc_id in (2, 3)}) == 1
    assert media.loaded(media.stored(none)).count() == 0
    gone = media.loaded(spark.createDataFrame([(1, None)], "doc_id long, media binary")).first()
    assert gone.payload is None and gone.feature is None


def test_bpe(spark, odd, none):
    both = bpe.decode(bpe.encode(odd, *TOKENS), *TOKENS)
    out = both.collect()
    assert len(out) == len(ROWS) and all(bytes(r.decoded).decode() == (r.text or "") for r in out)
    lists = bpe.as_array(bpe.encode(odd.where("doc_id in (1, 3)"), *TOKENS)).collect()
    assert {r.doc_id: len(r.token_ids) for r in lists}[3] == 0 and all(0 <= i < 50256 for r in lists for i in r.token_ids)
    assert bpe.encode(none, *TOKENS).count() == 0


def test_quality(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (8, 0), (5, 1), (5, 1), (4, None), (None, 1)], "doc_id long, quality int")
    out = quality.classified(odd, labels).collect()
    assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert quality.classified(none, labels).count() == 0
    assert all(r.score == 0.5 and r.predicted == 1 for r in quality.classified(odd, labels.limit(0)).collect())


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.01"
    scores = quality.op6_quality(spark, folder).where("held_out")
    both = scores.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in both]) > 0.93
    assert np.mean([r.predicted for r in both if r.quality == 1]) > 0.95


def plain_classes(rows, n, percent):
    def grams(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())

    sets = [(i, grams(t)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    return {i: (len(s), least[find(k)]) for k, (i, s) in enumerate(sets)}


def test_jaccard(spark, odd, none):
    out = jaccard.near_classes(odd, 3, 90).collect()
    assert len(out) == len(ROWS)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in out}
    assert got[5] == (13, 1) and got[1][1] == 1 and got[2] == (0, 2) and got[4] == (0, 4) and got[None][1] is None
    assert jaccard.near_classes(none, 3, 90).count() == 0


def test_jaccard_chain(spark):
    """Copies that are near only through one another, in a group with no central member, against all pairs."""
    draw = np.random.default_rng(2)
    base, rows = [f"b{i}" for i in range(150)], []
    for i in range(60):
        words = list(base)
        for k in draw.choice(150, draw.integers(0, 4), replace=False):
            words[k] = f"c{draw.integers(0, 40)}"
        rows.append((int(i), " ".join(words)))
    rows += [(100 + i, " ".join(f"z{draw.integers(0, 9)}" for _ in range(8))) for i in range(30)]
    for n, percent in ((3, 90), (5, 80)):
        out = jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), n, percent).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain_classes(rows, n, percent)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 7), (101, 100)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_mixing(spark, odd, none):
    out = mixing.mixed(odd).collect()
    assert kept(out) and [r.position for r in out] == sorted(r.position for r in out)
    assert max(Counter((r.doc_id, r.text) for r in out).values()) <= 4  # a repeated row twice
    assert mixing.mixed(none).count() == 0
    rows = mixing.op8_mix(spark, SMALL).join(spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source"), "doc_id").collect()
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        assert r.taken <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        target[r.source] = r.target
    assert abs(sum(target.values()) - 1.5 * sum(r.size for r in rows)) < 1e-6 * sum(taken.values())
    assert all(0 < target[s] and 0 <= target[s] - taken[s] < largest[s] for s in target)


def test_mixing_long_document(spark):
    """A document longer than the rest of its source's target is passed over; what is taken keeps to the schedule."""
    rows = [(f"{s}{i}", s, 3 + i % 40) for s in "abc" for i in range(150)] + [("0", "b", 9000), ("n0", None, 5), ("n1", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id string, source string, n int").select("doc_id", "source", F.expr("repeat('w ', n)").alias("text"))
    # Ids of the long document that come early, midway and late in md5 order.
    for name in ("0", "x1", "x7"):
        these = docs.withColumn("doc_id", F.when(F.col("doc_id") == "0", name).otherwise(F.col("doc_id")))
        chosen = mixing.chosen(these, weights=(3.0, 0.7, 2.0), budget=0.6, fills=None).collect()
        taken, free, target = Counter(), {}, {}
        for r in chosen:
            target[r.source] = r.target
            taken[r.source] += r.copies * r.size
            base = int(r.target // r.source_size) if r.source_size else 0
            assert base <= r.copies <= base + 1
            if r.size and r.copies == base:
                free[r.source] = min(free.get(r.source, r.size), r.size)
        assert all(0 <= target[s] - taken[s] < free.get(s, 1e9) for s in target)
        out = mixing.mixed(these, weights=(3.0, 0.7, 2.0), budget=0.6).collect()
        assert len(out) == sum(r.copies for r in chosen) and not any(r.text and r.position == 1.0 for r in out)


def plain_signatures(text):
    import regex

    common_words, out, anchor = set(spotsigs.ANCHORS.split()), set(), "^"
    words = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    if not words:
        return out
    spots, content = [], []
    for w in words:
        if w in common_words:
            anchor = w
        else:
            content.append(w)
            if anchor:
                spots.append((anchor, len(content) - 1))
            anchor = None
    if anchor:
        spots.append((anchor, len(content)))
    pad = content + ["", ""]
    return {(a, pad[k], pad[k + 1]) for a, k in spots}


def test_spotsigs(spark, odd, none):
    out = spotsigs.edited(odd).collect()
    assert len(out) == len(ROWS)
    assert spotsigs.edited(none).count() == 0
    docs = common.table(spark, SMALL, "documents")
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in spotsigs.op9_spotsigs(spark, SMALL).collect()}
    for k, (i, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        mixed = text[: len(text) - half] + after[:half]
        assert got[i].edited_sha256 == hashlib.sha256(mixed.encode()).hexdigest()
        a, b, c = map(plain_signatures, (text, mixed, after))
        assert len(got[i].fingerprint.split()) == len(a)
        share = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert got[i].near_edited == pytest.approx(share(a, b)) and got[i].near_next == pytest.approx(share(a, c))


def test_spot_matches(spark):
    draw = np.random.default_rng(5)
    rows = []
    for i in range(40):
        words = [f"the {'abcdefghij'[j % 10]}{i // 4}{j} x{j}" for j in range(30)]
        for k in draw.choice(30, draw.integers(0, 4), replace=False):
            words[k] = f"the q{draw.integers(0, 99)} r"
        rows.append((i, " ".join(words)))
    prints = spotsigs.members(spotsigs.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")))
    names = {r.set: plain_signatures(r.text) for r in prints.collect()}
    want = {frozenset((a, b)) for a in names for b in names if a < b and len(names[a] & names[b]) >= 0.8 * len(names[a] | names[b])}
    assert {frozenset((r.a, r.b)) for r in spotsigs.matches(prints).collect()} == want and want


def test_chat(spark):
    rows = [(1, 0, "user", "### a: </turn>\n\\h\\s"), (1, 1, "assistant", "one"), (1, 2, "user", None), (1, 3, "assistant", "\\### two </turn>"), (1, 4, "user", "tail"), (2, 0, None, "x"), (None, 0, "assistant", "n"), (3, 0, "a: b", "z"), (3, 0, "a: b", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("example", F.lit(1))
    made = chat.examples(turns).collect()
    one = sorted((r for r in made if r.conv_id == 1), key=lambda r: r.example)
    assert [chat_loss(r) for r in one] == ["one", "\\### two </turn>", ""]
    read = {r.conv_id: r for r in chat.digests(turns).collect()}
    text = "".join(f"{a or ''}\n{b or ''}\n" for c, _, a, b in rows if c == 1)
    assert read[1].turns_sha256 == hashlib.sha256(text.encode()).hexdigest() and read[1].n_turns == 5 and read[3].n_turns == 2
    assert read[1].loss_sha256 == hashlib.sha256("one\\### two </turn>".encode()).hexdigest() and read[2].loss_chars == 0
    assert chat.examples(turns.limit(0)).count() == 0


def chat_loss(r):
    out = r.text[r.loss_start : r.loss_end]
    for raw, written in reversed(chat.ESCAPES):
        out = out.replace(written, raw)
    return out


def test_pipeline_stages(spark, odd, none):
    labels = f"{SMALL}"
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "mix", "byte_bpe"]
    for rows in (odd.select(*corpus_pipeline.COLUMNS), none.select(*corpus_pipeline.COLUMNS)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, labels)
            assert name == "byte_bpe" or out.columns == corpus_pipeline.COLUMNS
            assert out.count() <= 2 * rows.count()
    near = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL)
    want = {i for i, (n, c) in plain_classes([(r.doc_id, r.text) for r in docs.collect()], 5, 80).items() if n == 0 or i == c}
    assert {r.doc_id for r in near.collect()} == want


def test_crossed(spark):
    """All pairs across components of a key with several chunks, each once though keys share pairs."""
    draw = np.random.default_rng(4)
    rows = [(key, node, node % 3, 700) for key in range(6) for node in draw.choice(40, 25, replace=False).tolist()]
    rest = spark.createDataFrame(rows, "key long, node long, component long, times long")
    traits = spark.createDataFrame([(i, bytes([i])) for i in range(40)], "node long, trait binary")
    got = [(r.a, r.b) for r in components.crossed(rest, traits, lambda x, y: np.ones((len(x), len(y)), bool)).collect()]
    of = {}
    for key, node, _, _ in rows:
        of.setdefault(key, set()).add(node)
    want = {(a, b) for s in of.values() for a in s for b in s if a < b and a % 3 != b % 3}
    assert len(got) == len(set(got)) and set(got) == want
