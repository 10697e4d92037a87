"""Alignment counts, incremental clustering, token files, seatings and line candidates against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from callweave.llm import alignment, clustering, common, components, lines, perfecthash, pitmanyor, quality, tokenfiles, vocabularies, wavelet
from callweave.llm.bpe import FROM_SHOWN
from odd_rows import CLASHING, ROWS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [r[1] for r in ROWS] + ["one  two ", "a ▁ b", "<|endoftext|> and <s> or <0x0A>", " lead", "x" * 5000, "1 2\t3\r\n", "日本語 😀 ünïcödé", "\u0000 nul"]


# --- cross-tokenizer alignment ----------------------------------------------------------------------------------

def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 20_000))
    hash_ = perfecthash.PerfectHash(perfecthash.build(keys))
    assert len(hash_) == len(keys) and sorted(hash_.index(keys)) == list(range(len(keys)))
    assert 8 * len(perfecthash.build(keys)) / len(keys) < 4
    assert len(perfecthash.PerfectHash(perfecthash.build(keys[:0]))) == 0


def plain_alignment(texts):
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    rows, counts = [], Counter()
    for t in texts:
        a, b = (one.encode(" " + t, add_special_tokens=False).ids, two.encode(t)) if t else ([], [])
        bytes_a = [bytes(FROM_SHOWN[c] for c in one.id_to_token(i)) for i in a]
        names = [two.id_to_piece(i) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in names]
        if not t or b"".join(bytes_a) != (" " + t).encode() or b"".join(bytes_b) != (" " + t).encode():
            rows.append(([], [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(x) for x in k]).tolist() for k in (bytes_a, bytes_b))
        links, groups, i, j = [], [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(e) + 1, ends_b.index(e) + 1
            groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
            links.append((a[p - 1], b[q - 1]))
            i, j = p, q
        rows.append((a, b, groups, links))
        counts.update(links)
    best: dict = {}
    for (x, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    return [(len(a), len(b), len(g), len(k), sum(counts[x] == best[x[1]] for x in k), sum(counts[x] for x in k), ";".join(g)) for a, b, g, k in rows]


@pytest.mark.parametrize("sent", [alignment.SENT, 0])
def test_alignment(spark, sent, monkeypatch):
    """Both ways of the second pass, with several segments, salts and levels of the tree."""
    monkeypatch.setattr(alignment, "SEGMENT", 1000)
    monkeypatch.setattr(alignment, "SUMS", 50)
    texts = [*TEXTS, TEXTS[0], TEXTS[4]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5).withColumn("n_a", F.lit("old")).withColumn("kept", F.lit(1))
    got = sorted(alignment.alignments(docs, A, B, sent).collect(), key=lambda r: r.doc_id)
    assert [tuple(r[c] for c in alignment.COLUMNS) for r in got] == plain_alignment(texts) and all(r.kept == 1 for r in got)


def test_alignment_of_odd_tables(spark, odd, none):
    out = alignment.alignments(odd, A, B).collect()
    assert len(out) == len(ROWS) and all(r[c] == "kept" for r in out for c in CLASHING)
    assert all((r.n_a, r.groups) == (0, "") for r in out if not r.text)
    assert alignment.alignments(none, A, B).count() == 0 and alignment.alignments(none, A, B, 0).count() == 0


def test_vocabularies_equal_the_libraries():
    one, two = (vocabularies.loaded(k, open(p, "rb").read()) for k, p in ((vocabularies.ByteLevel, A), (vocabularies.Pieces, B)))
    library, plain, pieces = Tokenizer.from_file(A), Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    plain.encode_special_tokens = True
    draw = np.random.default_rng(2)
    parts = [" ", "  ", "\n", "\t", "a", "the", "'s", "'ll", "é", "日本", "😀", "▁", "1", "23", "!", "<|endoftext|>", " ", " ", "\u0000", "\r\n", "Ω", "<0x0A>", "</s>"]
    texts = ["".join(draw.choice(parts, draw.integers(1, 30))) for _ in range(1500)]
    texts = [t for t in [*texts, *TEXTS] if t]
    assert one.ranks is not None
    for t, got in zip(texts, two.encode(texts)):
        assert one.encode(t).tolist() == plain.encode(t, add_special_tokens=False).ids
        assert one.encode_as_library(t).tolist() == library.encode(t, add_special_tokens=False).ids
        want = pieces.encode(t)
        whole = b"".join(two.tokens[i] for i in want) == (" " + t).encode()
        assert (got is not None) == whole and (got is None or got.tolist() == want)


# --- clustering -------------------------------------------------------------------------------------------------

def plain_clusters(rows, s):
    def fine(v):
        return v is not None and len(v) == s.width and all(x is not None and math.isfinite(x) and abs(x * s.scale) <= 1 << clustering.LIMIT_BITS for x in v)

    kept = [(i, [math.floor(s.scale * float(np.float32(x))) for x in v]) for i, v in rows if fine(v)]
    name = lambda i: "null" if i is None else str(i)
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"{s.salt}:{name(r[0])}".encode()).hexdigest(), np.array(r[1], "<i8").tobytes()))
    c = [v for _, v in first[: s.clusters]]
    near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v, k)), n) for n, k in enumerate(c))
    for _ in range(s.rounds):
        own = [near(v)[1] for _, v in kept]
        c = [[sum(x) // len(g) for x in zip(*g)] if (g := [v for (_, v), o in zip(kept, own) if o == k]) else c[k] for k in range(len(c))]
    return sorted(((-1 if i is None else i), near(v)[1], near(v)[0]) for i, v in kept), c


def test_clusters(spark):
    s = clustering.Settings(clusters=5, width=4, scale=256, rounds=4)
    draw = np.random.default_rng(4)
    rows = [(i, [float(x) for x in draw.normal(size=4).astype(np.float32)]) for i in range(200)]
    rows += [(3, rows[3][1]), (7, rows[9][1]), (None, [0.5, -0.25, 1.0, 2.0]), (300, None), (301, []), (302, [1.0] * 5), (303, [1.0, None, 0.0, 0.0]),
             (304, [math.nan, 0.0, 0.0, 0.0]), (305, [math.inf, 0.0, 0.0, 0.0]), (306, [1e30, 0.0, 0.0, 0.0]), (307, [-1e5, 1e5, 0.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("old")).repartition(6)
    out, centroids = clustering.clustered(table, s)
    want, last = plain_clusters(rows, s)
    assert sorted((-1 if r.vec_id is None else r.vec_id, r.cluster, r.distance) for r in out.collect()) == want and centroids.tolist() == last
    told = clustering.described(out, centroids).collect()
    assert {r.inertia for r in told} == {sum(d for _, _, d in want)}
    assert all(r.centroid_sha256 == hashlib.sha256(",".join(map(str, last[r.cluster])).encode()).hexdigest() for r in told)
    few, c = clustering.clustered(table.where("vec_id < 2"), s)
    assert few.count() == 2 and len(c) == 2
    none, c = clustering.clustered(table.limit(0), s)
    assert clustering.described(none, c).count() == 0


# --- token files ------------------------------------------------------------------------------------------------

def test_wavelet_matrix(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK", 256)
    ids = np.random.default_rng(1).zipf(1.3, 3000).clip(0, 50256).astype(np.uint32)
    writer = wavelet.Writer()
    for doc, part in ((9, ids[:1000]), (None, ids[1000:1000]), (4, ids[1000:])):
        writer.add(doc, part)
    m = wavelet.WaveletMatrix(writer.content())
    assert (m.everything() == ids).all() and m.docs == [9, None, 4] and m.starts.tolist() == [0, 1000, 1000, 3000]
    assert [m.access(i) for i in (0, 1, 255, 256, 257, 2999)] == ids[[0, 1, 255, 256, 257, 2999]].tolist()
    for t in (0, 1, 2, 7, 300, 50256, 65535, 1 << 20):
        assert m.positions(t) == np.flatnonzero(ids == t).tolist() and m.count(t, 100, 2001) == (ids[100:2001] == t).sum()
        assert m.positions(t, 500, 700) == (500 + np.flatnonzero(ids[500:700] == t)).tolist()
    with pytest.raises(IndexError):
        m.access(3000)
    assert len(wavelet.WaveletMatrix(wavelet.Writer().content()).everything()) == 0


def test_token_files(spark, odd, none, monkeypatch):
    docs = spark.createDataFrame([(100 - k, t) for k, t in enumerate(TEXTS)] + [(None, "no id"), (50, "same id"), (50, "same id")], "doc_id long, text string").repartition(4)
    monkeypatch.setattr(tokenfiles, "FILE_TOKENS", 500)
    table = tokenfiles.files(docs, A, file_tokens=500)
    library = Tokenizer.from_file(A)
    want = sorted(((r.doc_id is not None, r.doc_id or 0), [*library.encode(r.text or "", add_special_tokens=False).ids, 2]) for r in docs.collect())
    back = tokenfiles.documents(table).join(tokenfiles.offsets(table), ["part", "number"]).collect()
    back.sort(key=lambda r: r.base + r.local)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in back] == [k for k, _ in want]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in back] == [i for _, i in want]
    assert [r.base + r.local for r in back] == np.cumsum([0] + [len(i) for _, i in want])[:-1].tolist() and table.count() > 10
    every = np.array([i for _, ids in want for i in ids])
    assert {r.token: r.n for r in tokenfiles.token_counts(table, [2, 262, 50256]).collect()} == {t: int((every == t).sum()) for t in (2, 262, 50256)}
    assert sorted(r.position for r in tokenfiles.occurrences(table, [262]).collect()) == np.flatnonzero(every == 262).tolist()
    asked = spark.createDataFrame([(int(p),) for p in (0, 7, 499, 500, 501, len(every) - 1)], "position long")
    assert {r.position: r.token for r in tokenfiles.tokens_at(table, asked).collect()} == {p: int(every[p]) for p in (0, 7, 499, 500, 501, len(every) - 1)}
    assert tokenfiles.documents(tokenfiles.files(odd, A)).count() == len(ROWS)
    assert tokenfiles.documents(tokenfiles.files(none, A)).count() == 0 and tokenfiles.offsets(tokenfiles.files(none, A)).count() == 0


def test_end_ids_and_checksums(spark):
    folder = "/root/testdata/sf0.001"
    library, at = Tokenizer.from_file(A), 0
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenfiles.op13_wavelet(spark, folder).collect()}
    for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect():
        ids = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4")
        assert got[r.doc_id] == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


# --- language model ---------------------------------------------------------------------------------------------

def sequential_tables(counts, base, discount, strength, sweeps, seed):
    """Mean number of tables of one restaurant, one customer at a time."""
    draw = np.random.default_rng(seed)
    tables, seen = [[c] for c in counts], []
    for sweep in range(sweeps):
        for w, c in enumerate(counts):
            for _ in range(min(c, 60)):
                sizes = np.array(tables[w], float)
                k = draw.choice(len(sizes), p=sizes / sizes.sum())
                tables[w][k] -= 1
                if not tables[w][k]:
                    tables[w].pop(k)
                new = (strength + discount * sum(map(len, tables))) * base[w]
                rates = np.array([x - discount for x in tables[w]] + [new])
                k = draw.choice(len(rates), p=rates / rates.sum())
                if k == len(tables[w]):
                    tables[w].append(1)
                else:
                    tables[w][k] += 1
        if sweep >= sweeps // 3:
            seen.append(sum(map(len, tables)))
    return np.mean(seen)


def test_seatings_against_a_sequential_sampler():
    counts, base = np.array([400, 120, 60, 30, 10, 5, 3, 2, 1, 1]), np.full(10, 0.1)
    want = np.mean([sequential_tables(counts, base, 0.5, 0.5, 150, seed) for seed in range(2)])
    s, got = pitmanyor.Settings(), []
    for seed in range(12):
        level = pitmanyor.Level(np.zeros(10, np.int64), 0.5, 0.5, np.random.default_rng(seed))
        for sweep in range(60):
            level.arrange(counts, base)
            for _ in range(s.steps):
                level.step(base, s.share)
            assert (np.bincount(level.dish, level.size, 10) == counts).all() and (np.diff(level.dish) >= 0).all()
            if sweep >= 20:
                got.append(len(level.dish))
    assert abs(np.mean(got) - want) < 0.2 * want
    # Customers that come and go leave a seating of just those that are there.
    fewer = np.array([100, 200, 0, 30, 10, 5, 3, 2, 1, 4])
    level.arrange(fewer, base)
    assert (np.bincount(level.dish, level.size, 10).astype(int) == fewer).all() and (level.size > 0).all()


def test_subtrees_are_whole():
    for seed in range(60):
        draw = np.random.default_rng(seed)
        keys = np.unique((draw.integers(0, 50, 400) << 32) | (draw.integers(0, 5, 400) << 24) | (draw.integers(0, 6, 400) ** 2 << 8) | draw.integers(0, 9, 400))
        keys = keys[np.lexsort((keys, keys >> 24 & 255, keys >> 8 & 0xFFFF))]
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 7]), pa.array(np.ones(len(keys[i : i + 7]), int))], ["key", "n"]) for i in range(0, len(keys), 7)]
        together = int(draw.integers(1, 200))
        runs = list(pitmanyor._subtrees(iter(batches), together))
        assert (np.concatenate([k for k, *_ in runs]) == keys).all()
        seen, ended = set(), set()
        for k, _, part, ends in runs:
            pairs, thirds = set((k >> 8 & 0xFFFF).tolist()), set((k >> 8 & 0xFFFFFF).tolist())
            assert not thirds & seen and not pairs & ended and (len(pairs) == 1 if part else len(k) <= together)
            seen |= thirds
            ended |= pairs if ends else set()


def test_base_score_and_counts(spark):
    rows = [(1, "the cat the dog"), (2, "The cat\tsat"), (3, None), (4, "a fish"), (5, "the the the")]
    learn = {1, 2, 3}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tokens = {i: [*(t or "").lower().split(), "</s>"] for i, t in rows}
    seen = Counter(x for i in learn for x in tokens[i])
    n, v = sum(seen.values()), len(seen)
    for s in (pitmanyor.Settings(), pitmanyor.Settings(together=3)):
        for r in pitmanyor.scored(docs, F.col("doc_id") <= 3, s).collect():
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens[r.doc_id]), sum(seen[x] > 0 for x in tokens[r.doc_id]), n)
            assert abs(r.base_score - sum(math.log10((seen[x] + 0.5) / (n + 0.5 * (v + 1))) for x in tokens[r.doc_id])) < 1e-9
            assert math.isfinite(r.score) and r.score < 0


def test_many_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(pitmanyor, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(pitmanyor, "REPEATS", 50)
    rows = [(1, "the very same text again")] * 500 + [(k, f"another text {k}") for k in range(2, 30)]
    out = pitmanyor.scored(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).collect()
    assert len(out) == len(rows) and len({(r.score, r.base_score) for r in out if r.doc_id == 1}) == 1
    docs = lines.deduplicated(spark.createDataFrame([(1, "one line of text that is long enough\nand another line of five words")] * 300 + [(2, "one line of text that is long enuogh")], "doc_id long, text string"))
    assert {(r.doc_id, r.text) for r in docs.collect()} == {(1, rows and "one line of text that is long enough\nand another line of five words"), (2, "")}


# --- quality classifier, lines ----------------------------------------------------------------------------------

def test_quality_where_arrow_is_off(spark):
    before = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled")
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "false")
    try:
        docs = spark.createDataFrame([(k, "good words here" if k % 2 else "bad bad bad") for k in range(60)], "doc_id long, text string")
        labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
        out = quality.classified(docs, labels).collect()
        assert all(r.predicted == r.doc_id % 2 for r in out)
    finally:
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", before)


def test_quality_sample_is_bounded_by_features(spark):
    docs = spark.createDataFrame([(k, f"word{k} other{k} text") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    weights, bias = quality.fit(docs, labels, quality.Settings(max_features=1))
    assert not weights.any() and bias == 0.0


def test_line_signs_and_early_exit():
    draw = np.random.default_rng(1)
    from test_llm_operators import edits

    for _ in range(400):
        a = "".join(draw.choice(list("abc"), draw.integers(0, 90)))
        b = "".join(draw.choice(list("abcd"))if draw.random() < 0.15 else c for c in a) if draw.random() < 0.8 else "".join(draw.choice(list("abc"), draw.integers(0, 90)))
        limit = int(draw.integers(0, 40))
        assert lines.within(a, b, limit) == (edits(a, b) <= limit)
    some = ["Hello, World! this is A test", "", "123 !!", "x", "é ü 日本 wörds " * 40, " ".join(f"w{i}" for i in range(900))]
    data = np.frombuffer("\n".join(some).encode(), np.uint8)
    signs = lines.line_signs(data, np.concatenate([[0], np.flatnonzero(data == 10) + 1, [len(data)]]))
    for k, line in enumerate(some):
        form = np.frombuffer(f" {lines.normal(line)} ".encode(), np.uint8)
        if not lines.normal(line):
            continue
        at = np.arange(max(1, len(form) - lines.GRAM + 1))
        grams = lines._HASHER.runs(lines._HASHER.sums(form), at, np.minimum(at + lines.GRAM, len(form)))
        for half in range(2):
            bits = np.unpackbits(common.mix(grams + np.uint64((half + 1) * 0x9E3779B97F4A7C15 % (1 << 64))).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            assert signs[k, half] == np.packbits(2 * bits.sum(0) > len(grams), bitorder="little").view(np.uint64)[0]


def test_base_score_does_not_depend_on_neighbours(spark):
    """Rows of one text have one base score, whatever stands before them in their block."""
    rows = [(k, "one text " * (k % 7) if k % 3 else "the same words all over") for k in range(300)]
    out = pitmanyor.scored(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), F.lit(True)).collect()
    assert len({r.base_score for r in out if r.doc_id % 3 == 0}) == 1


def test_passes_give_the_same_keys(spark):
    index = spark.createDataFrame([(k * 7919 - 50_000, n) for k in range(300) for n in range(k % 4 + 1)], "key long, node long")
    one, four = (sorted(map(tuple, components.shared_keys(index, n).collect())) for n in (1, 4))
    assert one == four and one


def test_gathering_holds_little_at_a_time():
    """A task's n-grams are made from pieces of bounded size, and counted as a plain count has them."""
    import tracemalloc

    draw = np.random.default_rng(3)
    texts = ["".join(chr(97 + c) if c < 26 else " " for c in draw.integers(0, 30, 200_000)) for _ in range(30)]
    batch = pa.RecordBatch.from_arrays([pa.array([k % 3 > 0 for k in range(len(texts))]), pa.array(texts)], ["learn", "text"])
    tracemalloc.start()
    keys, n = [], []
    for found in pitmanyor.counted(iter([batch])):
        keys.append(found.column("key").to_numpy().copy()), n.append(found.column("n").to_numpy().copy())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 6 MB of text whose n-grams are nearly all distinct; the 16 bytes of each key that goes out are held here.
    assert peak < 16 * sum(map(len, keys)) + (160 << 20)
    out, n = np.concatenate(keys), np.concatenate(n)
    got, at = np.unique(out, return_inverse=True)
    every = [np.concatenate([*(f(pa.chunked_array([[t]]))[0] for f in (pitmanyor.grams, pitmanyor.words)), [pitmanyor.END_WORD]]) for t in texts]
    want, of = np.unique(np.concatenate(every), return_inverse=True)
    learnt = np.repeat([k % 3 > 0 for k in range(len(texts))], [len(e) for e in every])
    assert (got == want).all() and (np.bincount(at, n) == np.bincount(of, learnt)).all()


def test_values_are_looked_up_in_place():
    draw = np.random.default_rng(4)
    key = np.unique(np.concatenate([draw.integers(0, 1 << 48, 5000), [0, (1 << 48) - 1]]))
    gram = key[draw.integers(0, len(key), 150_000)]
    value = draw.random(len(key))
    assert (pitmanyor._looked_up(gram, key, value) == value[np.searchsorted(key, gram)]).all()
    assert len(pitmanyor._looked_up(gram[:0], key, value)) == 0
