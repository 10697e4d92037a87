"""The operators' own logic against plain versions, without tables where possible."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken

from callweave.llm import bpe, jaccard, jpeg, lines, media, pii, pitmanyor, quality

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def plain_spans(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            good = [
                True,
                kind != 1 or all(int(p) <= 255 for p in m.group().split(".")),
                kind != 2 or 13 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0,
                kind != 3 or 9 <= len(digits) <= 15,
            ]
            if all(good):
                out.append((kind, *m.span()))
    return out


def test_patterns():
    draw = random.Random(4)
    for _ in range(5000):
        text = "".join(draw.choice("0123456789.@+- ()ab%é\n") for _ in range(draw.randint(0, 80)))
        assert pii.base_spans(text) == plain_spans(text)
    # Long runs take linear time.
    for text in ("9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "@" * 100_000):
        pii.base_spans(text)


def test_query_counts(spark, tmp_path):
    """The query's columns against the plain patterns, with several spans and kinds in a text."""
    draw = random.Random(6)
    parts = ["a.b@c.de", "1.2.3.4", "4111 1111 1111 1111", "+44 20 7946 0958", "word", "999.1.1.1", "x@y", "+1 2"]
    texts = [" ".join(draw.choice(parts) for _ in range(draw.randint(0, 9))) for _ in range(60)] + [None, ""]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in pii.op1_pii(spark, str(tmp_path)).collect()}
    for k, text in enumerate(texts):
        spans = sorted(plain_spans(text or ""))
        joined = ",".join(f"{pii.KINDS[s[0]]}:{s[1]}:{s[2]}" for s in spans)
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == kind for s in spans) for kind in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_span_model():
    draw = random.Random(1)
    phone = lambda: f"+1 ({draw.randint(200, 999)}) 555-{draw.randint(1000, 9999)}"

    def card():
        while True:
            c = "4" + "".join(draw.choice("0123456789") for _ in range(15))
            if pii.luhn(c):
                return c

    texts = [f"the words of {draw.choice([phone, card])()} and then {draw.choice([phone, card])()} in version {i}.0 here" for i in range(60)]
    texts += [f"number {draw.randint(10**15, 10**16 - 1)} of it" for _ in range(30)]
    seen = [e for t in texts for e in pii.examples(t)]
    model = pii.train([a for a, _ in seen], [s for _, s in seen])
    fused = f"call {phone()} {card()} now"
    assert pii.base_spans(fused) == []
    assert [s[0] for s in pii.spans_of(fused, model)] == [2, 3]
    assert pii.spans_of("Licensed under version 3.0 of it.", model) == []


def test_forward_is_the_sum_over_readings():
    t = pii.Tokens(["a 12 34 b", "7"])
    model = pii.Model()
    draw = np.random.default_rng(0)
    model.segment, model.token = draw.normal(size=model.segment.shape), draw.normal(size=model.token.shape)
    segment, token = model.scores(t)
    value = pii.forward(t, segment, token, pii._logsum)

    def every(first, p):
        if p == 0:
            return [0.0]
        out = [x + token[first + p - 1] for x in every(first, p - 1)]
        for back in range(1, min(pii.LONGEST, p) + 1):
            for k in range(len(pii.KINDS)):
                if np.isfinite(segment[k, first + p - back, back - 1]):
                    out += [x + segment[k, first + p - back, back - 1] for x in every(first, p - back)]
        return out

    for r in range(2):
        first, n = t.first[r], t.first[r + 1] - t.first[r]
        assert np.isclose(value[first + r + n], np.logaddexp.reduce(every(first, n)))


def test_pitman_yor_is_a_law():
    """For a context with all next symbols listed, predictive probabilities sum to one; a frequent dish is likelier."""
    draw = np.random.default_rng(3)
    seen = np.unique(draw.integers(0, 4, (200, 5)), axis=0)
    keys = np.concatenate([sum(row[j] << (8 * (5 - j)) for j in range(5)) + np.arange(256) for row in seen])
    n = np.where(draw.random(len(keys)) < 0.05, draw.integers(1, 400, len(keys)), 0)
    p, gram, tables = pitmanyor.sample(keys, n, (2, 3, 4, 5), np.full(len(np.unique(keys & 0xFFFFFF)), 1 / 256), pitmanyor.Settings(), 0)
    sums = np.add.reduceat(p, np.arange(0, len(keys), 256))
    assert np.allclose(sums, 1)
    assert p[n > 100].mean() > 20 * p[n == 0].mean()
    assert (tables <= np.bincount(np.searchsorted(gram, keys & 0xFFFFFF), n, len(gram))).all()


def test_symbols():
    key, first = pitmanyor.grams(pa.chunked_array([[" Ab\t c\n", None, ""]]))
    assert [chr(k & 255) for k in key[:6]] == ["a", "b", " ", "c", " ", "\xff"] and list(first) == [0, 6, 7, 8]
    assert key[0] >> 8 == (1 << 40) - 1 and key[6] == (1 << 48) - 1


def test_line_forms():
    texts = ["One, two three!\nfour5six", "", "Ünï x"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    starts = np.unique(np.concatenate([offsets, np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1]))
    count, form, _ = lines.line_hashes(np.frombuffer(data, np.uint8), starts)
    assert list(count) == [3, 2, 2]
    again = "one two   three".encode()
    assert lines.line_hashes(np.frombuffer(again, np.uint8), np.array([0, len(again)]))[1][0] == form[0]
    assert lines.normal("One, two  three! 4") == "one two three"


def test_bpe_equals_rank_encoder():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = bpe.read_ranks(f.read())
    ours = bpe.codec(bpe.model_bytes(ranks), public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(2)
    texts = ["", "\0\0 ▁ a▁b", "  \n\n x", "日本語 😀😀 ​", "a" * 5000, "ab" * 5000, " " * 999, "<|endoftext|> don't", "a\x1cb\x85c\xa0²¼ª"]
    texts += ["".join(chr(draw.choice([draw.randint(0, 127), draw.randint(128, 591), draw.randint(0x3040, 0x30FF)])) for _ in range(200)) for _ in range(60)]
    for text in texts:
        ids = ours.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == theirs.encode_ordinary(text), text
        assert ours.decode(ids) == text.encode()


def test_jpeg_round_trip():
    draw = np.random.default_rng(1)
    raw = [b"", bytes(range(256)), draw.bytes(5000), b"\x80" * 700, b"plain words of text " * 300]
    # Coefficients near zero: zero runs, ends of blocks and fresh bits of the second pass.
    raw += [bytes(draw.choice([127, 128, 129, 126], 3000).astype(np.uint8)), bytes(np.where(draw.random(6000) < 0.03, draw.integers(0, 256, 6000), 128).astype(np.uint8))]
    payloads = [media.padded(x) for x in raw]
    files = media.pictures(payloads)
    for some in (files, files[2:3]):
        for file, x in zip(some, jpeg.decode(some), strict=True):
            assert media.payload(x) == payloads[files.index(file)]
            rgb = jpeg.to_rgb(x)
            assert rgb.shape == (x.parsed.height, x.parsed.width, 3) and rgb.dtype == np.uint8


def test_jpeg_transform():
    """The inverse transform against its definition, and colour conversion of a flat picture."""
    place = {int(r): k for k, r in enumerate(jpeg.ZIGZAG)}
    for v, u in ((0, 0), (3, 5), (7, 1)):
        c = lambda i: np.sqrt(1 / 8) if i == 0 else 0.5
        want = [[c(u) * c(v) * np.cos((2 * x + 1) * u * np.pi / 16) * np.cos((2 * y + 1) * v * np.pi / 16) for x in range(8)] for y in range(8)]
        assert np.allclose(jpeg.INVERSE[:, place[8 * v + u]].reshape(8, 8), want, atol=1e-6)
    file = media.pictures([bytes([128 + 80]) + b"\x80" * 63])[0]
    rgb = jpeg.to_rgb(jpeg.decode([file])[0])
    assert (rgb[:8, :8] == 138).all() and (rgb[8:, 8:] == 128).all()


def test_quality_learns_junk():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    good = [" ".join(draw.choices(vocabulary, k=80)) for _ in range(150)]
    bad = [" ".join(w + "***" for w in draw.choices(vocabulary, k=80)) if i % 2 else " ".join([draw.choice(vocabulary)] * 80) for i in range(150)]
    s = quality.Settings(bits=14, epochs=8)
    bags = quality._bags(pa.chunked_array([good + bad]), s)
    labels = np.array([1] * 150 + [0] * 150)
    train = np.arange(300) % 3 != 1
    weights, bias = quality.train([b for b, t in zip(bags, train) if t], labels[train], s)
    score = np.array([(weights[b] * c).sum() / c.sum() + bias for b, c in bags])
    assert ((score > 0) == labels)[~train].mean() > 0.95


def plain_shingles(text, n):
    words = text.encode().lower().split()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def test_universe_partition_loses_nothing():
    """Every pair of sets at the threshold shares a key, whatever the allocation; the set sizes are right."""
    draw = random.Random(8)
    texts = []
    for size in (1, 2, 4, 6, 9, 15, 25, 40, 90, 200):
        for _ in range(4):
            words = [str(draw.randint(0, 10**6)) for _ in range(size)]
            texts.append(" ".join(words))
            for _ in range(6):
                other = list(words)
                for _ in range(draw.randint(0, max(1, size // 15))):
                    k = draw.randrange(len(other))
                    other[k : k + 1] = draw.choice([[], [str(draw.randint(0, 10**6))], [other[k], "x"]])
                    other = other or ["y"]
                texts.append(" ".join(other))
    for n, percent in ((3, 90), (5, 80), (1, 80)):
        sets = [plain_shingles(t, n) for t in texts]
        h, first = jaccard.shingles(pa.chunked_array([texts]), n)
        assert list(np.diff(first)) == [len(s) for s in sets]
        for option in (0, 1, 2, None):
            scheme = jaccard.Scheme(percent)
            for b in np.unique(scheme.band(np.diff(first))):
                for band in (b, b - 1):
                    if band > 0:
                        scheme.plan[int(band)] = scheme.option(int(band), option)
            keys, at = jaccard.signatures(h, first, scheme)
            own = [set(keys[a:b].tolist()) for a, b in zip(at, at[1:])]
            for i in range(len(texts)):
                for j in range(i):
                    both = len(sets[i] & sets[j])
                    if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                        assert own[i] & own[j], (n, percent, option, len(sets[i]), len(sets[j]))
