r"""Operator 1: personal data by fixed patterns and a semi-Markov conditional random field.

Patterns give the base spans. The model looks at the neighbourhoods of digits, at-signs and spelt-out address marks: tokens are letter runs,
digit runs, white space and single marks; a segment of up to `LONGEST` tokens of one kind is scored as a whole (digit groups, separators, Luhn
sum, octets, marks, what stands beside it), other tokens one by one, and dynamic programming picks boundaries and kinds together. Its spans are
added where they overlap no base span and lead the reading without them by `MARGIN`.

It is trained by maximum likelihood (forward-backward, numpy) on a bounded sample: the neighbourhoods of `SAMPLE` documents, those of the
smallest hash of the id among those with any, labelled by the patterns, and copies of them with the same entity in a spelling that the
patterns do not know (spelt-out addresses, numbers without a country code, defanged octets) or with a second entity right behind it, which
the patterns run together and refuse. Nothing but the text is read for a span.

Null texts are empty and have no spans. Null ids stay; equal texts have equal spans; an empty table gives an empty table; other columns pass
through. Texts are read whole: matching is linear in their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.llm import common

KINDS = ("email", "ip", "card", "phone")
LONGEST, MARGIN, SAMPLE, NEAR = 24, 3.0, 150, 32

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match that begins inside a run of digits would have begun with the run, so only its start is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns, leftmost without overlap within a kind."""
    out: list[tuple[int, int, int]] = []
    if not _ANY.search(text):
        return out
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            done = m.end()
        else:
            # Characters before this at-sign cannot belong to a later address.
            done = at + 1
        at = text.find("@", max(done, at + 1))
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in (x.lstrip("0") for x in m.group().split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() < 40 and 13 <= len(d := re.sub("[ -]", "", m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


_TRIGGER = re.compile(r"[0-9@]+|[(\[] ?(?:at|dot) ?[)\]]|(?<= )dot(?= )", re.I)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\s+|.", re.S)


def regions(text: str) -> list[tuple[int, int]]:
    """Neighbourhoods of what may be part of an entity, without overlap, from white space to white space."""
    out: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        if out and m.start() - out[-1][1] <= 2 * NEAR:
            out[-1][1] = m.end()
        else:
            out.append([*m.span()])
    found, last = [], 0
    for start, end in out:
        start, end = max(last, start - NEAR), min(len(text), end + NEAR)
        while start > last and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        if end > start:
            found.append((start, end))
        last = max(last, end)
    return found


#: Places of each feature of a segment: name to number of values.
FEATURES = {
    "digits": 24, "groups": 10, "fours": 8, "long": 3, "octets": 3, "luhn": 3, "at": 4, "dots": 8, "words": 8, "ends": 49,
    "spaces": 8, "dashes": 6, "brackets": 6, "others": 6, "before": 7, "after": 7, "length": LONGEST + 1,
}
STARTS = dict(zip(FEATURES, np.cumsum([0, *FEATURES.values()])))
WIDTH = sum(FEATURES.values())
#: Classes of tokens: none, digits, letters, white space, plus, opening bracket, other mark.
CLASSES = 7


class Tokens:
    """Tokens of many regions and what prefix sums say of every segment."""

    def __init__(self, texts: list[str]) -> None:
        words, of, start, end = [], [], [], []
        for r, text in enumerate(texts):
            for m in _TOKEN.finditer(text):
                words.append(m.group()), of.append(r), start.append(m.start()), end.append(m.end())
        self.of, self.start, self.end = (np.array(x, np.int64) for x in (of, start, end))
        n = len(words)
        self.first = np.searchsorted(self.of, np.arange(len(texts) + 1))
        first = np.array([w[0] if w else " " for w in words], dtype=object)
        digit = np.array([w[0] in "0123456789" for w in words], bool)
        letter = np.array([w[0].isalpha() for w in words], bool)
        space = np.array([w[0].isspace() for w in words], bool)
        self.kind = np.select([digit, letter, space, first == "+", (first == "(") | (first == "[")], [1, 2, 3, 4, 5], 6).astype(np.int64) if n else np.zeros(0, np.int64)
        size = np.where(digit, self.end - self.start, 0)
        low = np.array([w.lower() for w in words], dtype=object)
        wide = np.array([bool(d) and (len(w.lstrip("0")) > 3 or int(w.lstrip("0")[:4] or "0") > 255) for w, d in zip(words, digit)], bool)
        counts = {
            "digits": size, "groups": digit, "fours": digit & (size == 4), "long": digit & (size > 4), "octets": wide,
            "at": (first == "@") | (low == "at"), "dots": (first == ".") | (low == "dot"), "words": letter, "spaces": space,
            "dashes": first == "-", "brackets": np.isin(first, ["(", ")", "[", "]"]) if n else np.zeros(0, bool),
            "others": (self.kind == 6) & ~np.isin(first, [".", "-", "@", ")", "]"]) if n else np.zeros(0, bool),
        }
        sums = {k: np.concatenate([[0], np.cumsum(v.astype(np.int64))]) for k, v in counts.items()}
        i = np.arange(n)[:, None]
        j = i + np.arange(1, LONGEST + 1)[None, :]
        self.valid = j <= self.first[self.of + 1][:, None] if n else np.zeros((0, LONGEST), bool)
        j = np.minimum(j, n)
        value = {k: s[j] - s[i] for k, s in sums.items()}
        # Luhn sums of all spans: digits doubled at even, or at odd, places of the digit sequence.
        every = np.array([int(c) for w, d in zip(words, digit) if d for c in w], np.int64)
        twice = np.where(every > 4, 2 * every - 9, 2 * every)
        even = np.arange(len(every)) % 2 == 0
        alternate = [np.concatenate([[0], np.cumsum(np.where(even == e, twice, every))]) for e in (True, False)]
        p, q = sums["digits"][i], sums["digits"][j]
        total = np.where(q % 2 == 0, alternate[0][q] - alternate[0][p], alternate[1][q] - alternate[1][p])
        card = (value["digits"] >= 13) & (value["digits"] <= 19)
        value["luhn"] = np.where(card, np.where(total % 10 == 0, 2, 1), 0)
        value["octets"] = np.where(value["groups"] == 4, np.where(value["octets"] == 0, 2, 1), 0)
        kind = np.concatenate([self.kind, [0]])
        last = kind[np.maximum(j - 1, 0)]
        value["ends"] = kind[i] * CLASSES + last
        edge = np.zeros(n + 1, bool)
        edge[self.first] = True
        value["before"] = np.broadcast_to(np.where(edge[:n], 0, kind[np.arange(n) - 1])[:, None], j.shape)
        value["after"] = np.where(edge[j], 0, kind[j])
        value["length"] = j - i
        # Only segments without white space at the ends and with a digit or an address mark can be entities.
        some = (value["digits"] > 0) | (value["at"] > 0)
        self.valid &= some & (self.kind != 3)[:, None] & (last != 3)
        self.at = np.nonzero(self.valid)
        self.codes = np.stack([STARTS[k] + np.minimum(value[k][self.at], size - 1) for k, size in FEATURES.items()])


class Model:
    """Weights of segments by kind and of single tokens."""

    def __init__(self) -> None:
        self.segment = np.zeros((len(KINDS), WIDTH))
        self.bias = np.full(len(KINDS), -2.0)
        self.token = np.zeros(CLASSES)

    def scores(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Score of every segment (kind, token, length), impossible ones at -inf, and of every single token."""
        out = np.full((len(KINDS), len(t.of), LONGEST), -np.inf)
        for k in range(len(KINDS)):
            out[(k, *t.at)] = self.bias[k] + self.segment[k][t.codes].sum(0)
        return out, self.token[t.kind]


def _best(total: np.ndarray) -> np.ndarray:
    return total.max(1)


def _logsum(total: np.ndarray) -> np.ndarray:
    top = total.max(1)
    safe = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(total - safe[:, None]).sum(1))


def forward(t: Tokens, segment: np.ndarray, token: np.ndarray, join) -> np.ndarray:
    """Value of the part of each region up to each token; entry first + p + region is position p. `join` is maximum or log-sum."""
    lens = np.diff(t.first)
    base = t.first[:-1] + np.arange(len(lens))
    value = np.zeros(len(t.of) + len(lens))
    for p in range(1, int(lens.max(initial=0)) + 1):
        r = np.flatnonzero(lens >= p)
        span = min(LONGEST, p)
        back = np.arange(1, span + 1)
        ahead = value[base[r][:, None] + p - back]
        total = [(value[base[r] + p - 1] + token[t.first[r] + p - 1])[:, None]]
        at = t.first[r][:, None] + p - back
        total += [ahead + segment[k][at, back - 1] for k in range(len(KINDS))]
        value[base[r] + p] = join(np.concatenate(total, 1))
    return value


def decode(t: Tokens, model: Model) -> list[tuple[int, int, int, int]]:
    """(region, kind, start, end) of the best reading's entities that lead it by the margin."""
    segment, token = model.scores(t)
    value = forward(t, segment, token, _best)
    out = []
    plain = np.concatenate([[0], np.cumsum(token)])
    for r in range(len(t.first) - 1):
        first, p = t.first[r], t.first[r + 1] - t.first[r]
        base = first + r
        while p > 0:
            back = np.arange(1, min(LONGEST, p) + 1)
            total = value[base + p - back][None, :] + segment[:, first + p - back, back - 1]
            k, l = np.unravel_index(int(total.argmax()), total.shape)
            if total[k, l] <= value[base + p - 1] + token[first + p - 1]:
                p -= 1
                continue
            a = first + p - l - 1
            if segment[k, a, l] - (plain[first + p] - plain[a]) >= MARGIN:
                out.append((r, int(k), int(t.start[a]), int(t.end[first + p - 1])))
            p -= l + 1
    return out


def train(texts: list[str], gold: list[list[tuple[int, int, int]]], steps: int = 60, rate: float = 0.5, decay: float = 2e-6) -> Model:
    """Maximum likelihood by adaptive gradient steps over all regions. Gold spans that are no run of whole tokens are passed over."""
    model, t = Model(), Tokens(texts)
    if not len(t.of):
        return model
    lens = np.diff(t.first)
    true = np.zeros((len(KINDS), len(t.of), LONGEST), bool)
    single = np.ones(len(t.of))
    for r, spans in enumerate(gold):
        own = slice(t.first[r], t.first[r + 1])
        starts, ends = {int(x): k for k, x in enumerate(t.start[own])}, {int(x): k for k, x in enumerate(t.end[own])}
        for kind, a, b in spans:
            if a in starts and b in ends and ends[b] - starts[a] < LONGEST and t.valid[t.first[r] + starts[a], ends[b] - starts[a]]:
                true[kind, t.first[r] + starts[a], ends[b] - starts[a]] = True
                single[t.first[r] + starts[a] : t.first[r] + ends[b] + 1] = 0
    base = t.first[:-1] + np.arange(len(lens))
    region = t.of[t.at[0]]
    left, right = t.at[0] + region, t.at[0] + t.at[1] + 1 + region
    seen = [np.full(x.shape, 1e-6) for x in (model.segment, model.bias, model.token)]
    for _ in range(steps):
        segment, token = model.scores(t)
        alpha = forward(t, segment, token, _logsum)
        beta = _backward(t, segment, token)
        whole = alpha[base + lens]
        grads = [np.zeros_like(model.segment), np.zeros_like(model.bias), np.zeros_like(model.token)]
        for k in range(len(KINDS)):
            share = np.exp(alpha[left] + segment[(k, *t.at)] + beta[right] - whole[region])
            miss = true[(k, *t.at)] - share
            grads[1][k] = miss.sum()
            for row in t.codes:
                grads[0][k] += np.bincount(row, miss, WIDTH)
        spot = np.arange(len(t.of)) + t.of
        share = np.exp(alpha[spot] + token + beta[spot + 1] - whole[t.of])
        grads[2] = np.bincount(t.kind, single - share, CLASSES)
        for x, g, s in zip((model.segment, model.bias, model.token), grads, seen, strict=True):
            g = g / len(lens) - decay * x
            s += g * g
            x += rate * g / np.sqrt(s)
    return model


def _backward(t: Tokens, segment: np.ndarray, token: np.ndarray) -> np.ndarray:
    lens = np.diff(t.first)
    base = t.first[:-1] + np.arange(len(lens))
    value = np.zeros(len(t.of) + len(lens))
    for q in range(1, int(lens.max(initial=0)) + 1):
        r = np.flatnonzero(lens >= q)
        p = lens[r] - q
        span = np.arange(1, min(LONGEST, q) + 1)
        ahead = value[(base[r] + p)[:, None] + span]
        total = [(value[base[r] + p + 1] + token[t.first[r] + p])[:, None]]
        total += [ahead + segment[k][(t.first[r] + p)[:, None], span - 1] for k in range(len(KINDS))]
        value[base[r] + p] = _logsum(np.concatenate(total, 1))
    return value


def _respelt(kind: int, text: str) -> list[str]:
    """The same entity in spellings that the patterns do not know."""
    if kind == 0:
        return [text.replace("@", " at ").replace(".", " dot "), text.replace("@", " (at) "), text.replace("@", "[at]").replace(".", "[dot]")]
    if kind == 1:
        return [text.replace(".", "[.]"), text.replace(".", " dot ")]
    if kind == 3:
        short = re.sub(r"^\+[0-9]{1,3}[ .-]*", "", text)
        return [short] if sum(c.isdigit() for c in short) >= 9 else []
    return []


def examples(text: str) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Regions of a text with the spans of the patterns, and copies with one entity respelt."""
    found, out = base_spans(text), []
    for a, b in regions(text):
        own = [(k, s - a, e - a) for k, s, e in found if a <= s and e <= b]
        area = text[a:b]
        if any(_runs_on(area, m, own) for p in (_CARD, _PHONE) for m in p.finditer(area)):
            continue
        out.append((area, own))
        for kind, s, e in own:
            before = [x for x in own if x[2] <= s]
            after = [x for x in own if x[1] >= e]
            # Spelt differently, or with another entity of the text right behind it.
            forms = [(other, []) for other in _respelt(kind, area[s:e])]
            forms += [(f"{area[s:e]} {text[x:y]}", [(k, s + e - s + 1, s + e - s + 1 + y - x)]) for k, x, y in found if k != kind][:2]
            for other, more in forms:
                shift = len(other) - e + s
                own_end = more[0][1] - 1 if more else s + len(other)
                out.append((area[:s] + other + area[e:], [*before, (kind, s, own_end), *more, *((k, x + shift, y + shift) for k, x, y in after)]))
    return out


def _runs_on(area: str, m: re.Match, own: list[tuple[int, int, int]]) -> bool:
    """A refused match that holds more than one number: the patterns say nothing reliable about it, so it is no training material."""
    digits = sum(c.isdigit() for c in m.group())
    return digits >= 13 and any(c in " -" for c in m.group()) and not any(s <= m.start() and m.end() <= e for _, s, e in own)


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from the regions of at most `sample` documents; regions over 400 characters are left to decoding."""
    some = docs.where(F.rlike("text", F.lit("[0-9@]"))).select("doc_id", "text").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(sample)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches):
            rows = [(area, [list(s) for s in spans]) for text in piece.column("text").to_pylist() for area, spans in examples(text) if len(area) <= 400]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], pa.string()), pa.array([x[1] for x in rows], pa.list_(pa.list_(pa.int32())))], ["area", "spans"])

    rows = some.mapInArrow(work, "area string, spans array<array<int>>").collect()
    rows = sorted((r["area"], [tuple(s) for s in r["spans"]]) for r in rows)
    return train([a for a, _ in rows], [s for _, s in rows])


def spans_of(text: str, model: Model) -> list[tuple[int, int, int, bool]]:
    """(kind, start, end, by pattern) of a text by kind and start."""
    base = base_spans(text)
    out = [(*s, True) for s in base]
    places = regions(text)
    if places:
        for r, kind, a, b in decode(Tokens([text[a:b] for a, b in places]), model):
            a, b = a + places[r][0], b + places[r][0]
            if not any(a < e and s < b for _, s, e in base):
                out.append((kind, a, b, False))
    return sorted(out)


def found(docs: DataFrame, model: Model, text: str = "text", out: str = "spans") -> DataFrame:
    """Adds `out`: array of (kind, start, end, base) in code points, end exclusive."""
    kind = "array<struct<kind:int,start:long,end:long,base:boolean>>"
    schema = T.StructType([f for f in docs.schema if f.name != out] + [T.StructField(out, T._parse_datatype_string(kind))])
    sent = docs.sparkSession.sparkContext.broadcast(model)
    arrow = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in common.pieces(batches, text):
            spans = [[dict(zip(("kind", "start", "end", "base"), s)) for s in spans_of(x or "", sent.value)] for x in piece.column(text).to_pylist()]
            kept = [c for c in piece.column_names if c != out]
            yield from piece.select(kept).append_column(out, pa.array(spans, arrow)).to_batches()

    return docs.mapInArrow(run, schema)


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = common.table(spark, folder, "documents").select("doc_id", "text")
    rows = found(docs, fit(docs)).drop("text")
    names = F.array(*map(F.lit, KINDS))
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s["base"])

    def count(k: int) -> Column:
        # A second lambda parameter would be the place in the array.
        return F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), added)


QUERIES = {"op1_pii": op1_pii}
ORACLE: dict[str, str] = {}
