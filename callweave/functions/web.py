"""Pages and URLs: text, links, webcast vendors."""

from __future__ import annotations

from html.entities import html5

import json
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.functions import fixed_values as fv
from callweave.functions.editdist import bind

HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<![^>]*>"
#: A tag, whose quoted attribute values may hold ">"; one with an unclosed quote ends at the next ">".
TAG = r"""<>|</?[A-Za-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>|<[^>]*>"""
REFERENCE = r"&(#[xX][0-9a-fA-F]{1,6}|#[0-9]{1,7}|[A-Za-z][A-Za-z0-9]{1,31});"
#: Named character references and what they stand for, from the standard library's table.
NAMED = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}


def decode_entities(text: Column) -> Column:
    """Character references decoded, each once; unknown names stay, impossible numbers become U+FFFD."""
    names = F.map_from_arrays(F.array(*map(F.lit, NAMED)), F.array(*map(F.lit, NAMED.values())))

    def glyph(number: Column) -> Column:
        fit = (number > 0) & (number < 0x110000) & ~number.between(0xD800, 0xDFFF)
        return F.decode(F.unhex(F.lpad(F.hex(F.when(fit, number).otherwise(0xFFFD)), 8, "0")), "UTF-32")

    def decoded(ref: Column) -> Column:
        number = F.when(F.rlike(ref, F.lit("^#[xX]")), F.conv(F.substring(ref, 3, 6), 16, 10)).otherwise(F.substring(ref, 2, 7)).cast("int")
        known = F.coalesce(F.try_element_at(names, ref), F.concat(F.lit("&"), ref, F.lit(";")))
        return F.when(F.startswith(ref, F.lit("#")), glyph(number)).otherwise(known)

    refs = F.transform(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(1)), decoded)
    pieces = F.zip_with(F.split(text, REFERENCE, -1), refs, lambda plain, ref: F.concat(plain, F.coalesce(ref, F.lit(""))))
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def page_text(html: Column) -> Column:
    """Visible strings of a page, stripped and joined by one space."""
    pieces = F.split(F.regexp_replace(html, HIDDEN, "<>"), TAG)
    clean = F.transform(pieces, lambda p: F.regexp_replace(p, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    return decode_entities(F.array_join(F.filter(clean, lambda p: p != ""), " "))


def attribute(tag: Column, name: str) -> Column:
    value = F.regexp_extract(tag, rf"(?is)[\s\"']{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    return decode_entities(F.regexp_replace(value, r"^[\"']|[\"']$", ""))


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def absolute(base: Column, href: Column) -> Column:
    """A link resolved against its page."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    root = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    folder = F.regexp_replace(F.regexp_extract(base, r"^[^?#]*", 0), r"(?<=[^:/])/[^/]*$", "")
    bare = F.regexp_extract(base, r"^[^?#]*", 0)
    page = F.regexp_extract(base, r"^[^#]*", 0)
    joined = (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("#"), F.concat(page, href))
        .when(href.startswith("?"), F.concat(bare, href))
        .otherwise(F.concat(folder, F.lit("/"), href))
    )
    return joined


ANCHOR = r"(?is)<a\b[^>]*\bhref\b[^>]*>.*?(?=</a\s*>|<a\b|$)"


def page_links(html: Column) -> Column:
    """Array of (href, label) of the page's anchors and frames, in document order."""
    shown = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")
    anchors = F.regexp_extract_all(shown, F.lit(ANCHOR + r"|<iframe\b[^>]*\bhref\b[^>]*>"), F.lit(0))
    return F.transform(anchors, lambda a: F.struct(
        attribute(F.regexp_extract(a, r"(?s)^<[^>]*>", 0), "href").alias("href"),
        F.lower(F.trim(F.regexp_replace(F.regexp_replace(a, r"(?s)^<[^>]*>", ""), r"<[^>]*>", ""))).alias("label")))


def relevant_links(
    html: Column, url: Column, words: list[str] = fv.LINK_WORDS, bad: list[str] = fv.LINK_BAD_ENDINGS,
    vendors: list[str] = fv.LINK_VENDOR_HOSTS, limit: int = 8,
) -> Column:
    """First distinct links that talk about events and stay on the site or a known vendor."""
    said = lambda t: F.lit(False) if not words else t.rlike("|".join(w.replace(".", r"\.") for w in words))
    ending = "(" + "|".join(b.replace(".", r"\.") for b in bad) + ")$"

    def wanted(link: Column) -> Column:
        return (said(F.lower(link["href"])) | said(link["label"])) & ~F.lower(link["href"]).rlike(ending)

    def near(target: Column) -> Column:
        ok = F.contains(host(target), host(url))
        for v in vendors:
            ok = ok | host(target).contains(v)
        return ok

    full = F.transform(F.filter(page_links(html), wanted), lambda link: absolute(url, link["href"]))
    return F.slice(F.array_distinct(F.filter(full, near)), 1, limit)


def url_vendor(url: Column, own_domain: Column | None = None, registry=fv.VENDORS) -> Column:
    """Webcast vendor by URL: registry order, then the company's own domain, then the unknown host by name."""
    out = F
    for name, patterns, _ in registry:
        out = out.when(url.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)), name)
    if own_domain is not None:
        out = out.when((own_domain != "") & F.contains(host(url), F.lower(own_domain)), "In-house")
    return out.when(host(url) != "", F.concat(F.lit("unknown: "), host(url)))


def _known_vendor(url: Column, registry) -> Column:
    found = url_vendor(url, None, registry)
    return F.when(~found.startswith("unknown:"), found)


def page_vendor(html: Column, url: Column, registry=fv.VENDORS) -> Column:
    """Struct (vendor, confidence): by page URL, by the first known link, by page signatures, else in-house."""
    shown = F.regexp_replace(html, r"(?is)<!--.*?-->", "")
    tags = F.regexp_extract_all(shown, F.lit(r"(?is)<(?:a|iframe|script)\b[^>]*>"), F.lit(0))
    source = lambda t: F.coalesce(F.nullif(attribute(t, "src"), F.lit("")), attribute(t, "href"))
    linked = F.get(F.filter(F.transform(tags, lambda t: _known_vendor(source(t), registry)), lambda v: v.isNotNull()), F.lit(0))
    text, signed = F.lower(html), F
    for name, _, signatures in registry:
        hit = F.lit(False)
        for s in signatures:
            hit = hit | text.contains(s.lower())
        signed = signed.when(hit, name)
    pack = lambda v, c: F.when(v.isNotNull(), F.struct(v.alias("vendor"), F.lit(c).alias("confidence")))
    house = F.lit("In-house")
    return F.coalesce(
        pack(_known_vendor(url, registry), 0.95), pack(linked, 0.90), pack(signed, 0.85),
        pack(F.when(host(url) != "", house), 0.70), pack(house, 0.60))


def first_webcast_link(html: Column, words: list[str] = fv.FILING_WEBCAST_WORDS) -> Column:
    """First plain link of a filing that looks like a webcast."""
    links = F.regexp_extract_all(html, F.lit(fv.PLAIN_LINK), F.lit(0))
    pattern = "(?i)" + "|".join(w.replace(".", r"\.") for w in words)
    return F.regexp_replace(F.get(F.filter(links, lambda u: u.rlike(pattern)), F.lit(0)), r"[.,;)>\"']+$", "")


def query_value(url: Column, name: str) -> Column:
    return F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(name)))


def cache_key(url: Column) -> Column:
    return F.sha2(url, 256)


def _texts_of(raw: str | None, key: str) -> list[str]:
    """Texts under a key, depth first in document order; repeated keys count each time, broken JSON has none."""
    try:
        # Pairs keep repeated keys and their order; a list of pairs is told from an array by its type.
        root = json.loads(raw or "null", object_pairs_hook=tuple)
    except (ValueError, RecursionError):
        return []
    out, todo = [], [root]
    while todo:
        here = todo.pop()
        if isinstance(here, tuple):
            for name, value in reversed(here):
                todo.append(value)
                if name == key and isinstance(value, str):
                    todo[-1] = _Found(value)
        elif isinstance(here, list):
            todo += reversed(here)
        elif isinstance(here, _Found):
            out.append(here.text)
    return out


@dataclass
class _Found:
    text: str


def json_values(raw: Column, key: str) -> Column:
    """All texts of a key at any depth, in document order, escapes resolved. Objects lose their order in Spark's own JSON types, so the
    document is walked in Arrow batches."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def find(documents: pd.Series) -> pd.Series:
        return pd.Series([_texts_of(d, key) for d in documents])

    return find(raw)


def stream_address(raw: Column, host_word: str, default_host: str, manifest_word: str = "master.m3u8") -> Column:
    """Stream URL from a player configuration: the last matching host and manifest win; null without a manifest."""
    last = lambda found, word: F.element_at(F.concat(F.array(F.lit(None).cast("string")), F.filter(found, lambda v: F.contains(v, F.lit(word)))), -1)
    server = F.coalesce(F.regexp_replace(last(json_values(raw, "hostName"), host_word), "/+$", ""), F.lit(default_host))
    path = F.regexp_replace(last(json_values(raw, "manifest"), manifest_word), "^/+", "")
    return F.concat(server, F.lit("/"), path)


def stream_priority(url: Column, host_word: str, manifest_word: str = "master.m3u8") -> Column:
    """Rank of a sniffed stream: master list on the preferred host, any on that host, any."""
    there = F.lower(url).contains(host_word)
    return F.when(there & F.lower(url).contains(manifest_word), 0).when(there, 1).otherwise(2)


def clean_cik(cik: Column) -> Column:
    """Digits only, padded to ten; longer numbers stay whole."""
    digits = F.regexp_replace(cik, r"[^0-9]", "")
    return F.when(F.length(digits) < 10, F.lpad(digits, 10, "0")).otherwise(digits)


def exhibit_class(name: Column) -> Column:
    """0 for likely press-release exhibits, 1 for other pages of a filing, null for the rest."""
    low = F.lower(name)
    any_in = lambda words: low.rlike("|".join(w.replace(".", r"\.") for w in words))
    page = low.rlike(r"\.html?$") & ~any_in(fv.EXHIBIT_SKIP) & ~low.rlike(r"^r[0-9]+\.html?$")
    return F.when(page & any_in(fv.EXHIBIT_LIKELY), 0).when(page, 1)
