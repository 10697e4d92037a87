"""Ordered rule chains over capture, crawl and page facts.  Each returns the first rule that applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def capture_verdict(
    known_bad: Column,
    min_sec: float = fv.MIN_CALL_SEC, max_sec: float = fv.MAX_CALL_SEC, min_bytes: int = fv.MIN_CALL_BYTES,
    forbidden: list[str] = fv.FORBIDDEN_HOSTS,
) -> Column:
    """VALID or the first acceptance rule a recording breaks.  Columns: source_url, sample_rate, channels, bit_depth,
    sha256, duration_sec, file_size; ``known_bad`` marks hashes seen before."""
    host = url_host(F.col("source_url"))
    banned = F.lit(False)
    for h in forbidden:
        banned = banned | host.contains(h)
    rate, ch, bits = F.col("sample_rate"), F.col("channels"), F.col("bit_depth")
    dur, size = F.col("duration_sec"), F.col("file_size")
    text = lambda *p: F.concat(*[F.coalesce(x.cast("string"), F.lit("None")) for x in p])
    return (
        F.when(banned, "Forbidden source domain: youtube")
        .when(~rate.eqNullSafe(F.lit(fv.AUDIO_RATE)), text(F.lit("Sample rate "), rate, F.lit(f" != {fv.AUDIO_RATE}")))
        .when(~ch.eqNullSafe(F.lit(fv.AUDIO_CHANNELS)), text(F.lit("Channels "), ch, F.lit(f" != {fv.AUDIO_CHANNELS} (mono)")))
        .when(~bits.eqNullSafe(F.lit(fv.AUDIO_BITS)), text(F.lit("Bit depth "), bits, F.lit(f" != {fv.AUDIO_BITS}")))
        .when(known_bad, text(F.lit("SHA256 "), F.col("sha256"), F.lit(" matches an old synthetic/cached run")))
        .when(F.coalesce((dur < min_sec) | (dur > max_sec), F.lit(True)),
              F.concat(F.lit("Audio duration "), F.format_string("%.1f", F.coalesce(dur.cast("double"), F.lit(0.0))),
                       F.lit(f"s is out of range [{min_sec:.0f}s, {max_sec:.0f}s]")))
        .when(F.coalesce(size < min_bytes, F.lit(True)), text(F.lit("File size "), size, F.lit(" is too small for a valid full call")))
        .otherwise("VALID")
    )


def valid_captures(manifest: DataFrame, inventory: DataFrame, path: str = "audio_path") -> DataFrame:
    """Manifest rows with a path, a positive length and an existing file."""
    rows = manifest.where((F.coalesce(F.trim(path), F.lit("")) != "") & (F.col("duration_sec") > 0))
    return rows.join(inventory.select(path), path, "left_semi")


def request_outcome(status: Column, from_cache: Column) -> Column:
    """Outcome of one request; no status means a network error."""
    return (
        F.when(from_cache & status.isNotNull(), "SUCCESS_CACHED")
        .when(status.isNull(), "FAILED")
        .when(status.isin(429, 401, 403), "BLOCKED")
        .when(status >= 400, "FAILED")
        .otherwise("SUCCESS")
    )


def _mentions(text: Column, words: list[str]) -> Column:
    hit = F.lit(False)
    for w in words:
        hit = hit | text.contains(w)
    return hit


def webcast_status(status: Column, body: Column, inputs: Column, media_seen: Column, url: Column) -> Column:
    """What a webcast page turned out to be."""
    text = F.lower(body)
    return (
        F.when(status.isin(401, 403), fv.STATUS_BLOCKED)
        .when(status == 404, "404")
        .when(_mentions(text, fv.BOT_WALL_WORDS), fv.STATUS_BLOCKED)
        .when(_mentions(text, fv.EXPIRED_WORDS), fv.STATUS_EXPIRED)
        .when(inputs >= 2, fv.STATUS_FORM)
        .when(media_seen | url.contains("youtube.com"), fv.STATUS_MEDIA)
        .otherwise(fv.STATUS_NONE)
    )


def filing_confidence(call_at: Column, period: Column) -> Column:
    return F.when(call_at.isNotNull() & period.isNotNull(), 0.95).when(call_at.isNotNull(), 0.80).otherwise(0.60)


def page_confidence(call_at: Column, period: Column, vendor_confidence: Column | None = None) -> Column:
    base = F.lit(0.60) if vendor_confidence is None else F.coalesce(vendor_confidence, F.lit(0.60))
    return F.when(call_at.isNotNull() & period.isNotNull(), 0.90).when(call_at.isNotNull(), 0.75).otherwise(base)


def call_key(ticker: Column, period: Column) -> Column:
    return F.concat_ws("_", ticker, F.replace(period, F.lit(" "), F.lit("_")))


def key_ticker(key: Column) -> Column:
    return F.split_part(key, F.lit("_"), F.lit(1))


def key_period(key: Column) -> Column:
    return F.replace(F.regexp_extract(key, "^[^_]*_(.*)$", 1), F.lit("_"), F.lit(" "))
