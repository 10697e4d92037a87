"""From filings and event pages to one registry row per company."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callweave.functions import datetimes as dt, fixed_values as fv, web
from callweave.operators import capture as cap, relational as rel

EVENT = [
    "fiscal_period", "call_datetime_utc", "timezone_as_published", "webcast_url", "vendor", "dial_in_available",
    "registration_required", "replay_expiry_date", "announced_at_utc", "lead_time_hours", "confidence", "discovery_source",
]


def filings_from_submissions(submissions: DataFrame) -> DataFrame:
    """Column-oriented submission lists (parallel arrays) to one row per filing in listed order."""
    names = ["form", "accessionNumber", "filingDate", "primaryDocument", "items", "acceptanceDateTime"]
    zipped = F.arrays_zip(*[F.col(f"filings.recent.{n}").alias(n) for n in names])
    keep = [c for c in submissions.columns if c != "filings"]
    return submissions.select(*keep, F.posexplode(zipped).alias("filing_rank", "_f")).select(*keep, "filing_rank", "_f.*")


def accepted_forms(country: Column) -> Column:
    return F.when(country == "US", F.array(F.lit("8-K"))).otherwise(F.array(F.lit("6-K"), F.lit("8-K")))


def files_with_regulator(cik: Column) -> Column:
    """A usable identifier: present, not NONE, and digits remain when zeros are dropped."""
    return F.coalesce((cik != "") & (cik != "NONE") & F.replace(cik, F.lit("0"), F.lit("")).rlike("^[0-9]+$"), F.lit(False))


def earnings_filings(filings: DataFrame) -> DataFrame:
    """Filings of an accepted form; the main form also needs its results item."""
    form = F.col("form")
    return filings.where(F.array_contains(accepted_forms(F.col("country")), form) & ((form != "8-K") | F.coalesce(F.col("items"), F.lit("")).contains("2.02")))


def _once(rows: DataFrame, name: str, costly: Column) -> DataFrame:
    """Adds a costly column behind a one-element explode, which later filters and projections cannot inline (each of them
    would scan the page again)."""
    return rows.select("*", F.explode(F.array(costly)).alias(name))


def read_documents(docs: DataFrame, registry=fv.VENDORS, newest: bool = False) -> DataFrame:
    """Event facts of every earnings document.  docs: keys, form, filing_date, accepted_at, ticker, html.

    ``newest`` reads only each company's filing of least rank that has such a document; the planner limits groups ahead of the shuffle."""
    rows = _once(docs, "_text", web.page_text(F.col("html"))).where(F.col("_text") != "")
    rows = rows.where(~dt.is_other_event(F.col("_text")))
    if newest:
        rank = F.rank().over(Window.partitionBy("ticker").orderBy("filing_rank"))
        rows = rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
    rows = rows.withColumn("announced_at_utc", dt.announced_at(F.col("filing_date"), F.col("accepted_at")))
    rows = _once(rows, "_call", dt.call_time(F.col("_text"), F.col("announced_at_utc")))
    flags = dt.filing_flags(F.col("_text"), F.col("_call.zone"))
    link = web.first_webcast_link(F.col("html"))
    rows = rows.withColumns({
        "fiscal_period": dt.fiscal_period(F.col("_text"), F.col("filing_date"), F.col("ticker")),
        "call_datetime_utc": F.col("_call.at"), "timezone_as_published": F.col("_call.zone"), "webcast_url": link, **flags,
    })
    known = web.url_vendor(F.col("webcast_url"), None, registry)
    return rows.withColumns({
        "vendor": F.when(known.isNull() | known.startswith("unknown:"), "In-house").otherwise(known),
        "lead_time_hours": dt.lead_hours(F.col("call_datetime_utc"), F.col("announced_at_utc")),
        "confidence": cap.filing_confidence(F.col("call_datetime_utc"), F.col("fiscal_period")),
        "discovery_source": F.concat(F.lit("SEC_EDGAR_"), "form"),
    }).drop("_text", "_call", "html")


def best_document(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Per key: newest filing first; in it the first document with time and period, else with time, else the first."""
    timed, dated = F.col("call_datetime_utc").isNotNull(), F.col("fiscal_period").isNotNull()
    order = F.struct("filing_rank", F.when(timed & dated, 0).when(timed, 1).otherwise(2).alias("c"), "doc_rank")
    return rel.pick_per_key(rows, keys, order)


def registry_rows(companies: DataFrame, filings: DataFrame, pages: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """One event per company: filings, gaps filled from the company's event pages, else a default row; then forced values.

    companies: ticker, country, ir_page_url.  filings / pages: ticker, filing_rank, doc_rank, form, filing_date, accepted_at,
    html (plus country, items for filings)."""
    filed = best_document(read_documents(earnings_filings(filings), newest=True), ["ticker"]).select("ticker", *EVENT)
    paged = best_document(read_documents(pages, newest=True), ["ticker"]).withColumn("discovery_source", F.lit("IR_EVENTS_PAGE"))
    paged = paged.withColumn("confidence", cap.page_confidence(F.col("call_datetime_utc"), F.col("fiscal_period"))).select("ticker", *EVENT)
    gaps = companies.where(F.col("country") != "US").select("ticker").join(paged, "ticker")
    both = companies.select("ticker", "country", "ir_page_url").join(filed, "ticker", "left")
    need = F.col("call_datetime_utc").isNull()
    extra = gaps.select("ticker", *[F.col(c).alias(f"_p_{c}") for c in EVENT])
    out = both.join(extra, "ticker", "left")
    missing = F.col("_missing")
    out = out.withColumn("_missing", need).select(
        "ticker", "ir_page_url",
        *[F.when(missing & (F.col(c).isNull()), F.col(f"_p_{c}")).otherwise(F.col(c)).alias(c) for c in EVENT])
    home = F.concat("ir_page_url", F.lit("/events"))
    out = out.withColumns({
        "webcast_url": F.coalesce(rel.filled(F.col("webcast_url")), home),
        "vendor": F.coalesce(rel.filled(F.col("vendor")), F.lit("In-house")),
        "discovery_source": F.coalesce("discovery_source", F.lit("IR_EVENTS_PAGE")),
        "confidence": F.coalesce("confidence", F.lit(0.50)),
    })
    out = out.withColumn("replay_url", F.col("webcast_url")).drop("ir_page_url")
    if overrides is not None:
        out = rel.apply_overrides(out, overrides, "ticker", ["fiscal_period", "call_datetime_utc", "timezone_as_published", "lead_time_hours", "confidence"])
    return out


def resolve_call_ids(requests: DataFrame, files: DataFrame, request: str = "request", stem: str = "stem") -> DataFrame:
    """Each request's file: equal, then equal ignoring case, then containing it; ties by file name.  The containment join
    meets on character runs, so no request is paired with every file."""
    from callweave.operators.matching import containing

    clean = F.trim(F.replace(F.replace(F.col(request), F.lit(".wav"), F.lit("")), F.lit(".json"), F.lit("")))
    asked = requests.select(request).distinct().withColumn("_low", F.lower(clean)).withColumn("_exact", clean)
    stems = files.select(stem).distinct().withColumn("_stem_low", F.lower(stem))
    pairs = containing(stems, [stem], "_stem_low", asked, "_low")
    rank = F.when(F.col(stem) == F.col("_exact"), 0).when(F.col("_stem_low") == F.col("_low"), 1).otherwise(2)
    best = pairs.groupBy(request).agg(F.min_by(F.struct(F.col(stem), rank.alias("how")), F.struct(rank, F.col(stem))).alias("_b"))
    return requests.select(request).distinct().join(best, request, "left").select(request, F.col("_b")[stem].alias(stem), F.col("_b.how").alias("match_class"))


def company_documents(docs: DataFrame, companies: DataFrame, head: int | None = None) -> DataFrame:
    """Documents whose URL or text (or its first ``head`` characters) names the company.  docs: doc_id, url, text; companies: ticker, name."""
    from callweave.operators.matching import containing

    body = F.coalesce("text", F.lit(""))
    texts = docs.select("doc_id", F.posexplode(F.array(
        F.lower(F.coalesce("url", F.lit(""))), F.lower(F.substring(body, 1, head) if head else body))).alias("_part", "_t"))
    names = companies.select("ticker", F.lower("name").alias("_n"))
    return containing(texts, ["doc_id", "_part"], "_t", names, "_n").select("doc_id", "ticker").distinct()
