"""Queries over filings, releases, pages and URLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from callweave.functions import datetimes as dt, fixed_values as fv, web
from callweave.operators import capture as cap, discovery as disc
from callweave.plans.adapters import table, wide_table, word_array, words_sql

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


# Press releases rendered from orders: five wordings by priority, dates moved into the 2020s.
RELEASES = """
base AS (
  SELECT o_orderkey AS event_id, o_custkey AS company_id, c_mktsegment AS ticker, o_orderpriority AS pri, o_orderstatus AS st,
         2020 + year(o_orderdate) % 10 AS y, quarter(o_orderdate) AS q, month(o_orderdate) AS m,
         make_date(2020 + year(o_orderdate) % 10, month(o_orderdate), least(day(o_orderdate), 28)) AS d, o_orderkey % 5 + 1 AS h
  FROM orders JOIN customer ON c_custkey = o_custkey),
cal AS (SELECT *, CASE WHEN m IN (7, 8, 9) THEN 'Q2 FY' || y WHEN m >= 10 THEN 'Q3 FY' || y WHEN m <= 3 THEN 'Q4 FY' || (y - 1) ELSE 'Q1 FY' || y END AS expected FROM base),
rel AS (
  SELECT *, CASE WHEN pri = '1-URGENT' AND st = 'P' THEN expected WHEN pri <> '5-LOW' THEN 'Q' || q || ' FY' || y
                 WHEN st <> 'F' AND m % 3 = 0 THEN 'Q' || (m // 3) || ' FY' || y ELSE expected END AS fiscal_period,
         CASE pri WHEN '1-URGENT' THEN 'PT' WHEN '2-HIGH' THEN 'PACIFIC TIME' WHEN '3-MEDIUM' THEN 'ET' WHEN '4-NOT SPECIFIED' THEN 'CENTRAL TIME' END AS zone,
         CASE pri WHEN '1-URGENT' THEN 'America/Los_Angeles' WHEN '2-HIGH' THEN 'America/Los_Angeles' WHEN '3-MEDIUM' THEN 'America/New_York' WHEN '4-NOT SPECIFIED' THEN 'America/Chicago' END AS region,
         CASE pri WHEN '1-URGENT' THEN h * 60 + 720 WHEN '2-HIGH' THEN 870 WHEN '3-MEDIUM' THEN 510 WHEN '4-NOT SPECIFIED' THEN 990 END AS minutes
  FROM cal),
calls AS (SELECT *, timezone('UTC', timezone(region, CAST(d AS TIMESTAMP) + minutes * INTERVAL 1 MINUTE)) AS call_at FROM rel)"""


def releases(spark, folder):
    """event_id, company_id, ticker, filing_date, text of one press release per order."""
    orders = wide_table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    rows = orders.join(customer, "o_custkey").withColumns({
        "y": F.lit(2020) + F.year("o_orderdate") % 10, "q": F.quarter("o_orderdate"),
        "w": F.element_at(F.array(*[F.lit(x) for x in ("first", "second", "third", "fourth")]), F.quarter("o_orderdate")),
    }).withColumn("d", F.make_date("y", F.month("o_orderdate"), F.least(F.day("o_orderdate"), F.lit(28))))
    s = lambda c: (F.col(c) if isinstance(c, str) else c).cast("string")
    day = F.date_format("d", "MMMM d, yyyy")
    pri = F.col("o_orderpriority")
    hint = F.when(F.col("o_orderstatus") == "P", " guidance").otherwise("")
    text = (
        F.when(pri == "1-URGENT", F.concat(
            F.lit("Acme today announced results for its "), "w", F.lit(" quarter of fiscal "), s("y"), hint,
            F.lit(". Acme will hold a conference call at "), s(F.col("o_orderkey") % 5 + 1), F.lit(":00 p.m. PT on "), F.date_format("d", "EEEE"), F.lit(", "), day, F.lit(".")))
        .when(pri == "2-HIGH", F.concat(
            F.lit("Acme will host a conference call and webcast at 2:30 p.m. Pacific time (5:30 p.m. Eastern time) today to discuss results for the "), "w",
            F.lit(" quarter of fiscal "), s("y"), F.lit(".")))
        .when(pri == "3-MEDIUM", F.concat(
            F.lit("Acme will host a conference call today, "), day, F.lit(", at 8:30 a.m. (ET) to present "), "w", F.lit("-quarter "), s("y"), F.lit(" financial results.")))
        .when(pri == "4-NOT SPECIFIED", F.concat(
            F.lit("Acme Q"), s("q"), F.lit(" FY"), s(F.col("y") % 100), F.lit(" results. Live webcast starts at 4:30 p.m. Central Time (CT) on "), day))
        .when(F.col("o_orderstatus") == "F", F.lit("Notice of the Annual General Meeting and a fireside chat."))
        .otherwise(F.concat(F.lit("Results for the quarter ended "), F.date_format("d", "MMMM"), F.lit(" 30, "), s("y"), F.lit(" are attached.")))
    )
    extras = F.when(F.col("o_orderstatus") == "F", F.concat(
        F.lit(" Dial-in numbers follow. Please pre-register. A replay will be available until "), day, F.lit(". Listen at https://event.on24.com/"), s("o_orderkey"), F.lit("."))).otherwise("")
    return rows.select(
        F.col("o_orderkey").alias("event_id"), F.col("o_custkey").alias("company_id"), F.col("c_mktsegment").alias("ticker"),
        F.date_format("d", "yyyy-MM-dd").alias("filing_date"), F.concat(text, extras).alias("text"),
        F.col("o_orderstatus").alias("st"), pri.alias("pri"))


@query("fiscal_period", "WITH " + RELEASES.strip() + " SELECT event_id, fiscal_period FROM rel")
def fiscal_period(spark, folder):
    return releases(spark, folder).select("event_id", dt.fiscal_period(F.col("text"), F.col("filing_date"), F.col("ticker")).alias("fiscal_period"))


@query("call_datetime", "WITH " + RELEASES.strip() + """
SELECT event_id, call_at, zone, CAST(d AS TIMESTAMP) + INTERVAL 20 HOUR AS announced_at, round((epoch_us(call_at) - epoch_us(CAST(d AS TIMESTAMP) + INTERVAL 20 HOUR)) / 3600000000e0, 2) AS lead_hours FROM calls""")
def call_datetime(spark, folder):
    rows = releases(spark, folder).withColumn("announced_at", dt.announced_at(F.col("filing_date"), F.lit(None).cast("string")))
    rows = rows.withColumn("_c", dt.call_time(F.col("text"), F.col("announced_at")))
    plain = lambda c: F.col(c).cast("timestamp_ntz")
    return rows.select("event_id", plain("_c.at").alias("call_at"), F.col("_c.zone").alias("zone"), plain("announced_at").alias("announced_at"),
                       dt.lead_hours(F.col("_c.at"), F.col("announced_at")).alias("lead_hours"))


@query("filing_flags", "WITH " + RELEASES.strip() + """
SELECT event_id, CASE WHEN st = 'F' THEN true END AS dial_in_available, CASE WHEN st = 'F' THEN true END AS registration_required,
  CASE WHEN st = 'F' THEN timezone('UTC', timezone(region, CAST(d AS TIMESTAMP) + INTERVAL 1439 MINUTE)) END AS replay_expiry_date,
  CASE WHEN st = 'F' THEN 'https://event.on24.com/' || event_id END AS webcast_url FROM calls""")
def filing_flags(spark, folder):
    rows = releases(spark, folder).withColumn("_a", dt.announced_at(F.col("filing_date"), F.lit(None).cast("string")))
    rows = rows.withColumn("_c", dt.call_time(F.col("text"), F.col("_a")))
    flags = dt.filing_flags(F.col("text"), F.col("_c.zone"))
    flags["replay_expiry_date"] = flags["replay_expiry_date"].cast("timestamp_ntz")
    return rows.select("event_id", *[c.alias(n) for n, c in flags.items()], web.first_webcast_link(F.col("text")).alias("webcast_url"))


@query("non_earnings", "WITH " + RELEASES.strip() + " SELECT event_id, pri = '5-LOW' AND st = 'F' AS is_other FROM base")
def non_earnings(spark, folder):
    return releases(spark, folder).select("event_id", dt.is_other_event(F.col("text")).alias("is_other"))


@query("tz_clean", """
SELECT o_orderkey AS event_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'EASTERN TIME' WHEN '2-HIGH' THEN 'PT' WHEN '3-MEDIUM' THEN 'CT'
  WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderstatus = 'F' THEN 'ET' WHEN o_orderstatus = 'O' THEN 'UTC' END END AS zone FROM orders""")
def tz_clean(spark, folder):
    """Labels as companies print them: bracketed, dual, decorated, wrong, missing."""
    label = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "(Eastern   Time)").when(F.col("o_orderpriority") == "2-HIGH", "Noon / pt / ET")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "[ct]").when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
            F.when(F.col("o_orderstatus") == "F", "market hours").when(F.col("o_orderstatus") == "O", "Zulu (UTC+0)").otherwise("")))
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("event_id"), dt.clean_zone(label).alias("zone"))


# --- pages -------------------------------------------------------------------------------------------------------

LINKS = r"""
tags AS (SELECT page_id, url, html, unnest(regexp_extract_all(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<script.*?</script>', '', 'gs'), '<a href="([^"]*)">', 1)) AS href FROM pages)"""


@query("html_links", "WITH " + LINKS.strip() + """
SELECT page_id, href, count(*) AS n FROM (SELECT page_id, replace(href, '&amp;', '&') AS href FROM tags) GROUP BY ALL""")
def html_links(spark, folder):
    rows = table(spark, folder, "pages").select("page_id", F.inline(web.page_links(F.col("html"))))
    return rows.groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


PAGE_WORDS = ["the", "und", "les", "an"]


@query("relevant_links", r"""
WITH t AS (SELECT page_id, url, regexp_extract_all(regexp_replace(regexp_replace(html, '<!--.*?-->', '', 'gs'), '<script.*?</script>', '', 'gs'), '<a href="([^"]*)">', 1) AS hs FROM pages),
l AS (SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || replace(unnest(hs), '&amp;', '&') AS link, unnest(hs) AS h, unnest(range(len(hs))) AS o FROM t),
f AS (SELECT page_id, link, min(o) AS o FROM l WHERE regexp_matches(lower(h), 'the|und|les|an') AND NOT regexp_matches(lower(h), '\.(pdf|zip|jpg|png|svg)$') GROUP BY ALL)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY o) - 1 AS INTEGER) AS rank, link FROM f QUALIFY rank < 8""".replace("\\\\", "\\"))
def relevant_links(spark, folder):
    """First eight distinct links of a page that mention one of the watched words and stay on the site."""
    rows = table(spark, folder, "pages")
    links = web.relevant_links(F.col("html"), F.col("url"), words=PAGE_WORDS)
    return rows.select("page_id", F.posexplode(links).alias("rank", "link"))


@query("page_text", r"""
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(array_to_string(list_filter(list_transform(
   regexp_split_to_array(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<![^>]*>', '<>', 'g'), '<[^>]*>'),
   lambda p: regexp_replace(p, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')), lambda p: p <> ''), ' '),
   '&nbsp;', chr(160)), '&copy;', chr(169)), '&middot;', chr(183)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&apos;', ''''), '&amp;', '&') AS text FROM pages""")
def page_text(spark, folder):
    return table(spark, folder, "pages").select("page_id", web.page_text(F.col("html")).alias("text"))


TEST_VENDORS = [("Com Host", [r"example\.com"], ["nav-bar"]), ("Org Host", [r"example\.org/en", r"example\.org/fr"], ["<article>"])]


@query("url_vendor", """
SELECT page_id, CASE WHEN regexp_matches(url, '(?i)example\\.com') THEN 'Com Host' WHEN regexp_matches(url, '(?i)(?:example\\.org/en)|(?:example\\.org/fr)') THEN 'Org Host'
  WHEN contains(lower(regexp_extract(url, '://([^/?#]*)', 1)), 'th.example.net') THEN 'In-house' ELSE 'unknown: ' || lower(regexp_extract(url, '://([^/?#]*)', 1)) END AS vendor FROM pages""")
def url_vendor(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", web.url_vendor(F.col("url"), F.lit("th.example.net"), TEST_VENDORS).alias("vendor"))


@query("html_vendor", r"""
SELECT page_id, CASE WHEN regexp_matches(url, '(?i)example\.com') THEN 'Com Host' WHEN regexp_matches(url, '(?i)example\.org/(en|fr)') THEN 'Org Host'
   WHEN l.page_id IS NOT NULL THEN 'Com Host' WHEN contains(lower(html), 'nav-bar') THEN 'Com Host' WHEN contains(lower(html), '<article>') THEN 'Org Host' ELSE 'In-house' END AS vendor,
  CASE WHEN regexp_matches(url, '(?i)example\.com|example\.org/(en|fr)') THEN 0.95e0 WHEN l.page_id IS NOT NULL THEN 0.9e0
   WHEN contains(lower(html), 'nav-bar') OR contains(lower(html), '<article>') THEN 0.85e0 ELSE 0.7e0 END AS confidence
FROM pages p LEFT JOIN (SELECT DISTINCT page_id FROM pages WHERE regexp_matches(html, '<a href="[^"]*example\.com')) l USING (page_id)""")
def html_vendor(spark, folder):
    return table(spark, folder, "pages").withColumn("_v", web.page_vendor(F.col("html"), F.col("url"), TEST_VENDORS)).select("page_id", "_v.*")


@query("cache_keys", "SELECT page_id, sha256(url) AS cache_key, coalesce(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref FROM pages")
def cache_keys(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id", web.cache_key(F.col("url")).alias("cache_key"), F.coalesce(web.query_value(F.col("url"), "ref"), F.lit("")).alias("ref"))


@query("stream_choice", """
SELECT o_custkey AS company_id, min_by('https://' || CASE WHEN o_orderstatus = 'F' THEN 'stream.example.com' ELSE 'cdn.example.net' END || '/' || o_orderkey
   || CASE WHEN o_orderpriority = '1-URGENT' THEN '/master.m3u8' ELSE '/part.m3u8' END,
   (CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN 0 WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END, o_orderkey)) AS url FROM orders GROUP BY 1""")
def stream_choice(spark, folder):
    """Best sniffed stream per company; ties to the one seen first."""
    rows = table(spark, folder, "orders").select(F.col("o_custkey").alias("company_id"), "o_orderkey", F.concat(
        F.lit("https://"), F.when(F.col("o_orderstatus") == "F", "stream.example.com").otherwise("cdn.example.net"), F.lit("/"), F.col("o_orderkey").cast("string"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "/master.m3u8").otherwise("/part.m3u8")).alias("url"))
    return rows.groupBy("company_id").agg(F.min_by("url", F.struct(web.stream_priority(F.col("url"), "stream.example.com"), F.col("o_orderkey"))).alias("url"))


@query("stream_address", """
SELECT o_orderkey AS event_id, CASE WHEN o_orderstatus <> 'P' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'https://stream.example.com/c' || o_custkey ELSE 'https://stream.example.com/default' END
   || '/v' || o_orderkey || '/master.m3u8' END AS address FROM orders""")
def stream_address(spark, folder):
    """Stream URL from nested player configurations."""
    s = lambda c: F.col(c).cast("string")
    raw = F.concat(
        F.lit('{"note": "a \\"manifest\\": \\"/no/master.m3u8\\" in words", "manifest": {"manifest": ["/in/a/list/master.m3u8"]}, "player": {"hostName": "https:\\/\\/'), F.when(F.col("o_orderpriority") == "1-URGENT", "stream.example.com").otherwise("other.example.net"),
        F.lit("/c"), s("o_custkey"), F.lit('/", "tracks": [{"id": 1, "manifest": "/old/list.txt"}, {"manifest": "/v'), s("o_orderkey"),
        F.when(F.col("o_orderstatus") == "P", "/part.mpd").otherwise("/master.m3u8"), F.lit('"}]}}'))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("event_id"), web.stream_address(raw, "stream.example.com", "https://stream.example.com/default").alias("address"))


@query("clean_cik", "SELECT c_custkey AS company_id, lpad(regexp_replace(c_name, '[^0-9]', '', 'g'), 10, '0') AS cik FROM customer")
def clean_cik(spark, folder):
    return table(spark, folder, "customer").select(F.col("c_custkey").alias("company_id"), web.clean_cik(F.col("c_name")).alias("cik"))


@query("exhibit_documents", """
WITH d AS (SELECT l_orderkey AS event_id, l_linenumber AS pos, CASE l_returnflag WHEN 'A' THEN 'ex99-' || l_partkey || '.htm' WHEN 'R' THEN 'R' || l_linenumber || '.htm'
   ELSE 'doc' || l_partkey || CASE WHEN l_linestatus = 'F' THEN '.html' ELSE '.xml' END END AS name FROM lineitem),
c AS (SELECT *, CASE WHEN regexp_matches(lower(name), '^r[0-9]+\\.htm$') OR name LIKE '%.xml' THEN NULL
   WHEN regexp_matches(lower(name), 'ex99|ex-99|exhibit99|991|99-1|press|release|pr|earnings') THEN 0 ELSE 1 END AS cls FROM d)
SELECT event_id, name, min(cls * 1000 + pos) AS ord FROM c WHERE cls IS NOT NULL GROUP BY ALL""")
def exhibit_documents(spark, folder):
    """Likely exhibits first, then other pages, each document once."""
    s = lambda c: F.col(c).cast("string")
    name = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("ex99-"), s("l_partkey"), F.lit(".htm")))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("R"), s("l_linenumber"), F.lit(".htm")))
        .otherwise(F.concat(F.lit("doc"), s("l_partkey"), F.when(F.col("l_linestatus") == "F", ".html").otherwise(".xml"))))
    rows = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("event_id"), F.col("l_linenumber").alias("pos"), name.alias("name"))
    rows = rows.withColumn("cls", web.exhibit_class(F.col("name"))).where(F.col("cls").isNotNull())
    return rows.groupBy("event_id", "name").agg(F.min(F.col("cls") * 1000 + F.col("pos")).alias("ord"))


@query("webcast_status", f"""
WITH k AS (SELECT page_id, url, html, CASE page_id % 10 WHEN 0 THEN 401 WHEN 1 THEN 404 ELSE 200 END AS s,
   CASE WHEN url LIKE '%/de/%' THEN 'The REPLAY has EXPIRED. ' WHEN url LIKE '%/fr/%' THEN 'Attention Required! ' ELSE '' END || html AS body,
   len(regexp_extract_all(html, '<a ')) AS n FROM pages)
SELECT page_id, CASE WHEN s = 401 THEN '{fv.STATUS_BLOCKED}' WHEN s = 404 THEN '404' WHEN url LIKE '%/fr/%' THEN '{fv.STATUS_BLOCKED}'
  WHEN url LIKE '%/de/%' THEN '{fv.STATUS_EXPIRED}' WHEN n >= 7 THEN '{fv.STATUS_FORM}' WHEN contains(url, '?') THEN '{fv.STATUS_MEDIA}' ELSE '{fv.STATUS_NONE}' END AS status FROM k""")
def webcast_status(spark, folder):
    """HTTP status by page number, body prefixed by language, links over five standing in for form fields."""
    rows = table(spark, folder, "pages")
    code = F.when(F.col("page_id") % 10 == 0, 401).when(F.col("page_id") % 10 == 1, 404).otherwise(200)
    body = F.concat(F.when(F.col("url").contains("/de/"), "The REPLAY has EXPIRED. ").when(F.col("url").contains("/fr/"), "Attention Required! ").otherwise(""), "html")
    inputs = F.regexp_count("html", F.lit("<a ")) - 5
    return rows.select("page_id", cap.webcast_status(code, body, inputs, F.col("url").contains("?"), F.col("url")).alias("status"))


@query("company_doc_match", f"""
WITH n AS (SELECT DISTINCT w AS name FROM (SELECT unnest({words_sql('lower(text)')}) AS w FROM benchmark) WHERE length(w) >= 9),
t AS (SELECT page_id, lower(url) AS u, lower(html) AS h FROM pages)
SELECT DISTINCT page_id AS doc_id, name AS ticker FROM t, n WHERE contains(u, name) OR contains(h, name)""")
def company_doc_match(spark, folder):
    """Pages whose URL or text names one of the long words of the benchmark passages."""
    words = table(spark, folder, "benchmark").select(F.explode(word_array(F.lower("text"))).alias("name")).where(F.length("name") >= 9).distinct()
    docs = table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), "url", F.col("html").alias("text"))
    return disc.company_documents(docs, words.select(F.col("name").alias("ticker"), "name"))


@query("call_id_resolution", """
WITH f AS (SELECT DISTINCT p_name || '_' || p_brand AS stem FROM part),
r AS (SELECT DISTINCT CASE WHEN p_size < 15 THEN p_name || '_' || p_brand || '.wav' WHEN p_size < 30 THEN upper(p_name || '_' || p_brand) ELSE p_brand || '.json' END AS request FROM part),
k AS (SELECT request, trim(replace(replace(request, '.wav', ''), '.json', '')) AS c FROM r),
j AS (SELECT request, stem, CASE WHEN stem = c THEN 0 WHEN lower(stem) = lower(c) THEN 1 ELSE 2 END AS how FROM k, f WHERE contains(lower(stem), lower(c)))
SELECT request, min_by(stem, (how, stem)) AS stem, min(how) AS match_class FROM j GROUP BY request""")
def call_id_resolution(spark, folder):
    part = table(spark, folder, "part")
    stem = F.concat("p_name", F.lit("_"), "p_brand")
    asked = F.when(F.col("p_size") < 15, F.concat(stem, F.lit(".wav"))).when(F.col("p_size") < 30, F.upper(stem)).otherwise(F.concat("p_brand", F.lit(".json")))
    return disc.resolve_call_ids(part.select(asked.alias("request")), part.select(stem.alias("stem")))


@query("discovery_registry", "WITH " + RELEASES.strip() + """,
ok AS (SELECT *, CASE WHEN pri = '5-LOW' THEN 2 ELSE 0 END AS cls FROM calls WHERE NOT (pri = '5-LOW' AND st = 'F')),
filed AS (SELECT * FROM ok QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY event_id) = 1)
SELECT c_custkey AS company_id, fiscal_period, call_at AS call_datetime_utc, zone AS timezone_as_published,
  coalesce(CASE WHEN st = 'F' THEN 'https://event.on24.com/' || event_id END, 'https://ir.example.com/' || c_custkey || '/events') AS webcast_url,
  CASE WHEN st = 'F' THEN 'ON24' ELSE 'In-house' END AS vendor, CASE WHEN event_id IS NULL THEN 'IR_EVENTS_PAGE' ELSE 'SEC_EDGAR_6-K' END AS discovery_source,
  CASE WHEN event_id IS NULL THEN 0.5e0 WHEN call_at IS NULL THEN 0.6e0 ELSE 0.95e0 END AS confidence
FROM customer LEFT JOIN filed ON company_id = c_custkey""")
def discovery_registry(spark, folder):
    """One event per company from its filings (an order is a filing, older ones first), default rows for the rest."""
    companies = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("ticker"), F.lit("US-X").alias("country"),
        F.concat(F.lit("https://ir.example.com/"), F.col("c_custkey").cast("string")).alias("ir_page_url"))
    docs = releases(spark, folder).select(
        F.col("company_id").cast("string").alias("ticker"), F.lit("US-X").alias("country"), F.lit("6-K").alias("form"), F.lit("").alias("items"),
        F.col("event_id").alias("filing_rank"), F.lit(0).alias("doc_rank"), "filing_date", F.lit(None).cast("string").alias("accepted_at"),
        F.concat(F.lit("<html><body><p>"), "text", F.lit("</p></body></html>")).alias("html"))
    out = disc.registry_rows(companies, docs, docs.where("filing_rank < 0"))
    return out.select(F.col("ticker").cast("long").alias("company_id"), "fiscal_period",
                      F.col("call_datetime_utc").cast("timestamp_ntz").alias("call_datetime_utc"), "timezone_as_published",
                      "webcast_url", "vendor", "discovery_source", "confidence")


@query("submission_filings", """
WITH r AS (SELECT l_orderkey AS cik, row_number() OVER w - 1 AS filing_rank, l_returnflag, l_linestatus, l_partkey FROM lineitem
           WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus))
SELECT cik, filing_rank, l_returnflag AS form, CAST(l_partkey AS VARCHAR) AS "accessionNumber" FROM r
WHERE l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F')""")
def submission_filings(spark, folder):
    """Parallel arrays per filer (an order's lines) opened into filings and filtered by form and item."""
    recent = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("cik")).agg(F.sort_array(F.collect_list(
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))).alias("_r"))
    part = lambda c: F.transform("_r", lambda x: x[c].cast("string"))
    nothing = F.transform("_r", lambda x: F.lit(None).cast("string"))
    arrays = F.struct(part("l_returnflag").alias("form"), part("l_partkey").alias("accessionNumber"), nothing.alias("filingDate"),
                      nothing.alias("primaryDocument"), part("l_linestatus").alias("items"), nothing.alias("acceptanceDateTime"))
    rows = disc.filings_from_submissions(recent.select("cik", F.struct(arrays.alias("recent")).alias("filings")))
    wanted = (F.col("form") == "A") | ((F.col("form") == "N") & F.col("items").contains("F"))
    return rows.where(wanted).select("cik", F.col("filing_rank").cast("long").alias("filing_rank"), "form", "accessionNumber")
