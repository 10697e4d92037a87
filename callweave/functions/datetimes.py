"""Call dates, time zones and fiscal periods read from prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from callweave.functions import fixed_values as fv
from callweave.functions.editdist import bind


def clean_zone(label: Column) -> Column:
    """Published time-zone label to its lookup key: a dual label's first known part, the whole label, else the first
    known key inside it."""
    keys = F.array(*[F.lit(k) for k, _ in fv.TIME_ZONES])

    def lookup(text: Column) -> Column:
        parts = F.transform(F.split(text, "/"), lambda p: F.trim(p))
        in_parts = F.when(text.contains("/"), F.get(F.filter(parts, lambda p: F.array_contains(keys, p)), F.lit(0)))
        whole = F.when(F.array_contains(keys, text), text)
        return F.coalesce(in_parts, whole, F.get(F.filter(keys, lambda k: F.contains(text, k)), F.lit(0)))

    plain = F.regexp_replace(F.trim(F.regexp_replace(F.upper(label), r"[()\[\]]", "")), r"\s+", " ")
    return F.when(label != "", bind(plain, lookup))


def zone_region(key: Column) -> Column:
    pairs = [F.lit(x) for pair in fv.TIME_ZONES for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def parse_day(text: Column) -> Column:
    """Midnight of a written date in any of the accepted formats; null if none fits."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), r"[.,]+$", ""), r"\s+", " ")
    return F.coalesce(*[F.try_to_timestamp(plain, F.lit(fmt)) for fmt in fv.DATE_FORMATS])


def parse_call(day: Column, clock: Column, zone: Column) -> Column:
    """Struct of the UTC instant and the cleaned zone; no clock or zone gives no instant."""
    part = lambda i: F.regexp_extract(clock, r"(?i)(\d{1,2})(?::(\d{2}))?\s*(a\.m\.|p\.m\.|am|pm)?", i)
    hour, minute = F.try_to_number(F.nullif(part(1), F.lit("")), F.lit("99")).cast("int"), F.coalesce(F.nullif(part(2), F.lit("")), F.lit("0")).cast("int")
    half = F.replace(F.lower(part(3)), F.lit("."), F.lit(""))
    hour = F.when((half == "pm") & (hour < 12), hour + 12).when((half == "am") & (hour == 12), 0).otherwise(hour)
    key = clean_zone(zone)
    local = parse_day(day) + F.make_dt_interval(F.lit(0), hour, minute)
    instant = F.when((hour < 24) & (minute < 60), F.to_utc_timestamp(local, zone_region(key)))
    return F.struct(F.when(key.isNotNull(), instant).alias("at"), F.when(day.isNotNull(), key).alias("zone"))


def announced_at(filing_day: Column, accepted: Column) -> Column:
    """Acceptance instant, else 20:00 UTC on the filing day."""
    stamp = F.try_to_timestamp(F.regexp_replace(accepted, r"(\.000)?Z$", "+00:00"), F.lit("yyyy-MM-dd'T'HH:mm:ssXXX"))
    return F.coalesce(stamp, F.try_to_timestamp(filing_day, F.lit("yyyy-MM-dd")) + F.expr("interval 20 hours"))


def _phrase_reader(pattern: str, places: list[tuple[int, int, int]], today: Column):
    def read(hit: Column) -> Column:
        group = lambda i: F.nullif(F.regexp_extract(hit, pattern, i), F.lit(""))
        day = F.coalesce(*[group(d) if d else F.lit(None).cast("string") for d, _, _ in places], today)
        clock = F.coalesce(*[group(c) for _, c, _ in places])
        zone = F.coalesce(*[group(z) for _, _, z in places])
        return F.when(hit != "", bind(parse_call(day, clock, zone), lambda call: F.when(call["at"].isNotNull(), call)))

    return read


def call_time(text: Column, announced: Column) -> Column:
    """Struct (at, zone) of the call announced in a text: the first phrase pattern that yields an instant, rejected when
    more than two days after or a year before the announcement."""
    today = F.date_format(announced, "MMMM d, yyyy")
    found = []
    for _, pattern, places in fv.CALL_TIME_PATTERNS:
        found.append(bind(F.regexp_extract(text, pattern, 0), _phrase_reader(pattern, places, today)))
    def in_range(call: Column) -> Column:
        days = (F.unix_micros(call["at"]) - F.unix_micros(announced)) / F.lit(86_400_000_000.0)
        return F.when(announced.isNull() | ((days <= 2.0) & (days >= -365.0)), call)

    return bind(F.coalesce(*found), in_range)  # stops at the first phrase that works


def quarter_number(word: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in fv.QUARTER_WORDS.items() for x in pair]), F.lower(word))


def calendar_period(ticker: Column, filing_day: Column) -> Column:
    """Fiscal period a company reports on in the filing's month."""
    day = F.try_to_timestamp(filing_day, F.lit("yyyy-MM-dd"))
    out = F
    for who, months, quarter, shift in fv.CALENDAR_RULES:
        rule = F.month(day).isin(months)
        rule = rule & (ticker == who) if who else rule
        out = out.when(rule, F.concat(F.lit(f"Q{quarter} FY"), (F.year(day) + shift).cast("string")))
    return out


def fiscal_period(
    text: Column, filing_day: Column | None = None, ticker: Column | None = None, head: int | None = None, guidance: int | None = None
) -> Column:
    """Fiscal period by the company's own wording in a release, else by its calendar.

    The whole text is read. `head` and `guidance` restrict the wording and the word "guidance" to so many first characters."""
    nothing = F.lit(None).cast("string")
    expected = nothing if filing_day is None or ticker is None else calendar_period(ticker, filing_day)
    who = nothing if ticker is None else ticker
    head = F.substring(text, 1, head) if head else text
    warned = F.substring(text, 1, guidance) if guidance else text

    def pick(pattern: str, make) -> Column:
        return bind(F.regexp_extract(head, pattern, 0), lambda hit: F.when(
            hit != "", make(lambda i: F.regexp_extract(hit, pattern, i))))

    label = lambda quarter, year: F.concat(F.lit("Q"), quarter, F.lit(" FY"), year)
    long_year = lambda y: F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    worded = pick(fv.PERIOD_WORD_YEAR, lambda g: label(quarter_number(g(1)), g(2)))
    distrust = F.lower(warned).contains("guidance") | F.coalesce(who.isin(fv.CALENDAR_FIRST_TICKERS), F.lit(False))
    worded = F.when(worded.isNotNull() & expected.isNotNull() & distrust, expected).otherwise(worded)

    def ended(g) -> Column:
        month, out = F.lower(g(1)), F
        for name, months, quarter in fv.PERIOD_ENDED_RULES:
            rule = month.isin(months)
            rule = F.coalesce(who == name, F.lit(False)) & rule if name else rule
            out = out.when(rule, label(F.lit(str(quarter)), g(2)))
        return out

    return F.coalesce(
        worded,
        pick(fv.PERIOD_YEAR_WORD, lambda g: label(quarter_number(g(2)), g(1))),
        pick(fv.PERIOD_NQ, lambda g: label(g(1), long_year(g(2)))),
        pick(fv.PERIOD_QN, lambda g: label(g(1), long_year(g(2)))),
        pick(fv.PERIOD_WORD_LATER_YEAR, lambda g: label(quarter_number(g(1)), long_year(g(2)))),
        pick(fv.PERIOD_ENDED, ended),
        expected,
    )


def is_other_event(text: Column, head: int | None = None) -> Column:
    """Investor days, conferences and shareholder meetings: such a phrase and no word of a quarter, in the text or its first `head` characters."""
    head = F.lower(F.substring(text, 1, head) if head else text)
    any_in = lambda words: head.rlike("|".join(words))  # noqa: E731  (plain phrases, no pattern characters)
    return any_in(fv.NON_EARNINGS_WORDS) & ~any_in(fv.QUARTERLY_WORDS)


def lead_hours(call: Column, announced: Column) -> Column:
    return F.round((F.unix_micros(call) - F.unix_micros(announced)) / F.lit(3_600_000_000.0), 2)


def filing_flags(text: Column, zone: Column) -> dict[str, Column]:
    """Dial-in and registration (true or unknown, never false) and the last replay instant."""
    until = F.nullif(F.regexp_extract(text, fv.REPLAY_UNTIL, 1), F.lit(""))
    return {
        "dial_in_available": F.when(text.rlike(fv.DIAL_IN), True),
        "registration_required": F.when(text.rlike(fv.REGISTRATION), True),
        "replay_expiry_date": parse_call(until, F.lit("11:59 PM"), zone)["at"],
    }
