"""Column functions and small helpers against plain Python."""

import difflib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from callweave.functions import alignment, datetimes as dt, editdist as ed, entities as ent, fixed_values as fv, names as nm, text as tx, web
from callweave.operators import matching


def one(spark, column, **values):
    """Evaluates one column over literal inputs given as columns."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return row.select(column.alias("out")).first()["out"]


def table_distance(a, b):
    """(distance, most hits) by the full table."""
    grid = [[(i + j, 0) if not i or not j else None for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d, h = grid[i - 1][j - 1]
            diagonal = (d, h - 1) if a[i - 1] == b[j - 1] else (d + 1, h)
            grid[i][j] = min(diagonal, (grid[i - 1][j][0] + 1, grid[i - 1][j][1]), (grid[i][j - 1][0] + 1, grid[i][j - 1][1]))
    return grid[-1][-1][0], -grid[-1][-1][1]


def random_pairs(n, seed, letters="abcd"):
    rnd = random.Random(seed)
    for _ in range(n):
        a = [rnd.choice(letters) for _ in range(rnd.randint(0, 16))]
        yield a, [rnd.choice(letters) for _ in range(rnd.randint(0, 16))]
    base = [rnd.choice("abcdefghij") for _ in range(700)]
    yield base, [x for x in base if rnd.random() > 0.1]
    yield base, [x if rnd.random() > 0.3 else "z" for x in base][40:]


def test_edit_counts_and_alignment():
    for a, b in random_pairs(800, 3):
        assert ed.edit_counts(a, b) == table_distance(a, b)
        assert ed.edit_distance(a, b) == table_distance(a, b)[0]
        want = difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes()
        assert alignment.edit_script(alignment.matching_blocks(a, b), len(a), len(b)) == [tuple(w) for w in want]


def test_distance_columns(spark):
    pairs = list(random_pairs(60, 9))
    df = spark.createDataFrame([(i, a, b, "".join(a), "".join(b)) for i, (a, b) in enumerate(pairs)], "i int, a array<string>, b array<string>, s string, t string")
    rows = df.select("i", ed.word_distance(F.col("a"), F.col("b")).alias("w"), ed.char_distance(F.col("s"), F.col("t")).alias("c"),
                     ed.edit_breakdown(F.col("a"), F.col("b")).alias("e")).collect()
    for r in rows:
        a, b = pairs[r.i]
        d, h = table_distance(a, b)
        assert (r.w, r.c, r.e.distance, r.e.hits) == (d, d, d, h)
        assert r.e.substitutions + r.e.deletions + r.e.insertions == d
        assert r.e.hits + r.e.substitutions + r.e.deletions == len(a)
        assert min(r.e) >= 0


def test_error_rates(spark):
    same = "Apple revenue reached eighty five billion dollars".split()
    less = "Apple revenue reached eighty billion dollars".split()
    df = spark.createDataFrame([(same, same), (same, less), ([], []), ([], less)], "r array<string>, h array<string>")
    assert [r[0] for r in df.select(ed.word_error_rate(F.col("r"), F.col("h"))).collect()] == [0.0, pytest.approx(1 / 7), 0.0, 1.0]


def test_grouped_contractions_equal_the_rule_by_rule_chain(spark):
    rnd = random.Random(5)
    words = [s for s, _ in fv.CONTRACTIONS] + ["hi", "Éum", "you'd've", "he'd've", "can't've", "x'cause", "It'll", "étéit's"]
    texts = [" ".join(rnd.choice(words).title() if rnd.random() < 0.2 else rnd.choice(words) for _ in range(40)) for _ in range(80)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    bad = df.where(F.lower(tx.expand_contractions(F.col("t"))) != F.lower(tx.expand_fast(F.col("t"))))
    assert bad.count() == 0


def test_normalize_v1(spark):
    norm = lambda t: one(spark, tx.normalize_v1(F.col("t")), t=t)
    money = norm("Revenue reached $85.8B with gross profit of $24.2 billion.")
    assert "85.8 billion dollars" in money and "24.2 billion dollars" in money
    assert "46.3 percent" in norm("Gross margin was 46.3% and grew by 5 percent.")
    assert norm("Um, we're confident that, uh, it's growing.") == "we are confident that it is growing"
    assert norm("one v1.2.3 ends.") == "1 v1.2.3 ends"


def test_normalize_v2(spark):
    norm = lambda t, ref=False: one(spark, tx.normalize(F.col("t"), ref), t=t)
    assert norm("It’s $2.5B—up 1,000,000 (15%) um, you know; café’s well-known") == "it is 2.5 billion dollars up 1000000 15 percent café s well known"
    assert norm("[0.0 --> 2.5] Don't") == "do not"
    assert norm("1,2,3,4,5") == "1234 5"  # the comma rule runs twice, no more
    published = "Microsoft FY26 Fourth Quarter Earnings Call\nWednesday, July 29, 2026\nAmy Hood, Keith Weiss\nAMY HOOD: Thank you (pause) all.\nKEITH WEISS\nTHANK YOU\nEND"
    assert norm(published, True) == "thank you all thank you"


def test_reference_split(spark):
    remarks, questions = tx.split_reference(F.col("t"))
    text = "A one\nB two\nWe now open the call for questions please\nC three"
    assert one(spark, questions, t=text).strip().startswith("We now open")
    assert one(spark, remarks, t=text) == "A one\nB two"
    assert one(spark, remarks, t="a\nb\nc\nd\ne") == "a\nb" and one(spark, questions, t="a\nb\nc\nd\ne") == "c\nd\ne"


PHRASES = [
    ("Numbers are in for the fourth quarter of fiscal 2023. Listen in at 3:15 p.m. PT on Monday, November 6, 2023", "2023-11-06", "Q4 FY2023", "2023-11-06 23:15", "PT"),
    ("Our team takes your calls at 1:45 p.m. Pacific time (4:45 p.m. Eastern time) today about the first quarter of fiscal 2022.", "2021-10-20", "Q1 FY2022", "2021-10-20 20:45", "PACIFIC TIME"),
    ("Join the lender on a conference call today, April 11, 2025, at 7:00 a.m. (ET): first-quarter 2025 financial results.", "2025-04-11", "Q1 FY2025", "2025-04-11 11:00", "ET"),
    ("The third quarter of 2022 is closed. A webcast begins at 9:05 a.m. Central Time (CT) on November 2, 2022", "2022-11-02", "Q3 FY2022", "2022-11-02 14:05", "CENTRAL TIME"),
    ("An hour of questions is set for Friday, May 9, 2025 at 11:20 a.m. ET, first-quarter 2025 financial results at hand.", "2025-05-09", "Q1 FY2025", "2025-05-09 15:20", "ET"),
    ("April 29, 2025 10:10 AM CDT 1Q 2025 call with investors", "2025-04-29", "Q1 FY2025", "2025-04-29 15:10", "CDT"),
    ("First Quarter 2025 webcast May 14, 2025 at 6:40pm EDT", "2025-05-14", "Q1 FY2025", "2025-05-14 22:40", "EDT"),
    ("A good second quarter; the board now sees more for FY24", "2023-08-10", "Q2 FY2024", None, None),
    ("Fourth Quarter and Fiscal Year 2021 in figures", "2021-08-12", "Q4 FY2021", None, None),
    ("We speak on February 24, 2025 at 2:00 p.m. ET about the fourth quarter 2024", "2025-01-02", "Q4 FY2024", None, None),  # two days are the limit
]


@pytest.mark.parametrize("text,day,period,at,zone", PHRASES)
def test_release_phrases(spark, text, day, period, at, zone):
    announced = dt.announced_at(F.lit(day), F.lit(None).cast("string"))
    got = one(spark, F.struct(dt.fiscal_period(F.col("t")).alias("p"), dt.call_time(F.col("t"), announced).alias("c")), t=text)
    assert got.p == period
    assert (got.c and got.c["at"].strftime("%Y-%m-%d %H:%M")) == at and (got.c and got.c.zone) == zone


def test_date_parsing(spark):
    parse = lambda d, c, z: one(spark, dt.parse_call(F.lit(d), F.lit(c), F.lit(z)))
    got = parse("October 29, 2024", "5:00 PM", "ET")
    assert got["at"].isoformat() == "2024-10-29T21:00:00" and got.zone == "ET"
    assert parse("October 29, 2024", None, None)["at"] is None
    assert parse("2024-01-02", "12 am", "UTC")["at"].isoformat() == "2024-01-02T00:00:00"
    assert parse("5 Jan 2024", "1:05pm", "(Eastern Time)")["at"].isoformat() == "2024-01-05T18:05:00"


def test_calendar(spark):
    rows = [("MSFT", "2026-07-29", "Q4 FY2026"), ("MSFT", "2026-03-01", "Q4 FY2025"), ("WMT", "2026-08-20", "Q2 FY2027"), ("X", "2026-01-10", "Q4 FY2025"), ("X", "bad", None)]
    for ticker, day, want in rows:
        assert one(spark, dt.calendar_period(F.lit(ticker), F.lit(day))) == want


def test_vendors(spark):
    for url, want in [("https://events.q4inc.com/attendee/12345", "Q4 Inc"), ("https://event.notified.com/webcast/player", "Notified"),
                      ("https://event.on24.com/wcc/r/98765", "ON24"), ("https://ir.acme.com/x", "unknown: ir.acme.com"), ("/x", None)]:
        assert one(spark, web.url_vendor(F.col("u")), u=url) == want
    got = one(spark, web.page_vendor(F.col("h"), F.lit("")), h='<iframe src="https://services.choruscall.com/links/aapl.html"></iframe>')
    assert got.vendor.startswith("Chorus Call") and got.confidence == 0.9
    assert one(spark, web.page_vendor(F.col("h"), F.lit("https://ir.acme.com"))  , h="<p>plain</p>").confidence == 0.7


def test_pages(spark):
    html = '<html><!-- x --><script>var t="</p>";</script><body><a href="/ev?a=1&amp;b=2">Event <b>page</b></a><a HREF=x.pdf>results</a><p>A &#233;&nbsp;b &amp;lt;</p></body>'
    assert one(spark, web.page_text(F.col("h")), h=html).replace(" ", " ") == "Event page results A é b &lt;"
    assert one(spark, web.relevant_links(F.col("h"), F.lit("https://ir.x.com/a/b.html?q=1")), h=html) == ["https://ir.x.com/ev?a=1&b=2"]
    raw = '{"a":{"hostName":"https://stream.event.example/p/","x":[{"manifest":"/v/master.m3u8"}]}}'
    assert one(spark, web.stream_address(F.col("j"), "stream.event", "d"), j=raw) == "https://stream.event.example/p/v/master.m3u8"
    assert one(spark, web.clean_cik(F.lit("CIK 12345678901"))) == "12345678901"


def test_names(spark):
    assert one(spark, nm.clean_name(F.lit("comes from the line of Mr. Keith Weiss,"))) == "Keith Weiss"
    for name, ok in [("Keith Weiss", True), ("Good Morning", False), ("keith weiss", False), ("Solo", False), ("Conference Operator", True)]:
        assert one(spark, nm.is_person(F.lit(name))) is ok
    assert one(spark, nm.clean_firm(F.lit("Goldman, please go ahead"))) == "Goldman Sachs"
    assert one(spark, nm.clean_role(F.lit("Interim CFO"))) == "Chief Financial Officer"
    cue = one(spark, nm.analyst_cue(F.lit("Our next question comes from the line of Keith Weiss with Morgan. Please go ahead")))
    assert (cue.name, cue.firm) == ("Keith Weiss", "Morgan Stanley")


def test_entities(spark):
    text = "Revenue was $10.5 billion, margin was 32.5%, CEO Tim Cook spoke on January 15, 2025."
    lists = ent.normal_lists(ent.entities_7(F.col("t")))
    row = spark.createDataFrame([(text,)], "t string").select(lists.alias("r"), lists.alias("h"))
    got = row.select(ent.overall(ent.weighted_accuracy(F.col("r"), F.col("h"))).alias("x")).first().x
    assert got >= 0.95
    found = one(spark, ent.entities_6(F.col("t")), t="GitHub Copilot and copilot: $5B, MSFT msft, Q3 FY2024, 10 basis points")
    assert found["company_product"] == ["Copilot", "Copilot", "GitHub", "GitHub Copilot"]
    assert found["tickers"] == ["MSFT"] and found["percentages"] == ["10 basis points"]


def test_dictionary_counts_and_containment(spark):
    docs = spark.createDataFrame([(1, "ha ha ha ha ha ok ok"), (2, "no"), (3, "ok ha")], "id int, t string")
    phrases = spark.createDataFrame([("ha ha",), ("ok",), ("ha ok",)], "phrase string")
    got = matching.dictionary_counts(docs.select("id", F.split("t", " ").alias("tokens")), phrases, "id", 2).collect()
    assert {(r.id, r.phrase): r.n for r in got} == {(1, "ha ha"): 2, (1, "ok"): 2, (1, "ha ok"): 1, (3, "ok"): 1}
    texts = spark.createDataFrame([(1, "the flywheel spins"), (2, "é wheel"), (3, "")], "id int, t string")
    needles = spark.createDataFrame([("wheel",), ("flywheel s",), ("é",), ("zzz",), ("",)], "p string")
    pairs = {(r.id, r.p) for r in matching.containing(texts, ["id"], "t", needles, "p").collect()}
    assert pairs == {(1, "wheel"), (2, "wheel"), (1, "flywheel s"), (2, "é")}


def test_page_text_references_and_quotes(spark):
    from callweave.functions import web

    html = """<p title="a>b" class='c>d'>x &mdash; y&#x2014;z &rsquo;&amp;lt;&#8212;</p><b>&unknown; &#0; &#55296; AT&T</b><i "open>left</i>"""
    got = spark.createDataFrame([(html,)], "h string").select(web.page_text(F.col("h")).alias("t")).first().t
    assert got == "x — y—z ’&lt;— &unknown; � � AT&T left"


def test_edit_distance_of_long_and_lopsided_pairs():
    from callweave.functions.editdist import edit_distance

    draw = np.random.default_rng(1)
    long = draw.integers(0, 5000, 60_000).tolist()
    other = list(long)
    for k in range(50, 60_000, 1000):
        other[k] = -1
    assert edit_distance(long, other) == 60
    assert edit_distance([1], list(range(40_000))) == 39_999


def test_texts_of_a_key_at_any_depth(spark):
    raw = '{"k": "a\\"b", "x": [{"k": "second"}, {"y": {"k": {"k": "third"}}}], "k": "fourth", "text": "\\"k\\": \\"no\\"", "k": 5}'
    assert one(spark, web.json_values(F.col("t"), "k"), t=raw) == ['a"b', "second", "third", "fourth"]
    deep = '{"a": [' * 200 + '{"k": "down \\u00e9"}' + "]}" * 200
    assert one(spark, web.json_values(F.col("t"), "k"), t=deep) == ["down é"]
    assert one(spark, web.json_values(F.col("t"), "k"), t='{"k": "open') == []


def test_long_chains_read_only_the_runs_they_can_touch(spark):
    """Contractions and amounts are rewritten inside their own runs: with long words around them the chain stays short, with the results of rules
    applied to the whole text one after the other."""
    def whole(text, rules):
        for short, long in rules:
            text = F.regexp_replace(text, rf"(?iU)\b{short}\b", long)
        return text

    def spelled(text):
        for _ in range(2):
            text = F.regexp_replace(text, r"(\d+),(\d+)", "$1$2")
        for letters, word in tx.MAGNITUDES:
            text = F.regexp_replace(text, rf"(?U)\$\s*([0-9]+(?:\.[0-9]+)?)\s*(?:[{letters}]|{word})\b", f"$1 {word} dollars")
        text = F.regexp_replace(text, r"\$\s*(\d+(?:\.\d+)?)", "$1 dollars")
        return F.regexp_replace(text, r"(\d+(?:\.\d+)?)\s*%", "$1 percent")

    texts = [None, "", "plain", "he'd've and I'm, CAN'T've-it's\nthey're", "'cause 'tis ''x'' o'clock", "\x00don't\x00'", "$ 5.$5billion", "$ $5 billion, $\n$3 million 12%",
             "$1.2.3 k $4kx $7\u00e9 1,2,3,4 5 %", "\u0131'm \u017fhe's"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    t = F.col("text")
    for r in rows.select(tx.expand_contractions(t), whole(t, fv.CONTRACTIONS), tx.spell_figures(t), spelled(t)).collect():
        assert r[0] == r[1] and r[2] == r[3]
    plan = rows.select(tx.expand_contractions(t).alias("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in plan


def test_edit_distance_of_pairs_that_differ_little():
    """Long texts with few edits take work by their edits; results equal the bit vectors'."""
    import time

    rnd = random.Random(5)
    text = "".join(rnd.choice("abcdefgh é漢") for _ in range(150_000))
    other = text[:70_000] + "xyz" + text[70_000:120_000] + text[120_002:]
    begun = time.perf_counter()
    assert ed.edit_distance(text, other) == 5 and time.perf_counter() - begun < 3
    for letters in ("ab", "abcdefgh é漢", [str(k) for k in range(400)]):
        a = [rnd.choice(letters) for _ in range(600)]
        b = [rnd.choice(letters) if rnd.random() < 0.1 else x for x in a if rnd.random() > 0.05]
        for one_side, two_side in ((a, b), ("".join(a), "".join(b))):
            assert ed._waves(one_side, two_side, 1e12) == ed._bit_vectors(one_side, two_side)
    assert ed._waves("ab" * 500, "zy" * 500, 100.0) is None


def test_text_distances(spark):
    rows = spark.createDataFrame([("a b c", "a x c d"), ("", "a"), ("", ""), (None, "a")], "r string, h string")
    out = rows.select(ed.text_distances(F.col("r"), F.col("h")).alias("d")).select("d.*").collect()
    assert [tuple(r) for r in out] == [(2, 3, 4, 3, 5, 7), (1, 0, 1, 1, 0, 1), (0, 0, 0, 0, 0, 0), (None,) * 6]


def test_normal_hits_equal_those_of_normal_lists(spark):
    """Hits found by normalising only what the reference lacks are those of the lists normalised in full."""
    texts = [("$5 billion and 12 % by Tim Cook in Q3", "$5 Billion, 12% by TIM COOK in Q3"), ("MSFT, Azure, 3 percent", "nothing"), ("", "$7b FY2024"),
             ("10 million, 10 million, 4%", "10 million dollars, $10 million, 4 percent, 4%")]
    found = spark.createDataFrame(texts, "r string, h string").select(*[ent.entities_7(F.col(c)).alias(c) for c in "rh"]).cache()
    fast = ent.weighted_accuracy(F.col("r"), F.col("h"), ent.normal_hits(F.col("r"), F.col("h")))
    full = found.select(ent.normal_lists(F.col("r")).alias("r"), ent.normal_lists(F.col("h")).alias("h")).cache()
    got, want = found.select(fast.alias("x")).collect(), full.select(ent.weighted_accuracy(F.col("r"), F.col("h")).alias("x")).collect()
    assert got == want and any(s.correct for row in got for s in row.x)
