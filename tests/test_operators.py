"""Operators on small fixtures: equality with plain windows, exact cover, sequential references."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from callweave.operators import capture as cap, diarization as diar, intervals, ordered, relational as rel, segments as seg, speakers as spk, words as wd


def test_sliced_windows_equal_plain_windows(spark):
    rnd = random.Random(2)
    rows = [(k, i * 3, rnd.choice([None, 1, 2, 5])) for k in "ab" for i in range(200 if k == "a" else 3)]
    df = ordered.slice_by(spark.createDataFrame(rows, "k string, pos int, v int"), "pos", 20)
    got = ordered.neighbour(df, ["k"], ["pos"], {"nxt": F.col("v"), "np": F.col("pos")}, ahead=True)
    got = ordered.neighbour(got, ["k"], ["pos"], {"prv": F.col("v")}, ahead=False)
    got = ordered.running(got, ["k"], ["pos"], {"s": ("sum", F.coalesce("v", F.lit(0))), "mx": ("max", F.col("v")), "mn": ("min", F.col("v"))})
    w = Window.partitionBy("k").orderBy("pos")
    u = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.lead("v").over(w).alias("nxt"), F.lead("pos").over(w).alias("np"), F.lag("v").over(w).alias("prv"),
                     F.sum(F.coalesce("v", F.lit(0))).over(u).alias("s"), F.max("v").over(u).alias("mx"), F.min("v").over(u).alias("mn"))
    cols = ["k", "pos", "nxt", "np", "prv", "s", "mx", "mn"]
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.select(cols).collect()))


def test_upper_median(spark):
    rnd = random.Random(4)
    data = [(k, float(rnd.randint(0, 40))) for k in "xyz" for _ in range(rnd.randint(1, 60))]
    got = rel.upper_median(spark.createDataFrame(data, "k string, v double"), ["k"], "v", 5.0).collect()
    for r in got:
        values = sorted(v for k, v in data if k == r.k)
        assert (r.upper_median, r.n) == (values[len(values) // 2], len(values))
    assert len(got) == 3


def test_chunk_plan_and_ownership(spark):
    calls = spark.createDataFrame([("a", 200.0), ("b", 60.0), ("c", 60.5), ("d", 0.4)], "call_id string, duration_sec double")
    plan = wd.chunk_plan(calls).collect()
    starts = {c: [r.start_sec for r in plan if r.call_id == c] for c in "abcd"}
    assert starts == {"a": [0.0, 57.0, 114.0, 171.0], "b": [0.0], "c": [0.0, 57.0], "d": [0.0]}
    for c in "abcd":
        mine = [r for r in plan if r.call_id == c]
        assert mine[-1].is_final and sum(r.is_final for r in mine) == 1 and mine[-1].end_sec == mine[-1].duration_sec
    words = [("a", i, i * 0.5) for i in range(400)]
    heard = [(c, r.chunk_idx, i, t) for c, i, t in words for r in plan if r.call_id == c and r.start_sec <= t < r.end_sec]
    df = spark.createDataFrame(heard, "call_id string, chunk_idx int, seq int, start double")
    kept = wd.own_words(df, wd.chunk_plan(calls)).collect()
    assert sorted(r.seq for r in kept) == list(range(400))


def test_utterances_follow_the_word_counter(spark):
    rnd = random.Random(8)
    words, t = [], 0.0
    for i in range(300):
        t += rnd.choice([0.0, 0.1, 0.4, 1.3])
        words.append(("c", i, rnd.choice(["so", "yes.", "right", "%"]), t, t + 0.2, 0.5))
        t += 0.2
    want, cur = [], [words[0]]
    for w in words[1:]:
        quiet = w[3] - cur[-1][4]
        if quiet > 1.2 or (cur[-1][2].endswith(".") and quiet > 0.3) or len(cur) >= 25:
            want.append(cur)
            cur = []
        cur.append(w)
    want.append(cur)
    df = spark.createDataFrame(words, "call_id string, seq int, word string, start double, end double, prob double")
    got = wd.utterances(df).orderBy("start").collect()
    assert [(r.n_words, r.start) for r in got] == [(len(u), u[0][3]) for u in want]


def test_sections_are_sticky(spark):
    texts = ["Welcome", "I turn the call over to Sam", "numbers", "we open the call for questions after our prepared remarks", "more",
             "first question please", "answer", "numbers"]
    rows = [("c", i, float(i * 10), float(i * 10 + 5), t, None) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "call_id string, idx int, start double, end double, text string, speaker_role string")
    got = [r.section for r in seg.label_sections(df).orderBy("idx").collect()]
    assert got == ["operator_intro"] + ["prepared_remarks"] * 4 + ["qa"] * 3


def test_overlap_stitch(spark):
    schema = "k int, idx int, start double, end double, text string"
    before = spark.createDataFrame([(1, 0, 0.0, 5.0, "Good morning and welcome to the call."), (1, 1, 5.0, 10.0, "I will turn the meeting over to our CEO.")], schema)
    after = spark.createDataFrame([(1, 0, 7.0, 10.0, "I will turn the meeting over to our CEO."), (1, 1, 10.0, 15.0, "Thank you. Today we report solid results.")], schema)
    got = wd.stitch_pairs(before, after, ["k"]).orderBy("part", "idx").collect()
    assert [r.text[:4] for r in got] == ["Good", "I wi", "Than"]


def test_longest_overlap_join(spark):
    segs = spark.createDataFrame([("a", 1, 0.0, 10.0), ("a", 2, 50.0, 51.0), ("b", 3, 0.0, 1.0), ("a", 4, 4.0, 8.0)], "call_id string, seg_id int, start double, end double")
    turns = spark.createDataFrame([("a", 0, 0.0, 4.0, "X"), ("a", 1, 4.0, 9.0, "Y"), ("a", 2, 5.0, 40.0, "Z")], "call_id string, turn_id int, turn_start double, turn_end double, speaker_id string")
    got = {r.seg_id: r.speaker_id for r in intervals.assign_speakers(segs, turns, 3.0).collect()}
    assert got == {1: "Y", 2: "X", 3: "UNDIARIZED", 4: "Y"}


def sequential_analysts(rows, barred, cue):
    """Reads the question part in order."""
    given, waiting = {}, None
    for who, text in rows:
        if text in cue:
            if cue[text] is not None:
                waiting = cue[text]
            continue
        if waiting and who not in barred and who not in given:
            given[who], waiting = waiting, None
    return given


def test_analyst_announcements_equal_a_sequential_reading(spark):
    rnd = random.Random(11)
    names = ["Keith Weiss", "Karl Keirstead", "Brad Zelnick", "Kash Rangan"]
    cue = {f"question comes from {n} with Barclays.": n for n in names}
    cue["question comes from good morning with Barclays."] = None
    for trial in range(6):
        rows = [(rnd.choice("ABCDEFG"), rnd.choice([*cue, "well", "thanks", "sure"])) for _ in range(60)]
        barred = {"A"}
        df = spark.createDataFrame([(trial, i, w, t) for i, (w, t) in enumerate(rows)], "call_id int, idx int, speaker_id string, text string")
        got = spk.announce_analysts(df, spark.createDataFrame([(trial, b) for b in barred], "call_id int, speaker_id string")).collect()
        assert {r.speaker_id: r.name for r in got} == sequential_analysts(rows, barred, cue)
        assert all(r.role == "Analyst, Barclays" for r in got)


def test_speaker_resolution(spark):
    script = [
        ("S0", "Welcome to the conference call. It is my pleasure to introduce your host."),
        ("S1", "I'm Brett Iversen, Vice President of Investor Relations. With me today are Satya Nadella, Chief Executive Officer and others."),
        ("S1", "I will turn the call over to Satya."),
        ("S2", "Thank you, Brett. Strong quarter. I turn it over to Amy."),
        ("S3", "Thank you, Satya. Revenue grew."),
        ("S1", "We are ready to take questions. Operator, please open the line."),
        ("S0", "Our first question comes from Keith Weiss with Morgan Stanley. Please go ahead"),
        ("S4", "Thanks, how is it going?"),
        ("S2", "Very well."),
        ("S5", "Who am I?"),
    ]
    rows = [("c", i, float(i * 10), float(i * 10 + 9), s, t, "MSFT") for i, (s, t) in enumerate(script)]
    df = spark.createDataFrame(rows, "call_id string, idx int, start double, end double, speaker_id string, text string, ticker string")
    got = spk.resolve_speakers(seg.label_sections(df, role=None)).select("speaker_id", "speaker_name", "speaker_role").distinct().collect()
    assert {r.speaker_id: (r.speaker_name, r.speaker_role) for r in got} == {
        "S0": ("Conference Operator", "Operator"), "S1": ("Brett Iversen", "Vice President of Investor Relations"),
        "S2": ("Satya Nadella", "Chairman and Chief Executive Officer"), "S3": ("Amy Hood", "Chief Financial Officer"),
        "S4": ("Keith Weiss", "Analyst, Morgan Stanley"), "S5": (None, "Unknown")}


def test_speaker_blocks(spark):
    df = spark.createDataFrame([(1, "Intro\nAMY HOOD, CFO: Hello (x) all\nmore\nOPERATOR:\nNext [y] one"), (2, "no labels")], "call_id int, text string")
    got = [(r.call_id, r["name"], " ".join(r.text.split())) for r in spk.speaker_blocks(df).orderBy("call_id", "block_no").collect()]
    assert got == [(1, "AMY HOOD", "Hello all more"), (1, "OPERATOR", "Next one"), (2, "UNKNOWN", "no labels")]


def test_assignment_is_optimal():
    rnd = random.Random(6)
    for _ in range(120):
        r, c = rnd.randint(1, 4), rnd.randint(4, 6)
        grid = [[rnd.randint(0, 9) for _ in range(c)] for _ in range(r)]
        picks = diar.best_assignment(grid)
        assert len(set(picks)) == r
        assert sum(grid[i][j] for i, j in enumerate(picks)) == max(sum(grid[i][j] for i, j in enumerate(p)) for p in itertools.permutations(range(c), r))


@pytest.mark.parametrize("collar,want", [(0.0, (20.0, 2.0, 3.0, 4.0)), (1.0, (17.0, 1.5, 3.0, 3.5))])
def test_diarization_error(spark, collar, want):
    us = 1_000_000
    ref = [("c", 0, 10 * us, "A"), ("c", 10 * us, 20 * us, "B")]
    hyp = [("c", 0, 6 * us, "x"), ("c", 6 * us, 18 * us, "y"), ("c", 20 * us, 23 * us, "x")]
    schema = "call_id string, start long, end long, speaker string"
    got = diar.error_rate(spark.createDataFrame(ref, schema), spark.createDataFrame(hyp, schema), collar).first()
    if collar:
        # Collars drop [0, .5], [9.5, 10.5] and [19.5, 20.5] from the extent (and half a second of the false alarm).
        want = (18.0, 1.5, 2.5, 3.5)
    assert (got.total_sec, got.missed_sec, got.false_alarm_sec, got.confusion_sec) == want
    assert got.der == pytest.approx(sum(want[1:]) / want[0])


def test_upsert_overrides_and_capture(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, v int, t string")
    new = spark.createDataFrame([("a", 2, "z"), ("b", 4, "w"), ("c", 1, "q")], "k string, v int, t string")
    assert {r.k: r.t for r in rel.upsert(old, new, ["k"], F.col("v")).collect()} == {"a": "z", "b": "y", "c": "q"}
    rules = spark.createDataFrame([("a", "t", [], "forced"), ("b", "t", ["q"], "never"), ("c", "t", ["", "q"], None)], "rule_key string, field string, only_if array<string>, value string")
    got = rel.apply_overrides(rel.upsert(old, new, ["k"], F.col("v")), rules, "k", ["t"]).collect()
    assert {r.k: r.t for r in got} == {"a": "forced", "b": "y", "c": None}
    row = spark.createDataFrame([("https://a.b/x", 16000, 1, 16, "h", 1300.0, 40_000_000)], "source_url string, sample_rate int, channels int, bit_depth int, sha256 string, duration_sec double, file_size long")
    assert row.select(cap.capture_verdict(F.lit(False))).first()[0] == "VALID"
    assert row.select(cap.capture_verdict(F.lit(True))).first()[0].startswith("SHA256 h")


def test_word_times_splits_a_segment_once(spark):
    """Nothing above the generator works on the segment's text: it would do so once for every word."""
    from callweave.operators import words as wd
    from callweave.plans.adapters import word_array

    rows = spark.createDataFrame([(1, 0, 2.0, 4.0, " one  two three four "), (1, 1, 4.0, 4.0, "")], "call_id long, idx long, start double, end double, text string")
    out = wd.word_times(rows, word_array(F.col("text")))
    above = out._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "regexp_replace" not in above and "split" not in above
    assert [tuple(r) for r in out.orderBy("pos").collect()] == [
        (1, 0, 0, "one", 2.0, 2.5), (1, 0, 1, "two", 2.5, 3.0), (1, 0, 2, "three", 3.0, 3.5), (1, 0, 3, "four", 3.5, 4.0)]


def test_spread_after_a_grouping_by_the_same_key(spark):
    """The exchange of the grouping does not stand in for the spread, or the planner folds it into few tasks."""
    rows = spark.range(200).select((F.col("id") % 50).alias("call_id"), F.col("id").alias("idx"), F.lit("word").alias("text"))
    out = ordered.spread(seg.assemble_text(rows, ["call_id"]), "call_id")
    assert out.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out.count() == 50
