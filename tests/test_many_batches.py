"""Streams fed by shuffled files, one file a micro-batch, against their batch twins; end of call by marker and by timer; the keyed table."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callweave.operators import segments as seg, words as wd
from callweave.plans import streams
from callweave.plans.adapters import call_segments
from callweave.plans.operations import one_row_per_chunk
from callweave.plans.transcripts import call_lengths, heard_words, timed_words
from callweave.sources.keyed_table import KeyedTable
from callweave.streaming import in_order, live

FOLDER, FILES = "/root/testdata/sf0.001", 4


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


@pytest.fixture(scope="module")
def words(spark):
    return streams.stamped_words(spark, FOLDER).where("call_id < 6").cache()


def test_utterances(spark, words):
    columns = ["call_id", "session", "part", "start", "end", "text", "n_words"]
    assert rows(streams.utterances_live(words, FILES), *columns) == rows(wd.utterances(timed_words(spark, FOLDER).where("call_id < 6")), *columns)


def test_windows_and_pauses(spark, words):
    assert rows(streams.windows_live(words, FILES), "call_id", "window_sec", "n_words") == rows(streams.windows_live(words), "call_id", "window_sec", "n_words")
    got = streams.pauses_live(words, FILES)
    assert got.agg(F.sum("n_words")).first()[0] == words.count()
    assert rows(got, "call_id", "from_ms", "to_ms") == rows(streams.pauses_live(words), "call_id", "from_ms", "to_ms")


def test_own_words_of_files_fed_twice(spark):
    heard = heard_words(spark, FOLDER, wd.chunk_plan(call_lengths(spark, FOLDER))).where("call_id < 6").select(
        "call_id", "chunk_idx", "seq", "word", "start", F.timestamp_millis((F.col("start") * 1000).cast("long") + (F.col("call_id") + 1) * 3_600_000).alias("at"))
    got = rows(streams.own_words_live(heard, FILES, twice=True), "call_id", "seq", "word")
    assert got == rows(timed_words(spark, FOLDER).where("call_id < 6"), "call_id", "seq", "word")


def test_backlog_and_sections(spark):
    chunks = one_row_per_chunk(spark, FOLDER).where("call_id < 40")
    assert rows(streams.backlog_live(chunks, FILES), "call_id", "chunk_idx", "backlog_sec") == rows(streams.backlog_live(chunks), "call_id", "chunk_idx", "backlog_sec")
    segments = call_segments(spark, FOLDER).where("call_id < 6")
    assert rows(streams.sections_live(segments, FILES), "call_id", "idx", "section") == rows(seg.label_sections(segments), "call_id", "idx", "section")


def test_call_without_end_marker_is_closed_by_the_timer(spark):
    """Call 1 lacks row 1 and its marker; once the clock has moved past it, what it has leaves in order. Call 2 ends by its marker."""
    schema = "call_id int, position long, s long, closes boolean, chunk_idx int, proc_time_sec double, duration_sec double"
    first = spark.createDataFrame([(1, 2, 1020, False, 2, 50.0, 45.0), (1, 0, 1000, False, 0, 60.0, 45.0), (2, 0, 1000, False, 0, 40.0, 45.0), (2, 1, 1001, True, None, None, None)], schema)
    later = spark.createDataFrame([(3, 5, 90_000, False, 5, 1.0, 2.0)], schema)
    stamp = lambda df: df.withColumn("at", F.timestamp_seconds("s")).drop("s")
    stream = live.replay(stamp(first), 1, last=stamp(later))
    got = rows(live.drain(in_order.backlog(stream, "10 seconds")), "call_id", "chunk_idx", "backlog_sec")
    assert got == [(1, 0, 15.0), (1, 2, 20.0), (2, 0, 0.0)]


def test_late_rows_are_kept_and_win(spark):
    make = lambda r: spark.createDataFrame(r, "call_id int, seq long, word string, s long").withColumn("at", F.timestamp_seconds("s")).drop("s")
    path = live.scratch(spark)
    batches = [make([(1, 0, "helo", 100), (1, 1, "there", 101)]), make([(1, 2, "again", 900)]), make([(1, 0, "hello", 100), (1, 3, "now", 901)])]
    for b in batches:
        b.coalesce(1).write.mode("append").parquet(f"{path}/in")
    table = KeyedTable(spark, f"{path}/table", ["call_id", "seq"], F.struct("pass_no", "at"))
    stream = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", "1").parquet(f"{path}/in")
    live.late_corrections(stream, "at", 60, table, f"{path}/late", f"{path}/checkpoint").awaitTermination()
    assert rows(table.read(), "seq", "word", "pass_no") == [(0, "hello", 1), (1, "there", 0), (2, "again", 0), (3, "now", 0)]
    assert rows(spark.read.parquet(f"{path}/late"), "seq", "word", "batch_no") == [(0, "hello", 2)]


def test_keyed_table(spark):
    make = lambda r: spark.createDataFrame(r, "k int, v int, t string")
    table = KeyedTable(spark, live.scratch(spark), ["k"], F.struct("v", "t"), most_deltas=3)
    with pytest.raises(FileNotFoundError):
        table.read()
    table.commit(make([(1, 1, "a"), (2, 1, "b"), (2, 2, "c")]), 0)
    table.commit(make([(1, 3, "d")]), 1)
    want = [(1, 3, "d"), (2, 2, "c")]
    held = table.read()
    assert rows(held, "k", "v", "t") == want and table.pointer()["snapshot"] is None
    # A replayed batch changes nothing, whatever it holds.
    table.commit(make([(9, 9, "x")]), 1)
    assert rows(table.read(), "k", "v", "t") == want
    # The third delta is folded into a snapshot; a reader of the state before still finds its files.
    table.commit(make([(3, 0, "e")]), 2)
    assert table.pointer()["deltas"] == [] and rows(table.read(), "k", "v", "t") == [*want, (3, 0, "e")]
    assert rows(held, "k", "v", "t") == want
    table.commit(make([(1, 2, "old")]), 3)
    table.compact()
    assert rows(table.read(), "k", "v", "t") == [*want, (3, 0, "e")] and table.pointer()["batch"] == 3
    # A second writer that would take the same pointer fails.
    with pytest.raises(RuntimeError):
        table._write_pointer(table._numbers()[-1], table.pointer())


def test_whole_calls_of_a_bucket_leave_without_state(spark):
    """Calls that come whole in one batch cost no call to the state, however many share a bucket; only the open one is stored."""
    class Kept:
        def __init__(self):
            self.rows, self.puts = [], 0

        def exists(self):
            return bool(self.rows)

        def get(self):
            return iter(self.rows)

        def put(self, rows):
            self.rows, self.puts = rows, self.puts + 1

        def clear(self):
            self.rows = []

    class Handle:
        def __init__(self):
            self.lists, self.timers = {}, []

        def getListState(self, name, schema):
            return self.lists.setdefault(name, Kept())

        def registerTimer(self, at):
            self.timers.append(at)

    class Clock:
        def getCurrentWatermarkInMs(self):
            return 0

    fold = in_order.Backlog("int")
    payload = T.StructType.fromDDL("chunk_idx int, proc double, dur double")
    handle = Handle()
    processor = in_order.Buffered(fold, payload, T.StructType.fromDDL(fold.carry), T.LongType(), ["call_id", "chunk_idx", "backlog_sec", "drained"], 1000)
    processor.init(handle)
    at = pd.Timestamp("2026-01-01")
    whole = [(c, k, at, k == 2, k, 50.0, 45.0) for c in range(500) for k in (1, 2, 0)]
    batch = pd.DataFrame([*whole, (500, 1, at, False, 1, 50.0, 45.0)], columns=["call_id", "position", "at", "closes", "chunk_idx", "proc", "dur"])
    out = pd.concat(processor.handleInputRows((7,), iter([batch]), Clock()))
    assert out[["call_id", "backlog_sec"]].values.tolist() == [[c, b] for c in range(500) for b in (5.0, 10.0)]
    assert {n: (s.puts, len(s.rows)) for n, s in handle.lists.items()} == {"open": (1, 1), "waiting": (1, 1)} and len(handle.timers) == 1


def test_late_corrections_are_written_side_by_side(spark, monkeypatch):
    """No batch of the replay goes through a single task."""
    def refused(self, n):
        raise AssertionError("rows folded into few tasks")

    monkeypatch.setattr(type(spark.range(1)), "coalesce", refused)
    got = streams.stream_late_corrections(spark, FOLDER)
    assert 0 < got.where("pass_no = 1").count() == got.where("length(word) > 8 AND word LIKE '%*'").count() < got.count()


def test_own_words_of_many_calls_share_state(spark, monkeypatch):
    """State is kept for buckets of calls; a call without end marker is closed by the timer, whatever its bucket's other calls do."""
    monkeypatch.setattr(live, "BUCKETS", 1)
    schema = "call_id long, chunk_idx int, seq int, word string, start double, closes boolean, s long"
    words = [(k, 0, i, f"w{i}", at, False, 1000) for k in (1, 2, None) for i, at in enumerate((3.0, 59.0))] + [(2, 0, 2, None, None, True, 1002)]
    stamp = lambda rows: spark.createDataFrame(rows, schema).withColumn("at", F.timestamp_seconds("s")).drop("s")
    stream = live.replay(stamp(words), 1, last=stamp([(3, 0, 0, "far", 1.0, False, 90_000)]))
    live_ = live.own_words_live(stream, "10 seconds")
    assert "_bucket" in live_._jdf.queryExecution().analyzed().toString()
    got = sorted((r.call_id or 0, r.seq) for r in live.drain(live_).collect())
    assert got == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1), (3, 0)]
