"""Calls whose rows arrive in any order: a buffer per call gives them to a fold in order of their position.

State is kept by bucket, the calls of one hash: their open calls in one list, the rows that wait in another. A call that comes whole in one batch
never gets there.

A row has a dense position from 0. Rows ahead of the next expected one wait in list state; a call's end marker (``closes``, its position is the
number of rows) says when it is complete, then all its state goes. A call without a marker is closed by an event-time timer once it has been
quiet past the watermark: what waits is folded in order, gaps and all. A row seen before is dropped, so replayed files change nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from callweave.operators.words import join_words

#: Calls share their state by hash, as a state call costs the same for one call as for thousands. The number must stay for a stream's lifetime.
BUCKETS, FRAME_ROWS = 1024, 10_000
#: Seconds of event time to a second of the clock that state works by. Python has times of nanoseconds, which end in 2262; by this clock they cover
#: all that Spark has. Watermark and timers count milliseconds of the clock, whole seconds of event time.
PACE = 1000


def clocked(rows: DataFrame, at: str, delay: str) -> DataFrame:
    """``rows`` with ``at`` by the clock, and its watermark."""
    logical = rows.sparkSession._jvm.org.apache.spark.sql.catalyst
    wait = logical.plans.logical.EventTimeWatermark.getDelayMs(logical.util.IntervalUtils.fromIntervalString(delay))
    return rows.withColumn(at, F.timestamp_micros(F.unix_millis(at))).withWatermark(at, f"{-(-wait // PACE)} milliseconds")


class Fold:
    """What happens to a call's rows, one after the other. ``carry`` is the DDL of what is kept between rows, ``out`` that of the results."""

    carry: str
    out: str

    def start(self) -> tuple:
        raise NotImplementedError

    def take(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        raise NotImplementedError

    def finish(self, carry: tuple) -> list[tuple]:
        return []


@dataclass
class Buffered(StatefulProcessor):
    fold: Fold
    row_schema: T.StructType
    carry_schema: T.StructType
    key_type: T.DataType
    out_names: list[str]
    quiet: int

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        head = [T.StructField("next", T.LongType()), T.StructField("total", T.LongType()), T.StructField("timer", T.LongType())]
        call = T.StructField("call_id", self.key_type)
        self.open = handle.getListState("open", T.StructType([call, *head, T.StructField("carry", self.carry_schema)]))
        self.waiting = handle.getListState("waiting", T.StructType([call, T.StructField("position", T.LongType()), *self.row_schema.fields]))

    @staticmethod
    def _values(column: pd.Series, field: T.StructField) -> list:
        """Plain values of the field's own type: a batch that holds a marker turns whole numbers and flags into others."""
        kind = {T.BooleanType: bool, T.DoubleType: float, T.FloatType: float}.get(type(field.dataType))
        kind = int if isinstance(field.dataType, T.IntegralType) else kind
        values = column.astype(object).where(column.notna(), None).tolist()
        return values if kind is None else [None if v is None else kind(v) for v in values]

    def _folded(self, call: list, waiting: dict[int, tuple], all_: bool) -> list[tuple]:
        """Folds a call's waiting rows that are next, or all of them. ``call``: next position, total, timer, carry."""
        out: list[tuple] = []
        for k in sorted(waiting):
            if k != call[0] and not all_:
                break
            call[3], more = self.fold.take(call[3], waiting.pop(k))
            out += more
            call[0] = k + 1
        return out

    def _loaded(self) -> tuple[dict, dict]:
        """The bucket's open calls and their rows that wait."""
        calls = {r[0]: [r[1], r[2], r[3], tuple(r[4])] for r in self.open.get()} if self.open.exists() else {}
        waiting: dict = {}
        for r in self.waiting.get() if self.waiting.exists() else ():
            waiting.setdefault(r[0], {})[r[1]] = tuple(r[2:])
        return calls, waiting

    def _stored(self, calls: dict, waiting: dict) -> None:
        rows = [(c, k, *w[k]) for c, w in waiting.items() for k in sorted(w)]
        for state, kept in ((self.open, [(c, *v) for c, v in calls.items()]), (self.waiting, rows)):
            if kept:
                state.put(kept)
            elif state.exists():
                state.clear()

    def _frames(self, rows: list[tuple]) -> Iterator[pd.DataFrame]:
        for at in range(0, len(rows), FRAME_ROWS):
            yield pd.DataFrame(rows[at : at + FRAME_ROWS], columns=self.out_names)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        calls, waiting = self._loaded()
        last: dict = {}
        for batch in rows:
            ids, positions = batch["call_id"].tolist(), batch["position"].tolist()
            ats = batch["at"].astype("datetime64[ms]").astype("int64").tolist()
            columns = [self._values(batch[f.name], f) for f in self.row_schema.fields]
            for call, k, at, closes, row in zip(ids, positions, ats, batch["closes"].tolist(), zip(*columns)):
                open_ = calls.get(call)
                if open_ is None:
                    open_ = calls[call] = [0, -1, -1, self.fold.start()]
                last[call] = max(last.get(call, 0), at)
                if closes:
                    open_[1] = max(open_[1], int(k))
                elif k >= open_[0]:
                    waiting.setdefault(call, {}).setdefault(int(k), row)
        before, out = {v[2] for v in calls.values() if v[2] >= 0}, []
        for call, at in last.items():
            open_, mine = calls[call], waiting.get(call, {})
            found = self._folded(open_, mine, False)
            if open_[0] == open_[1]:
                found += self.fold.finish(open_[3])
                del calls[call]
                waiting.pop(call, None)
            else:
                open_[2] = max(at, timerValues.getCurrentWatermarkInMs() + 1) + self.quiet
                if not mine:
                    waiting.pop(call, None)
            out += [(call, *r) for r in found]
        after = {v[2] for v in calls.values()}
        for timer in before - after:
            self.handle.deleteTimer(timer)
        for timer in after - before:
            self.handle.registerTimer(timer)
        self._stored(calls, waiting)
        yield from self._frames(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        calls, waiting = self._loaded()
        due, out = expiredTimerInfo.getExpiryTimeInMs(), []
        for call in [c for c, v in calls.items() if v[2] <= due]:
            open_ = calls.pop(call)
            out += [(call, *r) for r in self._folded(open_, waiting.pop(call, {}), True) + self.fold.finish(open_[3])]
        self._stored(calls, waiting)
        yield from self._frames(out)

    def close(self) -> None:
        pass


def in_order(rows: DataFrame, fold: Fold, columns: list[str], delay: str, quiet: float = 60.0) -> DataFrame:
    """Results of ``fold`` over the rows of every call in order of ``position``.

    ``rows``: call_id, position, at (event time: call start plus offset), closes, and ``columns`` as the fold takes them. ``delay`` has to cover
    the spread of arrival; ``quiet`` is how many seconds past the watermark a call without end marker may be silent."""
    picked = rows.select("call_id", F.col("position").cast("long").alias("position"), "at", F.coalesce("closes", F.lit(False)).alias("closes"), *columns)
    payload = T.StructType([picked.schema[c] for c in columns])
    out = T.StructType([picked.schema["call_id"], *T.StructType.fromDDL(fold.out).fields])
    processor = Buffered(fold, payload, T.StructType.fromDDL(fold.carry), picked.schema["call_id"].dataType, out.names, math.ceil(quiet * 1000 / PACE))
    bucket = F.pmod(F.xxhash64("call_id"), F.lit(BUCKETS)).cast("int")
    return clocked(picked.withColumn("bucket", bucket), "at", delay).groupBy("bucket").transformWithStateInPandas(processor, out, "append", "EventTime")


def with_end_markers(rows: DataFrame, position: str, at: str) -> DataFrame:
    """``rows`` with ``position``, ``at`` and ``closes``, and one end marker per call behind its last row."""
    rows = rows.withColumn("position", F.col(position).cast("long")).withColumn("at", F.col(at)).withColumn("closes", F.lit(False))
    ends = rows.groupBy("call_id").agg((F.max("position") + 1).alias("position"), F.max("at").alias("at")).withColumn("closes", F.lit(True))
    return rows.unionByName(ends, allowMissingColumns=True)


# --- folds ------------------------------------------------------------------------------------------------------

class Backlog(Fold):
    """max(0, backlog + processing - duration) after every chunk. Rows: chunk_idx, proc, dur."""

    carry = "waiting double"

    def __init__(self, kind: str) -> None:
        self.out = f"chunk_idx {kind}, backlog_sec double, drained boolean"

    def start(self) -> tuple:
        return (0.0,)

    def take(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        idx, proc, dur = row
        now = max(0.0, carry[0] + proc - dur)
        return (now,), [(idx, now, proc < dur)]


class Sections(Fold):
    """Section of every segment; it never goes back. Rows: idx, level."""

    carry = "level int"
    names = ("operator_intro", "prepared_remarks", "qa")

    def __init__(self, kind: str) -> None:
        self.out = f"idx {kind}, section string"

    def start(self) -> tuple:
        return (0,)

    def take(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        level = max(carry[0], int(row[1]))
        return (level,), [(row[0], self.names[level])]


class Utterances(Fold):
    """Words to utterances: a break at a long pause, at a short pause after a sentence end, or after so many words. Rows: word, start, end, prob,
    ends_sentence. Kept are the open utterance's words, so never more than ``most``."""

    carry = "session long, part long, start double, until double, sentence boolean, words array<string>, micros long"
    out = "session long, part long, start double, `end` double, words array<string>, confidence double, n_words long"

    def __init__(self, pause: float = 1.2, sentence_pause: float = 0.3, most: int = 25) -> None:
        self.pause, self.sentence_pause, self.most = pause, sentence_pause, most

    def start(self) -> tuple:
        return (0, 0, None, None, False, [], 0)

    def _row(self, carry: tuple) -> tuple:
        session, part, start, until, _, words, micros = carry
        return (session, part, start, until, list(words), micros / 1e6 / len(words), len(words))

    def take(self, carry: tuple, row: tuple) -> tuple[tuple, list[tuple]]:
        session, part, start, until, sentence, words, micros = carry
        word, begin, end, p, ends_sentence = row
        words = list(words)
        quiet = None if until is None else begin - until
        opens = quiet is None or quiet > self.pause or (sentence and quiet > self.sentence_pause)
        out = []
        if opens or len(words) == self.most:
            if words:
                out.append(self._row(carry))
            session, part = (session + 1, 0) if opens else (session, part + 1)
            start, words, micros = begin, [], 0
        # Times of one call may run back a little where speakers overlap.
        return (session, part, min(start, begin), end, bool(ends_sentence), [*words, word], micros + int(p * 1e6 + 0.5)), out

    def finish(self, carry: tuple) -> list[tuple]:
        return [self._row(carry)] if carry[5] else []


def backlog(chunks: DataFrame, delay: str) -> DataFrame:
    """chunks: call_id, position, at, closes, chunk_idx, proc_time_sec, duration_sec, in any order."""
    rows = chunks.withColumn("proc", F.col("proc_time_sec").cast("double")).withColumn("dur", F.col("duration_sec").cast("double"))
    return in_order(rows, Backlog(dict(chunks.dtypes)["chunk_idx"]), ["chunk_idx", "proc", "dur"], delay)


def sections(levels: DataFrame, delay: str) -> DataFrame:
    """levels: call_id, position, at, closes, idx, level (see ``segments.section_level``), in any order."""
    return in_order(levels, Sections(dict(levels.dtypes)["idx"]), ["idx", "level"], delay)


def utterances(words: DataFrame, delay: str, pause: float = 1.2, sentence_pause: float = 0.3, most: int = 25) -> DataFrame:
    """words: call_id, position, at, closes, word, start, end, prob, in any order."""
    rows = words.withColumn("ends_sentence", F.col("word").rlike(r"[.!?]\s*$"))
    found = in_order(rows, Utterances(pause, sentence_pause, most), ["word", "start", "end", "prob", "ends_sentence"], delay)
    return found.select("call_id", "session", "part", "start", "end", join_words(F.col("words")).alias("text"), "confidence", "n_words")
