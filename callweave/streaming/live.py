"""Structured Streaming forms of the call operators.

Cues and thresholds are evaluated as column expressions before the stateful step, so the per-call state functions only
carry a few numbers and the words still in doubt.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from callweave.functions import fixed_values as fv
from callweave.operators import relational as rel, words as wd
from callweave.sources.keyed_table import KeyedTable
from callweave.session import STATE_STORE, shared_folder


#: Buckets of calls that share a state row; the number must stay for a stream's lifetime.
BUCKETS = 1024


# --- plumbing ---------------------------------------------------------------------------------------------------

def scratch(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/streams/{uuid.uuid4().hex}"


def replay(rows: DataFrame, files: int | None = None, last: DataFrame | None = None) -> DataFrame:
    """A batch table written to the shared folder and read again as a stream; with ``files``, dealt at random to as many files, one a
    micro-batch. ``last`` rows come in a file after all others."""
    spark, path = rows.sparkSession, scratch(rows.sparkSession) + "/in"
    (rows if files is None else rows.orderBy(F.rand(files)).repartition(files)).write.parquet(path)
    if last is not None:
        last.select(rows.columns).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(rows.schema)
    return (reader if files is None else reader.option("maxFilesPerTrigger", "1")).parquet(path)


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STATE_STORE)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def drain(stream: DataFrame) -> DataFrame:
    """Runs an append stream over everything available and returns what it wrote."""
    spark, path = stream.sparkSession, scratch(stream.sparkSession)
    with state_on_disk(spark):
        query = (
            stream.writeStream.format("parquet").outputMode("append").option("path", f"{path}/out")
            .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def drain_updates(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Runs an update stream and returns the last state of every key.  Batches are stored under their number, so a batch
    written twice after a failure replaces itself."""
    spark, path = stream.sparkSession, scratch(stream.sparkSession)

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch_no={number}")

    query = (
        stream.writeStream.outputMode("update").option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True).foreachBatch(store).start())
    query.awaitTermination()
    rows = spark.read.parquet(f"{path}/out")
    return rel.pick_per_key(rows, keys, F.col("batch_no"), lowest=False).drop("batch_no")


# --- windows ----------------------------------------------------------------------------------------------------

def chunk_windows(words: DataFrame, delay: str, width: int = 60, step: int = 57) -> DataFrame:
    """Words per call in 60 s windows every 57 s from the call's start.

    words: call_id, start (seconds since the call's start), call_at (when the call started). Windows are told apart by their number, their state
    goes when the watermark passes their end by the clock, so calls of any time of day share one stream; ``delay`` has to cover the arrival's spread."""
    first = F.floor(F.col("start") / step)
    ks = F.filter(F.sequence(first - F.lit(width // step), first), lambda k: F.col("start") < k * step + width)
    each = words.withColumn("k", F.explode(ks))
    each = each.withColumn("ends_at", F.timestamp_seconds(F.unix_seconds("call_at") + F.col("k") * step + width))
    return each.withWatermark("ends_at", delay).groupBy("call_id", "ends_at", "k").agg(F.count(F.lit(1)).alias("n_words")).select(
        "call_id", (F.col("k") * step).alias("window_sec"), "n_words")


def pause_sessions(words: DataFrame, delay: str, pause: str = "1200 milliseconds") -> DataFrame:
    """Utterances split by pauses alone. words: call_id, at (event time), call_at; times are given from the call's start."""
    def since(t: Column) -> Column:
        return F.unix_millis(t) - F.unix_millis("call_at")

    return words.withWatermark("at", delay).groupBy("call_id", "call_at", F.session_window("at", pause)).agg(
        F.count(F.lit(1)).alias("n_words")
    ).select("call_id", since(F.col("session_window.start")).alias("from_ms"), since(F.col("session_window.end")).alias("to_ms"), "n_words")


def crawl_monitor(log: DataFrame, width: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """Requests and time spent per window, source and status."""
    return log.withWatermark("requested_at", delay).groupBy(F.window("requested_at", width), "source", "http_status").agg(
        F.count(F.lit(1)).alias("n"), F.sum("duration_ms").alias("total_ms")
    ).select(F.col("window.start").alias("window_start"), "source", "http_status", "n", "total_ms")


# --- stateful operators -----------------------------------------------------------------------------------------

def own_words_live(words: DataFrame, delay: str, step: float = fv.CHUNK_SEC - fv.CHUNK_OVERLAP_SEC, margin: float = fv.BOUNDARY_SEC, quiet: float = 60.0) -> DataFrame:
    """Every word once although chunks overlap and files may come twice, in any order.  A chunk's words before the next boundary leave at once; its
    last ones wait until a later chunk shows up (then they belong to that) or the chunk is known to be the last: by the call's end marker, or by a
    timer once the call has been quiet past the watermark.

    words: call_id, chunk_idx, seq, word, start, at, closes; an end marker has the last chunk's number and, as seq, the rows of the call."""
    late = F.col("start") >= (F.col("chunk_idx") + 1) * step + margin
    mine = (F.col("chunk_idx") == 0) | (F.col("start") >= F.col("chunk_idx") * step + margin)
    flags = words.withColumn("_tail", F.coalesce(late, F.lit(False))).withColumn("_mine", F.coalesce(mine, F.lit(False)))
    # A bucket is the calls of one hash: state and frames cost the same for one call as for hundreds. Calls without id have one of their own.
    bucket = F.when(F.col("call_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("call_id"), F.lit(BUCKETS)).cast("int"))
    rows = flags.withWatermark("at", delay).dropDuplicatesWithinWatermark(["call_id", "chunk_idx", "start", "word", "closes"]).withColumn("_bucket", bucket)
    kind = dict(words.dtypes)
    columns = ["call_id", "chunk_idx", "seq", "word", "start"]
    schema = f"call_id {kind['call_id']}, chunk_idx {kind['chunk_idx']}, seq {kind['seq']}, word string, start double"

    def hold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        """calls: last chunk seen, rows seen, rows told by the marker, timer; held: a call's words in doubt."""
        kept, words_ = state.get if state.exists else ([], [])
        calls, held, out, now = {c[0]: list(c[1:]) for c in kept}, {}, [], state.getCurrentWatermarkMs()
        for h in words_:
            held.setdefault(h[0], []).append(tuple(h))
        met: dict = {}
        for batch in () if state.hasTimedOut else batches:
            if not len(batch):
                continue
            batch = batch.assign(_at=batch["at"].astype("datetime64[ms]").astype("int64"), _total=batch["seq"].where(batch["closes"]), _word=~batch["closes"])
            each = batch.groupby("call_id", sort=False, dropna=False).agg(top=("chunk_idx", "max"), seen=("_word", "sum"), total=("_total", "max"), last=("_at", "max"))
            for call, top, seen, total, last in zip(each.index.tolist(), *(each[c].tolist() for c in each.columns)):
                call = None if pd.isna(call) else call
                own = calls.setdefault(call, [-1, 0, -1, 0])
                own[0], own[1] = max(own[0], int(top)), own[1] + int(seen)
                own[2] = own[2] if pd.isna(total) else max(own[2], int(total))
                met[call] = max(met.get(call, 0), int(last))
            own = batch.loc[batch["_mine"] & batch["_word"]]
            sure = own.loc[~own["_tail"], columns]
            if len(sure):
                yield sure
            for row in own.loc[own["_tail"], columns].astype(object).values.tolist():
                row[0] = None if pd.isna(row[0]) else row[0]
                held.setdefault(row[0], []).append(tuple(row))
        for call in [c for c in calls if c in met or calls[c][3] <= now]:
            own, mine = calls[call], held.pop(call, [])
            if call not in met:
                # Quiet past the watermark: what it holds is its last chunk's.
                out += mine
                del calls[call]
                continue
            mine = [h for h in mine if h[1] >= own[0]]
            if own[2] >= 0:
                # The last chunk is known: what is held is its own.
                out, mine = out + mine, []
            if own[1] == own[2]:
                del calls[call]
                continue
            own[3] = max(met[call], now + 1) + int(quiet * 1000)
            if mine:
                held[call] = mine
        if calls:
            state.update(([(c, *v) for c, v in calls.items()], [h for mine in held.values() for h in mine]))
            state.setTimeoutTimestamp(max(now + 1, min(v[3] for v in calls.values())))
        elif state.exists:
            state.remove()
        if out:
            yield pd.DataFrame(out, columns=columns)

    call, row = f"call_id:{kind['call_id']}", f"chunk_idx:{kind['chunk_idx']},seq:{kind['seq']},word:string,start:double"
    return rows.groupBy("_bucket").applyInPandasWithState(
        hold, schema, f"calls array<struct<{call},top:int,seen:long,total:long,timer:long>>, held array<struct<{call},{row}>>",
        "append", GroupStateTimeout.EventTimeTimeout)


# --- sinks and joins --------------------------------------------------------------------------------------------

def split_hallucinations(raw: DataFrame, kept_path: str, dropped_path: str, checkpoint: str):
    """Starts a query that sends every raw segment to the kept or the dropped table with its rule."""
    rule = wd.hallucination_rule(F.col("text"), F.col("avg_logprob"), F.col("no_speech_prob"))

    def route(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        batch.where(F.col("rule").isNull()).drop("rule").write.mode("overwrite").parquet(f"{kept_path}/batch_no={number}")
        batch.where(F.col("rule").isNotNull()).write.mode("overwrite").parquet(f"{dropped_path}/batch_no={number}")
        batch.unpersist()

    return raw.withColumn("rule", rule).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(route).start()


def upsert_stream(changes: DataFrame, into: KeyedTable, checkpoint: str):
    """Starts a query that commits every batch's newest row per key to a keyed table; a batch that runs again is committed once."""
    return changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(into.commit).start()


def late_corrections(words: DataFrame, at: str, delay: float, into: KeyedTable, late_path: str, checkpoint: str):
    """Starts a query that merges words into a keyed table and keeps rows that come past the watermark: those more than ``delay`` seconds behind
    the newest row of all batches before go to ``late_path`` as well, one folder a batch, and win over what was heard in time.

    The newest time before a batch is read from the marks that earlier batches left, so a batch that runs again splits its rows alike."""
    spark, marks = words.sparkSession, f"{late_path}-marks"

    def store(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        newest = batch.agg(F.max(at).alias("newest"))
        newest.write.mode("overwrite").parquet(f"{marks}/batch_no={number}")
        before = spark.read.parquet(marks).where(F.col("batch_no") < number).agg(F.max("newest")).first()[0]
        late = F.lit(False) if before is None else F.coalesce(F.col(at) < F.lit(before) - F.expr(f"interval {delay} seconds"), F.lit(False))
        rows = batch.withColumn("pass_no", late.cast("int"))
        rows.where("pass_no = 1").drop("pass_no").write.mode("overwrite").parquet(f"{late_path}/batch_no={number}")
        into.commit(rows, number)
        batch.unpersist()

    return words.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(store).start()


def sla_alerts(ended: DataFrame, published: DataFrame, seconds: int = 300, delay: str = "10 minutes") -> DataFrame:
    """Calls without a publication within ``seconds`` of their end.  ended: call_id, ended_at; published: call_id, published_at."""
    left = ended.withWatermark("ended_at", delay)
    right = published.select(F.col("call_id").alias("_c"), "published_at").withWatermark("published_at", delay)
    on = (F.col("call_id") == F.col("_c")) & (F.col("published_at") >= F.col("ended_at")) & (
        F.col("published_at") <= F.col("ended_at") + F.expr(f"interval {seconds} seconds"))
    return left.join(right, on, "left_outer").select("call_id", "ended_at", "published_at", F.col("published_at").isNull().alias("late"))
