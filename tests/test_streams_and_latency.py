"""Streams against their batch twins; latency figures of a known call."""

from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as entry
from callweave.operators import latency as lat
from callweave.streaming import live

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_every_word_leaves_the_stream_once(spark):
    batch = rows(QUERIES["boundary_ownership"](spark, FOLDER), "call_id", "seq", "word", "chunk_idx")
    stream = rows(QUERIES["stream_own_words"](spark, FOLDER), "call_id", "seq", "word", "chunk_idx")
    assert stream == batch


def test_backlog_and_sections_equal_batch(spark):
    assert rows(QUERIES["stream_backlog"](spark, FOLDER), "call_id", "chunk_idx", "backlog_sec") == rows(
        QUERIES["chunk_backlog"](spark, FOLDER), "call_id", "chunk_idx", "backlog_sec")
    assert rows(QUERIES["stream_sections"](spark, FOLDER), "call_id", "idx", "section") == rows(
        QUERIES["section_labels"](spark, FOLDER), "call_id", "idx", "section")


def test_late_publications(spark):
    ended = spark.createDataFrame([(1, 1000), (2, 1000), (3, 1000), (9, 9000)], "call_id int, s long").select("call_id", F.timestamp_seconds("s").alias("ended_at"))
    published = spark.createDataFrame([(1, 1300), (2, 1301), (9, 9001)], "call_id int, s long").select("call_id", F.timestamp_seconds("s").alias("published_at"))
    got = live.drain(live.sla_alerts(live.replay(ended), live.replay(published), delay="1 minute")).collect()
    assert {r.call_id: r.late for r in got} == {1: False, 2: True, 3: True, 9: False}


def test_known_call_metrics(spark):
    d = lambda x: Decimal(str(x))
    row = spark.createDataFrame(
        [("c", d(177.144), d(1.89), d(8.0), d(3870.72), 68, True, d(218.261), d("0.029"))],
        "call_id string, asr_sec decimal(18,3), last_chunk_sec decimal(18,3), max_chunk_sec decimal(18,3), audio_sec decimal(18,3), chunk_count int, "
        "queue_drained boolean, diar_sec decimal(18,3), resolve_sec decimal(10,3)")
    got = lat.call_metrics(row).first()
    assert (got.asr_rtf, got.diar_rtf, got.total_rtf, got.post_call_latency_sec, got.sla_status) == (0.0458, 0.0564, 0.1022, 220.33, "PASS")
