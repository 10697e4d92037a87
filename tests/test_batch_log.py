"""Rows of the batch log add up to the stream's input."""

import time

from pyspark.sql import functions as F

from callweave.streaming import live, progress


def test_batches_add_up(spark):
    path = live.scratch(spark)
    log = progress.BatchLog(spark, f"{path}/log")
    spark.streams.addListener(log)
    try:
        rows = spark.range(1000).withColumn("v", F.col("id") % 10)
        live.drain(progress.watched(live.replay(rows, 4), "seen", total=F.sum("v"), odd=F.count_if(F.col("v") % 2 == 1)))
        for _ in range(50):
            found = progress.batches(spark, f"{path}/log").where("input_rows > 0").collect() if log else []
            if sum(r.input_rows for r in found) == 1000:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    assert len(found) == 4 and sum(r.input_rows for r in found) == 1000
    seen = [r.observed["seen"] for r in found]
    assert sum(int(s["n_rows"]) for s in seen) == 1000 and sum(int(s["total"]) for s in seen) == 4500 and sum(int(s["odd"]) for s in seen) == 500
