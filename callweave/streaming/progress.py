"""One row for every micro-batch of the streams: what it read and took, and the metrics that the stream observes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "run_id string, batch_id long, name string, started_at string, input_rows long, batch_ms long, watermark string, state_rows long, observed map<string,map<string,string>>"


class BatchLog(StreamingQueryListener):
    """Writes a file per batch into ``path``; a batch that runs again replaces its file. Register it with ``spark.streams.addListener``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {
            "run_id": str(p.runId), "batch_id": p.batchId, "name": p.name, "started_at": p.timestamp, "input_rows": p.numInputRows, "batch_ms": p.batchDuration,
            "watermark": p.eventTime.get("watermark"), "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "observed": {k: {n: str(v) for n, v in r.asDict().items()} for k, r in (p.observedMetrics or {}).items()},
        }
        jvm = self.spark._jvm
        where = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{p.runId}-{p.batchId:012d}.json")
        stream = where.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).create(where, True)
        stream.write(bytearray((json.dumps(row) + "\n").encode()))
        stream.close()


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The rows written so far."""
    return spark.read.schema(SCHEMA).json(path)


def watched(stream: DataFrame, name: str, **metrics) -> DataFrame:
    """``stream`` that reports ``metrics`` (aggregates) of every batch under ``name``, besides its number of rows."""
    return stream.observe(name, F.count(F.lit(1)).alias("n_rows"), *[m.alias(k) for k, m in metrics.items()])
