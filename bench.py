"""Times the headline queries (after a warm-up; short ones by the median of three) and prints one JSON line, with the scans and exchanges of each plan."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from callweave.plans import catalog  # noqa: E402
from callweave.session import configure, local_session  # noqa: E402

HEADLINE = [
    "section_totals", "segment_gap_stats", "word_sessions", "boundary_ownership", "suffix_prefix_overlap", "max_overlap_join",
    "chunk_rollup", "rtf_summary", "upper_median_route", "keyed_upsert", "best_candidate", "capture_gate",
    "normalize_v2", "wer", "edit_ops", "document_wer", "entity_extract6", "entity_recall", "dictionary_counts",
    "fiscal_period", "call_datetime", "page_text", "discovery_registry", "align_opcodes", "dq_rules", "stream_crawl_monitor",
]
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def timed(build, spark, folder: str) -> tuple[float, str]:
    t = time.time()
    df = build(spark, folder)
    # The noop sink computes every row and column without moving them to the driver.
    df.write.format("noop").mode("overwrite").save()
    took = time.time() - t
    return took, df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = configure(local_session(os.environ.get("BENCH_CPUS", "8"), "callweave-bench"))
    spark.sparkContext.setLogLevel("ERROR")
    queries, times, plans = catalog.queries(), {}, {}
    timed(queries["table_counts"], spark, folder)
    for name in HEADLINE:
        runs = [timed(queries[name], spark, folder)]
        # Long queries are warm enough by themselves.
        runs += [timed(queries[name], spark, folder) for _ in range(REPEATS - 1 if runs[0][0] < 5 else 0)]
        times[name] = round(median(t for t, _ in runs), 3)
        plans[name] = {"scans": len(re.findall(r"\bFileScan\b", runs[-1][1])), "exchanges": len(re.findall(r"(?<!Reused)\bExchange\b|BroadcastExchange", runs[-1][1]))}
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(folder).removeprefix("sf"), "plans": plans}))


if __name__ == "__main__":
    main()
