"""Runs a registered query and its SQL side by side and compares whole results."""

from __future__ import annotations

import decimal
import math
import os
import sys
import threading
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "asDict"):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    return v


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, name, build, sql):
    t0 = time.time()
    df = build(spark, folder)
    got = as_rows(df.columns, df.collect())
    t1 = time.time()
    if sql is None:
        return True, f"{name}: rows-only {len(got)} rows {t1 - t0:.1f}s"
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = as_rows(cols, cur.fetchall())
    t2 = time.time()
    head = f"{name}: spark {len(got)} rows {t1 - t0:.1f}s, sql {len(want)} rows {t2 - t1:.1f}s"
    if sorted(cols) != sorted(df.columns):
        return False, f"{head} COLUMNS {sorted(df.columns)} vs {sorted(cols)}"
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w][:2]
        return False, f"{head} DIFF n={sum(g != w for g, w in zip(got, want))} {str(diff)[:1500]}"
    return True, head


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry

    from callweave.session import configure, local_session

    folder = sys.argv[1]
    only = sys.argv[2:]
    spark = configure(local_session())
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    sql = entry.oracle_sql()
    bad = 0
    for name, build in entry.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        watch = threading.Timer(float(os.environ.get("QUERY_SEC", "90")), spark.sparkContext.cancelAllJobs)
        watch.start()
        try:
            ok, line = compare(spark, con, folder, name, build, sql.get(name))
        except Exception as e:  # report and go on
            ok, line = False, f"{name}: ERROR {type(e).__name__} {str(e)[:1200]}"
        watch.cancel()
        bad += not ok
        print(("ok   " if ok else "FAIL ") + line, flush=True)
    print("bad", bad)
