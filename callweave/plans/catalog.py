"""All registered queries and their SQL."""

from __future__ import annotations

from callweave.plans import auditing, findings, operations, scans, scoring, streams, transcripts

MODULES = [transcripts, operations, scoring, findings, auditing, streams, scans]


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
