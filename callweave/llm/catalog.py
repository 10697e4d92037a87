"""Queries and SQL of the training-data operators."""

from __future__ import annotations

from callweave.llm import alignment, bpe, chat, clustering, jaccard, lines, media, mixing, pii, pitmanyor, quality, spotsigs, tokenfiles

MODULES = [pii, pitmanyor, lines, media, bpe, quality, jaccard, mixing, spotsigs, chat, alignment, clustering, tokenfiles]


def queries() -> dict:
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
