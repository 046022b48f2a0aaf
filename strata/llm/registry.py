"""Queries and oracle SQL of the corpus operators."""

from __future__ import annotations

from strata.llm import (
    audit, cascade, chat, curriculum, decontaminate, hilbert, minhash, passages, ppm, secrets, spans, toxicity,
    whitening,
)

MODULES = [hilbert, spans, cascade, chat, secrets, decontaminate, minhash, toxicity, ppm, curriculum, passages, audit,
           whitening]

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
