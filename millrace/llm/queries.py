"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from millrace.llm import chat, decontaminate, filter_audit, html_text, language_id, near_dup, nearest, packing, pieces, pii, sharding, toxicity, whitening

MODULES = [language_id, decontaminate, toxicity, sharding, pii, near_dup, html_text, chat, nearest, pieces, filter_audit, whitening, packing]


def queries() -> dict:
    return {name: f for m in MODULES for name, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in getattr(m, "ORACLE", {}).items()}
