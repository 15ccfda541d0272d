"""The queries of this package and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from . import byte_bpe, chat_formatting, decontamination, filter_audit, fingerprints, html_extraction, lexical_search, line_dedup, lm_scoring, packing, simhash_dedup, suffix_dedup, toxicity

MODULES = (line_dedup, fingerprints, html_extraction, simhash_dedup, decontamination, byte_bpe, suffix_dedup, lm_scoring, toxicity, chat_formatting, packing, filter_audit, lexical_search)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.ORACLE_SQL.items()}
