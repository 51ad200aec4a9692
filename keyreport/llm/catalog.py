"""The subpackage's queries: importing an operator's module registers its query."""

from __future__ import annotations

from keyreport.llm import (  # noqa: F401
    decontaminate, fill_in_middle, language_id, license_scan, line_dedup, ngram_jaccard, packing, periodic_runs, sharding, substring_dedup, token_rollup, topk,
    url_filter,
)
from keyreport.llm.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
