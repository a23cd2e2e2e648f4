"""All registered queries of the engine and their SQL."""

from __future__ import annotations

from . import composites, datasets, documents, kits, pagegates, shapes, sheets, symbolplans, texts

MODULES = (datasets, texts, kits, sheets, documents, pagegates, composites, symbolplans, shapes)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}

#: Columns whose SQL type is wider than the engine's, by query.
_BIG, _INT = "BIGINT", "INTEGER"
TYPES = {
    "line_runs": {"pos": _INT},
    "limited_lines": {"chars": _BIG},
    "first_lines": {"chars": _BIG},
    "list_stem_runs": {"pos": _INT},
    "table_progressions": {"pos": _INT},
    "document_cells": {"table_no": _INT, "col": _INT, "filled": _BIG},
    "ragged_tables": {"table_no": _INT},
    "content_line_counts": {"chars": _BIG},
    "kit_token_sets": {'"left"': _BIG, '"right"': _BIG, "common": _BIG, "left_only": _BIG, "right_only": _BIG},
    "best_reference_pages": {"rank": _INT},
    "unsupported_facts": {"missing": _BIG},
    "page_kind_scores": {"tp": _BIG, "fp": _BIG, "fn": _BIG},
    "checked_pages": {"passed": _BIG},
    "symbol_types": {"confirmed": _BIG},
    "rebuilt_tables": {"table_no": _INT},
    "trimmed_tables": {"table_no": _INT},
}


def _typed(name: str, sql: str) -> str:
    casts = ", ".join(f"CAST({c} AS {t}) AS {c}" for c, t in TYPES.get(name, {}).items())
    return f"SELECT * REPLACE ({casts}) FROM ({sql})" if casts else sql


ORACLE = {name: _typed(name, sql) for module in MODULES for name, sql in module.ORACLE.items()}
