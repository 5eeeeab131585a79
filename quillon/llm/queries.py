"""Queries of the problems on text and their SQL oracles."""

from __future__ import annotations

from importlib import import_module

_MODULES = ["quillon.llm.q_lookalike", "quillon.llm.q_mapping", "quillon.llm.q_pages", "quillon.llm.q_splitting", "quillon.llm.q_packing", "quillon.llm.q_mixing", "quillon.llm.q_subjects"]
QUERIES: dict = {}
SQL: dict = {}
for _m in _MODULES:
    _part = import_module(_m)
    QUERIES |= _part.QUERIES
    SQL |= _part.SQL
