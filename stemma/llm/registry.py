"""All queries of this folder with their SQL."""

from __future__ import annotations

from importlib import import_module

_MODULES = ("queries_tokens", "queries_duplicates", "queries_fingerprints", "queries_classifiers", "queries_licenses", "queries_conversations", "queries_collocations", "queries_archives")
QUERIES: dict = {}
ORACLES: dict[str, str] = {}
for _name in _MODULES:
    _module = import_module(f"stemma.llm.{_name}")
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES
