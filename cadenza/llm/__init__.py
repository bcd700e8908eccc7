"""Operators for training-data pipelines. Each module registers its queries and, where SQL can express them, their SQL."""

from __future__ import annotations

import importlib

MODULES = ("near_dedup", "token_records", "quality_rules", "language_id", "byte_bpe", "url_filter", "context_mixing", "collision_search", "length_packing", "transcripts")


def _gathered(what: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found |= getattr(importlib.import_module(f"{__name__}.{name}"), what)
    return found


def queries() -> dict:
    return _gathered("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gathered("ORACLES")
