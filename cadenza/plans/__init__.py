"""Queries over the driver's tables, one for each operator, with their SQL."""

from __future__ import annotations

import importlib

_MODULES = ("segmentation", "profiles", "catalog", "learning", "compute")


def _load():
    for name in _MODULES:
        importlib.import_module(f"{__name__}.{name}")
    return importlib.import_module(f"{__name__}._registry")


def queries() -> dict:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().ORACLES)
