"""Registered queries: each pairs a DataFrame job with the SQL that checks it."""

from __future__ import annotations

import importlib
import pkgutil


def load() -> tuple[dict, dict]:
    """Import every catalog module and return (queries, checking SQL)."""
    from bindscope.catalog import base

    for info in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{info.name}")
    return base.QUERIES, base.ORACLES
