"""Registered queries and, next to each, the SQL text that must give the same rows."""

from __future__ import annotations


def load():
    """Imports every module that registers queries and returns the registry."""
    from wattlake.registry import (base, detection, forecasting, ingest, live, medallion, profiles,  # noqa: F401
                                   storage, streams)
    return base
