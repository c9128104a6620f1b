"""Registered queries, grouped by area."""

from __future__ import annotations


def load():
    """(queries, SQL twins) of all areas."""
    from importlib import import_module

    from seriesloom.plans.registry import ORACLES, QUERIES

    for area in ("preparation", "snapshots", "evaluation", "library", "models"):
        import_module(f"seriesloom.plans.{area}")
    return dict(QUERIES), dict(ORACLES)
