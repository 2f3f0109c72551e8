"""Imports every query module so that ``REGISTRY`` is complete."""

from __future__ import annotations

from . import q_analytics, q_features, q_ml, q_quality, q_recommend  # noqa: F401
from .catalog import REGISTRY


def queries():
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql():
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql}
