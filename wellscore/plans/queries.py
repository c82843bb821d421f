"""Import every query module so the registry is complete."""

from __future__ import annotations

from wellscore.plans import q_clean, q_drivers, q_features, q_models, q_report, q_stream, q_survey  # noqa: F401
from wellscore.plans.registry import REGISTRY


def queries():
    return {name: e.build for name, e in REGISTRY.items()}


def oracle_sql():
    return {name: e.sql for name, e in REGISTRY.items() if e.sql is not None}
