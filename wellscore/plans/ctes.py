"""Shared DuckDB CTEs for the oracle SQL (fixtures and the engineered table)."""

from __future__ import annotations

from wellscore.plans import sqlspec as S
from wellscore.sources.fixtures import answers_sql, dirty_sql, respondents_sql
from wellscore.spec import DEFAULT_SPEC


def respondents() -> str:
    return f"respondents AS ({respondents_sql('duckdb')})"


def dirty() -> str:
    return f"{respondents()}, dirty AS ({dirty_sql('respondents')})"


def answers() -> str:
    return f"answers AS ({answers_sql()})"


def engineered(source: str = "respondents") -> str:
    """CTEs ind -> rawt -> rng -> engineered over ``source``."""
    ind = S.select_list(S.index_exprs(DEFAULT_SPEC))
    inter = S.select_list(S.interaction_exprs())
    return f"""ind AS (SELECT *, {ind}, {inter} FROM {source}),
rawt AS (SELECT *, {S.raw_expr()} AS raw_score FROM ind),
rng AS (SELECT min(raw_score) AS mn, max(raw_score) AS mx FROM rawt),
engineered AS (SELECT rawt.* EXCLUDE (raw_score), {S.minmax_expr()} AS burnout_score FROM rawt, rng)"""


def with_engineered() -> str:
    return f"WITH {respondents()}, {engineered()}"


def banded() -> str:
    """`engineered` plus risk_level."""
    return f"{with_engineered()}, banded AS (SELECT *, {S.band_expr('burnout_score')} AS risk_level FROM engineered)"
