"""Queries for features and the score (F1-F16) and scoring (Q1-Q5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellscore.operators import features as feat
from wellscore.operators.score_store import add_batch, scores
from wellscore.plans import ctes
from wellscore.plans import sqlspec as S
from wellscore.plans.registry import query
from wellscore.session import scratch_path
from wellscore.sources import fixtures as fx
from wellscore.spec import BAND_TEXTS, DEFAULT_SPEC, INDEX_TERMS, INTERACTIONS

SPEC = DEFAULT_SPEC


def _norm_sql() -> str:
    cols = []
    for name, lo, hi in SPEC.indicators:
        n = S.norm(name, hi, lo)
        cols.append(f"{f'({S.D(1.0)} - {n})' if name in SPEC.inverted else n} AS {name}_norm")
    return f"WITH {ctes.respondents()} SELECT respondent_id, {', '.join(cols)} FROM respondents"


@query("norm_scale", "F1 F2", _norm_sql)
def q_norm_scale(spark, sf):
    r = fx.respondents(spark, sf)
    return r.select("respondent_id", *[c.alias(n) for n, c in feat.norm_columns(SPEC).items()])


def _index_query(index: str, key: str, op: str):
    def sql() -> str:
        e = S.index_exprs(SPEC)[index]
        return f"WITH {ctes.respondents()} SELECT respondent_id, {e} AS {index} FROM respondents"

    @query(key, op, sql)
    def build(spark, sf):
        r = fx.respondents(spark, sf)
        return r.select("respondent_id", feat.index_columns(SPEC)[index].alias(index))

    return build


for _idx, _key, _op in [
    ("emotional_strain", "index_emotional", "F3"),
    ("physical_stress", "index_physical", "F4"),
    ("academic_pressure", "index_academic", "F5"),
    ("social_stress", "index_social", "F6"),
    ("recovery_index", "index_recovery", "F7"),
]:
    _index_query(_idx, _key, _op)


@query(
    "interactions",
    "F8 F9 F10 F11 F12",
    lambda: f"WITH {ctes.respondents()} SELECT respondent_id, {S.select_list(S.interaction_exprs())} FROM respondents",
)
def q_interactions(spark, sf):
    return fx.respondents(spark, sf).select("respondent_id", *[c.alias(n) for n, c in feat.interaction_columns().items()])


@query("raw_score", "F13", lambda: f"{ctes.with_engineered()} SELECT respondent_id, raw_score FROM rawt")
def q_raw_score(spark, sf):
    r = feat.add_raw_score(feat.add_indices(fx.respondents(spark, sf), SPEC), SPEC)
    return r.select("respondent_id", "raw_score")


@query("minmax_score", "F14", lambda: f"{ctes.with_engineered()} SELECT respondent_id, burnout_score FROM engineered")
def q_minmax_score(spark, sf):
    r = feat.add_raw_score(feat.add_indices(fx.respondents(spark, sf), SPEC), SPEC)
    return feat.minmax_score(r).select("respondent_id", "burnout_score")


@query("engineered", "F15", lambda: f"{ctes.with_engineered()} SELECT * FROM engineered")
def q_engineered(spark, sf):
    return feat.engineer(fx.respondents(spark, sf), SPEC)


@query(
    "score_by_label",
    "F16",
    lambda: f"""{ctes.with_engineered()}
SELECT l.stress_level, m.mean_score
FROM (VALUES (0), (1), (2)) l(stress_level)
LEFT JOIN (SELECT stress_level, {S.grid_mean('burnout_score', 100)} AS mean_score FROM engineered GROUP BY stress_level) m USING (stress_level)""",
)
def q_score_by_label(spark, sf):
    return feat.score_by_label(feat.engineer(fx.respondents(spark, sf), SPEC))


# --- scoring (Q1-Q5) ------------------------------------------------------------


def _score_feature_sql() -> str:
    ind = S.select_list(S.index_exprs(SPEC, "score"))
    inter = S.select_list(S.interaction_exprs("score"))
    return f"WITH {ctes.respondents()} SELECT respondent_id, {ind}, {inter} FROM respondents"


@query("score_features", "Q1", _score_feature_sql)
def q_score_features(spark, sf):
    out = feat.score_features(fx.respondents(spark, sf), SPEC)
    return out.select("respondent_id", *INDEX_TERMS, *INTERACTIONS)


def _formula_cte() -> str:
    """Scoring-mode features + raw score + whole-table range + clipped score + band."""
    ind = S.select_list(S.index_exprs(SPEC, "score"))
    inter = S.select_list(S.interaction_exprs("score"))
    clipped = S.rnd(f"least(greatest(({S.minmax_expr()}), {S.D(0.0)}), {S.D(100.0)})", 2)
    return f"""WITH {ctes.respondents()},
sf AS (SELECT *, {ind}, {inter} FROM respondents),
rawt AS (SELECT *, {S.raw_expr()} AS raw_score FROM sf),
rng AS (SELECT min(raw_score) AS mn, max(raw_score) AS mx FROM rawt),
scored AS (SELECT rawt.*, {clipped} AS burnout_score FROM rawt, rng),
banded AS (SELECT *, {S.band_expr('burnout_score')} AS risk_level FROM scored)"""


@query("clip_score", "Q3", lambda: f"{_formula_cte()} SELECT respondent_id, burnout_score FROM scored")
def q_clip_score(spark, sf):
    return feat.formula_score(fx.respondents(spark, sf), SPEC).select("respondent_id", "burnout_score")


@query("risk_band", "Q4", lambda: f"{_formula_cte()} SELECT respondent_id, burnout_score, risk_level FROM banded")
def q_risk_band(spark, sf):
    return feat.formula_score(fx.respondents(spark, sf), SPEC).select("respondent_id", "burnout_score", "risk_level")


def _scored_record_sql() -> str:
    adv = BAND_TEXTS
    advice = f"CASE WHEN risk_level = 'Low' THEN '{adv['Low']}' WHEN risk_level = 'Moderate' THEN '{adv['Moderate']}' ELSE '{adv['High']}' END"
    inputs = " || ',' || ".join(f"CAST({f} AS VARCHAR)" for f in SPEC.features)
    idx = ", ".join(SPEC.indices)
    return f"""{_formula_cte()}
SELECT respondent_id, burnout_score, risk_level, {advice} AS advice, {inputs} AS input_features, {idx} FROM banded"""


@query("scored_record", "Q5", _scored_record_sql)
def q_scored_record(spark, sf):
    rec = feat.scored_record(feat.formula_score(fx.respondents(spark, sf), SPEC), SPEC)
    # the nested input struct is flattened to text for the flat oracle compare
    flat = F.concat_ws(",", *[F.col(f"input_features.{f}").cast("string") for f in SPEC.features])
    return rec.withColumn("input_features", flat)


@query("minmax_incremental", "F14", lambda: f"{ctes.with_engineered()} SELECT respondent_id, burnout_score, respondent_id % 3 AS batch_id FROM engineered")
def q_minmax_incremental(spark, sf):
    """The score of all respondents in three batches, the second of them added twice."""
    path = scratch_path(spark, "score-store")
    r = fx.respondents(spark, sf)
    for b in (0, 1, 1, 2):
        add_batch(r.where(F.col("respondent_id") % 3 == b), path, b, SPEC)
    return scores(spark, path).withColumn("batch_id", F.col("batch_id").cast("long"))
