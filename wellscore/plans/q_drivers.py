"""Queries for stress drivers and text columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellscore.operators import drivers as drv
from wellscore.operators import features as feat
from wellscore.plans import ctes
from wellscore.plans import sqlspec as S
from wellscore.plans.q_report import _engineered
from wellscore.plans.registry import query
from wellscore.sources import fixtures as fx
from wellscore.spec import BAND_TEXTS, DEFAULT_SPEC, FEATURE_LABELS

SPEC = DEFAULT_SPEC
FOLLOWUP_QUESTION = "How can I keep my sleep steady during exam weeks?"
NL = "chr(10)"


def _label_sql(f: str) -> str:
    return FEATURE_LABELS.get(f, f.replace("_", " ").title())


def _contrib_sql(source: str = "engineered") -> str:
    parts = []
    for pos, (f, lo, hi) in enumerate(SPEC.indicators):
        n = S.clip(f"((CAST({f} AS DOUBLE) - {S.D(lo)}) / {S.D(hi - lo)})", S.D(0.0), S.D(1.0))
        inv = f in SPEC.inverted
        c = f"({S.D(1.0)} - {n})" if inv else n
        parts.append(
            f"SELECT respondent_id, {pos} AS pos, '{f}' AS name, '{_label_sql(f)}' AS label, CAST({f} AS DOUBLE) AS raw_value, "
            f"{S.rnd(c, 3)} AS stress_contribution, '{'low' if inv else 'high'}' AS direction FROM {source}"
        )
    return " UNION ALL ".join(parts)


def _top_cte(n: int = 3) -> str:
    return f"""{ctes.banded()},
contrib AS ({_contrib_sql('banded')}),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY respondent_id ORDER BY stress_contribution DESC, pos ASC) AS INTEGER) AS rank FROM contrib),
top AS (SELECT * FROM ranked WHERE rank <= {n})"""


def _line_sql() -> str:
    direction = "CASE WHEN direction = 'low' THEN 'too low' ELSE 'elevated' END"
    pct = f"CAST(CAST(round_even(stress_contribution * {S.D(100.0)}, 0) AS BIGINT) AS VARCHAR)"
    return (
        f"'  ' || CAST(rank AS VARCHAR) || '. ' || label || ' = ' || CAST(CAST(raw_value AS BIGINT) AS VARCHAR) || ' (' || {direction}"
        f" || ', stress contribution: ' || {pct} || '%)'"
    )


def _drivers_text_cte() -> str:
    return f"""{_top_cte()},
dtext AS (SELECT respondent_id, string_agg({_line_sql()}, {NL} ORDER BY rank) AS driver_text,
                 string_agg(label, ', ' ORDER BY rank) AS names FROM top GROUP BY respondent_id)"""


@query("contributions_long", "D1 D3", lambda: f"{ctes.with_engineered()} {_contrib_sql()}")
def q_contributions_long(spark, sf):
    return drv.contributions_long(_engineered(spark, sf), spec=SPEC)


@query(
    "top_drivers",
    "D2 D3",
    lambda: f"{_top_cte()} SELECT respondent_id, rank, pos, name, label, raw_value, stress_contribution, direction FROM top",
)
def q_top_drivers(spark, sf):
    return drv.top_drivers_long(_engineered(spark, sf), spec=SPEC)


def _feature_labels_sql() -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in FEATURE_LABELS.items())
    default = "array_to_string(list_transform(string_split(replace(feature, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    return f"""WITH {ctes.answers()}
SELECT feature, coalesce(CASE feature {cases} END, {default}) AS label FROM (SELECT DISTINCT feature FROM answers)"""


@query("feature_labels", "D4", _feature_labels_sql)
def q_feature_labels(spark, sf):
    a = fx.answers(spark, sf).select("feature").distinct()
    return a.select("feature", drv.feature_label(F.col("feature")).alias("label"))


@query("driver_text", "D5", lambda: f"{_drivers_text_cte()} SELECT respondent_id, driver_text FROM dtext")
def q_driver_text(spark, sf):
    e = _engineered(spark, sf)
    top = drv.top_drivers(drv.contributions(e, spec=SPEC), SPEC.top_drivers)
    return e.select("respondent_id", drv.driver_text(top).alias("driver_text"))


def _profile_sql() -> str:
    lines = f" || {NL} || ".join(f"'  - {_label_sql(f)}: ' || CAST({f} AS VARCHAR)" for f in SPEC.features)
    return f"WITH {ctes.respondents()} SELECT respondent_id, {lines} AS profile_text FROM respondents"


@query("profile_text", "D6", _profile_sql)
def q_profile_text(spark, sf):
    r = fx.respondents(spark, sf)
    return r.select("respondent_id", drv.profile_text(SPEC.features).alias("profile_text"))


def _tip_sql() -> str:
    t = BAND_TEXTS
    return f"CASE WHEN risk_level = 'Low' THEN '{t['Low']}' WHEN risk_level = 'High' THEN '{t['High']}' ELSE '{t['Moderate']}' END"


def _advice_sql() -> str:
    return f"""{_drivers_text_cte()}
SELECT b.respondent_id, 'Band ' || b.risk_level || ', score ' || CAST(b.burnout_score AS VARCHAR) || ' of 100' || {NL} || 'Drivers: ' || coalesce(d.names, 'none') || {NL} || {_tip_sql()} AS advice
FROM banded b LEFT JOIN dtext d USING (respondent_id)"""


def _banded(spark, sf):
    e = _engineered(spark, sf)
    return e.withColumn("risk_level", feat.risk_band(F.col("burnout_score")))


@query("static_advice", "D7", _advice_sql)
def q_static_advice(spark, sf):
    b = _banded(spark, sf)
    top = drv.top_drivers(drv.contributions(b, spec=SPEC), SPEC.top_drivers)
    return b.select("respondent_id", drv.static_advice(F.col("burnout_score"), F.col("risk_level"), top).alias("advice"))


def _request_sql() -> str:
    profile = f" || {NL} || ".join(f"'  - {_label_sql(f)}: ' || CAST({f} AS VARCHAR)" for f in SPEC.features)
    idx = " || ".join(
        f"{NL} || '- {name}: ' || printf('%.2f', {S.rnd(f'coalesce({name}, {S.D(0.5)})', 2)}) || '/1.0'" for name in SPEC.indices
    )
    return f"""{_drivers_text_cte()}
SELECT b.respondent_id, 'Assessment' || {NL} || '- Score: ' || CAST(b.burnout_score AS VARCHAR) || '/100' || {NL} || '- Risk: ' || b.risk_level
       || {NL} || {NL} || 'Profile' || {NL} || {profile} || {NL} || {NL} || 'Top drivers' || {NL} || d.driver_text || {NL} || {NL} || 'Indices' || {idx} AS request
FROM banded b JOIN dtext d USING (respondent_id)"""


@query("request_text", "D8", _request_sql)
def q_request_text(spark, sf):
    b = _banded(spark, sf)
    top = drv.top_drivers(drv.contributions(b, spec=SPEC), SPEC.top_drivers)
    txt = drv.request_text(
        F.col("burnout_score"), F.col("risk_level"), drv.profile_text(SPEC.features), drv.driver_text(top), {i: F.col(i) for i in SPEC.indices}
    )
    return b.select("respondent_id", txt.alias("request"))


@query(
    "followup_text",
    "D9",
    lambda: f"""{ctes.banded()}
SELECT respondent_id, 'Follow-up question:' || {NL} || {NL} || '{FOLLOWUP_QUESTION}' || {NL} || {NL} || 'Context: score ' || CAST(burnout_score AS VARCHAR)
       || '/100 (' || risk_level || ' risk). Answer briefly and concretely.' AS followup FROM banded""",
)
def q_followup_text(spark, sf):
    b = _banded(spark, sf)
    return b.select("respondent_id", drv.followup_text(F.lit(FOLLOWUP_QUESTION), F.col("burnout_score"), F.col("risk_level")).alias("followup"))


@query(
    "cohort_drivers",
    "D10",
    lambda: f"""{_top_cte()}
SELECT b.cohort, t.name AS feature, count(*) AS n_top, {S.grid_mean('t.stress_contribution', 1000)} AS mean_contribution
FROM top t JOIN banded b USING (respondent_id) GROUP BY b.cohort, t.name""",
)
def q_cohort_drivers(spark, sf):
    return drv.cohort_drivers(_engineered(spark, sf), "cohort", SPEC.top_drivers, SPEC)
