"""Queries for the cleaning chain (P1-P9) over `respondents_dirty`."""

from __future__ import annotations

from pyspark.sql import functions as F

from wellscore.operators import clean as cl
from wellscore.operators import features as feat
from wellscore.operators import report as rep
from wellscore.operators.categories import sparse_one_hot
from wellscore.plans import ctes
from wellscore.plans import sqlspec as S
from wellscore.plans.q_report import _corr_sql
from wellscore.plans.registry import query
from wellscore.plans.stored import stored
from wellscore.session import scratch_path
from wellscore.sources import fixtures as fx
from wellscore.spec import DEFAULT_SPEC, IQR_THRESHOLD

SPEC = DEFAULT_SPEC
KEY = ("respondent_id",)
NUM_COLS = [*SPEC.features, "stress_level"]
# Categories of `cohort` in the test tables (oracle side only).
COHORTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def messy_name(c: str) -> str:
    return f"  {c.replace('_', ' ').title()} "


def _imputed(spark, sf):
    return cl.impute(fx.respondents_dirty(spark, sf), key_cols=KEY)


def _deduped(spark, sf):
    """Written once per session: the all-column shuffle isn't repeated by the quartile pass."""
    return stored(spark, "deduped", sf, lambda: cl.dedupe(_imputed(spark, sf)), SPEC)


def _clip_cols(df):
    return cl.numeric_columns(df, exclude=KEY)


# --- oracle CTE chain ---------------------------------------------------------------

MEDIAN = "(SELECT quantile_cont(anxiety_level, 0.5) FROM dirty)"
MODE = "(SELECT cohort FROM dirty WHERE cohort IS NOT NULL GROUP BY cohort ORDER BY count(*) DESC, cohort LIMIT 1)"


def _chain(upto: str) -> str:
    parts = [ctes.dirty()]
    parts.append(
        f"imputed AS (SELECT * REPLACE (coalesce(CAST(anxiety_level AS DOUBLE), {MEDIAN}) AS anxiety_level, coalesce(cohort, {MODE}) AS cohort) FROM dirty)"
    )
    if upto == "imputed":
        return "WITH " + ", ".join(parts)
    parts.append("deduped AS (SELECT DISTINCT * FROM imputed)")
    qs = ", ".join(
        f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}__q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}__q3" for c in NUM_COLS
    )
    parts.append(f"q AS (SELECT {qs} FROM deduped)")
    t = S.D(IQR_THRESHOLD)
    bs = ", ".join(f"{c}__q1 - {t} * ({c}__q3 - {c}__q1) AS {c}__lo, {c}__q3 + {t} * ({c}__q3 - {c}__q1) AS {c}__hi" for c in NUM_COLS)
    parts.append(f"b AS (SELECT {bs} FROM q)")
    clipped = ", ".join(
        f"CASE WHEN CAST({c} AS DOUBLE) < {c}__lo THEN {c}__lo WHEN CAST({c} AS DOUBLE) > {c}__hi THEN {c}__hi ELSE CAST({c} AS DOUBLE) END AS {c}"
        for c in NUM_COLS
    )
    parts.append(f"clipped AS (SELECT respondent_id, {clipped}, cohort FROM deduped, b)")
    dummies = ", ".join(f"coalesce(cohort = '{v}', false) AS \"cohort_{v}\"" for v in COHORTS[1:])
    parts.append(f"cleaned AS (SELECT respondent_id, {', '.join(NUM_COLS)}, {dummies} FROM clipped)")
    return "WITH " + ", ".join(parts)


# --- queries --------------------------------------------------------------------------


@query("standardize_names", "P1", lambda: f"WITH {ctes.dirty()} SELECT * FROM dirty")
def q_standardize_names(spark, sf):
    d = fx.respondents_dirty(spark, sf)
    messy = d.toDF(*[messy_name(c) for c in d.columns])
    return cl.standardize_names(messy)


@query(
    "impute_median",
    "P2",
    lambda: f"WITH {ctes.dirty()} SELECT * REPLACE (coalesce(CAST(anxiety_level AS DOUBLE), {MEDIAN}) AS anxiety_level) FROM dirty",
)
def q_impute_median(spark, sf):
    return cl.impute(fx.respondents_dirty(spark, sf), numeric=True, other=False, key_cols=KEY)


@query("impute_mode", "P3", lambda: f"WITH {ctes.dirty()} SELECT * REPLACE (coalesce(cohort, {MODE}) AS cohort) FROM dirty")
def q_impute_mode(spark, sf):
    return cl.impute(fx.respondents_dirty(spark, sf), numeric=False, other=True, key_cols=KEY)


@query("dedupe_rows", "P4", lambda: f"{_chain('full')} SELECT * FROM deduped")
def q_dedupe_rows(spark, sf):
    return _deduped(spark, sf)


def _bounds_sql() -> str:
    parts = [
        f"SELECT '{c}' AS column_name, {c}__q1 AS q1, {c}__q3 AS q3, {c}__lo AS lower, {c}__hi AS upper FROM q, b" for c in NUM_COLS
    ]
    return f"{_chain('full')} " + " UNION ALL ".join(parts)


@query("iqr_bounds", "P5", _bounds_sql)
def q_iqr_bounds(spark, sf):
    d = _deduped(spark, sf)
    return cl.iqr_bounds(d, _clip_cols(d), IQR_THRESHOLD)


@query("iqr_clip", "P6", lambda: f"{_chain('full')} SELECT * FROM clipped")
def q_iqr_clip(spark, sf):
    d = _deduped(spark, sf)
    return cl.iqr_clip(d, _clip_cols(d), IQR_THRESHOLD)


def _outliers_sql() -> str:
    cnt = lambda c: f"count(*) FILTER (WHERE CAST({c} AS DOUBLE) < {c}__lo OR CAST({c} AS DOUBLE) > {c}__hi)"
    parts = [f"SELECT '{c}' AS column_name, CAST({cnt(c)} AS BIGINT) AS n_clipped FROM deduped, b" for c in NUM_COLS]
    total = " + ".join(cnt(c) for c in NUM_COLS)
    parts.append(f"SELECT '__total__', CAST({total} AS BIGINT) FROM deduped, b")
    return f"{_chain('full')} " + " UNION ALL ".join(parts)


@query("outlier_counts", "P7", _outliers_sql)
def q_outlier_counts(spark, sf):
    d = _deduped(spark, sf)
    return cl.outlier_counts(d, _clip_cols(d), IQR_THRESHOLD)


def _one_hot_sql() -> str:
    dummies = ", ".join(f"coalesce(cohort = '{v}', false) AS \"cohort_{v}\"" for v in COHORTS[1:])
    return f"{_chain('full')} SELECT * EXCLUDE (cohort), {dummies} FROM deduped"


@query("one_hot", "P8", _one_hot_sql)
def q_one_hot(spark, sf):
    return cl.one_hot(_deduped(spark, sf), ["cohort"])


def _materialize(spark, sf, name):
    def write(df):
        path = scratch_path(spark, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    return write


@query("clean_pipeline", "P9", lambda: f"{_chain('full')} SELECT * FROM cleaned")
def q_clean_pipeline(spark, sf):
    return cl.clean(fx.respondents_dirty(spark, sf), "iqr", IQR_THRESHOLD, key_cols=KEY, materialize=_materialize(spark, sf, "deduped"))


def _clean_corr_sql() -> str:
    return _corr_sql(f"{_chain('full')}, {ctes.engineered('cleaned')}", "engineered")


@query("correlation_clean", "R4 R5 P9 F15", _clean_corr_sql)
def q_correlation_clean(spark, sf):
    """The original stage order: clean -> engineer -> correlation (has a constant column)."""
    def build():
        cleaned = cl.clean(fx.respondents_dirty(spark, sf), "iqr", IQR_THRESHOLD, key_cols=KEY, materialize=_materialize(spark, sf, "deduped"))
        return feat.engineer(cleaned, SPEC)

    return rep.correlation_pairs(stored(spark, "engineered_clean", sf, build, SPEC))


def _sparse_sql() -> str:
    return f"""WITH {ctes.dirty()}, d AS (SELECT DISTINCT respondent_id, 'r' || respondent_id AS person, cohort FROM dirty),
l AS (SELECT respondent_id, 'person' AS c, person AS v FROM d UNION ALL SELECT respondent_id, 'cohort', cohort FROM d),
u AS (SELECT DISTINCT c, v FROM l WHERE v IS NOT NULL),
n AS (SELECT c, v, row_number() OVER (ORDER BY c, v) - 1 AS idx FROM u WHERE v > (SELECT min(v) FROM u u2 WHERE u2.c = u.c))
SELECT respondent_id, (SELECT count(*) FROM n) AS size, coalesce(string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx), '') AS indices FROM l LEFT JOIN n USING (c, v) GROUP BY respondent_id"""


@query("one_hot_sparse", "P8", _sparse_sql)
def q_one_hot_sparse(spark, sf):
    """A category per respondent and the cohort, which is null for some, as sparse one-hot rows."""
    d = fx.respondents_dirty(spark, sf).select("respondent_id", F.concat(F.lit("r"), "respondent_id").alias("person"), "cohort").distinct()
    out = sparse_one_hot(d, "respondent_id", ["person", "cohort"])
    return out.withColumn("indices", F.array_join("indices", ","))
