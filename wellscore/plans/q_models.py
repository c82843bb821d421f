"""Queries for models (M1-M15) and sources/sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellscore.operators import features as feat
from wellscore.operators import models as md
from wellscore.operators.predict import predict
from wellscore.plans import ctes
from wellscore.plans import sqlspec as S
from wellscore.plans.linear_sql import linear_ctes, prediction
from wellscore.plans.q_drivers import _contrib_sql
from wellscore.plans.q_report import _engineered
from wellscore.plans.registry import query
from wellscore.plans.stored import input_state
from wellscore.session import scratch_path
from wellscore.sources import fixtures as fx
from wellscore.sources import io
from wellscore.spec import DEFAULT_SPEC, MODEL_FEATURES, TARGET_COL

SPEC = DEFAULT_SPEC
_TRAINED: dict[tuple, tuple] = {}
_FITTED: dict[tuple, dict] = {}
_CV: dict[tuple, dict] = {}
_SAVED: dict[tuple, str] = {}


def _session_key(spark, sf) -> tuple:
    return (spark.sparkContext.applicationId, sf, input_state(spark, sf), repr(SPEC))


def _split_sql(col: str = "respondent_id") -> str:
    return f"(((({col} * 7919) % 1000003) * 31 + 42) % 100)"


def _trained(spark, sf):
    """All models as configured, each fitted once per session."""
    key = _session_key(spark, sf)
    if key not in _TRAINED:
        e = _engineered(spark, sf)
        model_dir = scratch_path(spark, "models")
        metrics, fitted = md.train_all(spark, e, model_dir=model_dir, fitted=_fitted(spark, sf))
        _TRAINED[key] = (metrics.cache(), fitted, model_dir)
    return _TRAINED[key]


def _cv(spark, sf) -> dict[str, list[float]]:
    """R^2 per model and fold, all models as configured; once per session."""
    key = _session_key(spark, sf)
    if key not in _CV:
        e = _engineered(spark, sf)
        _CV[key] = md.cv_r2(md.split(e)[0], md.available_features(e), md.estimators())
    return _CV[key]


def _validated(spark, sf):
    _engineered(spark, sf)  # written before both start
    trained, cv = md.in_threads(spark, [_trained, _cv], lambda f: f(spark, sf))
    return md.with_cv(trained[0], cv)


# --- M ------------------------------------------------------------------------------


@query(
    "feature_select",
    "M1",
    lambda: f"{ctes.with_engineered()} SELECT respondent_id, {', '.join(MODEL_FEATURES)} FROM engineered",
)
def q_feature_select(spark, sf):
    e = _engineered(spark, sf)
    return e.select("respondent_id", *md.available_features(e))


@query(
    "split_counts",
    "M2",
    lambda: f"""WITH {ctes.respondents()}
SELECT CASE WHEN {_split_sql()} < 20 THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM respondents GROUP BY 1""",
)
def q_split_counts(spark, sf):
    r = fx.respondents(spark, sf)
    part = F.when(md.split_bucket(F.col("respondent_id")) < 20, "test").otherwise("train")
    return r.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


def _standardize_sql() -> str:
    cols = ", ".join(f"round((CAST({c} AS DOUBLE) - avg(CAST({c} AS DOUBLE)) OVER ()) / stddev_pop(CAST({c} AS DOUBLE)) OVER (), 6) AS {c}" for c in MODEL_FEATURES)
    return f"{ctes.with_engineered()} SELECT respondent_id, {cols} FROM engineered"


@query("standardize", "M3", _standardize_sql)
def q_standardize(spark, sf):
    e = _engineered(spark, sf).select("respondent_id", *MODEL_FEATURES)
    z = md.standardize(e, MODEL_FEATURES)
    return z.select("respondent_id", *[F.round(F.col(c), 6).alias(c) for c in MODEL_FEATURES])


def _fitted(spark, sf) -> dict:
    return _FITTED.setdefault(_session_key(spark, sf), {})


def _fit_one(spark, sf, name):
    train, test = md.split(_engineered(spark, sf))
    fitted = _fitted(spark, sf)
    fitted |= md.fit_models(train, [name])
    return md.regression_metrics(fitted[name].transform(test)).withColumn("model", F.lit(name))


def _linear_cte() -> str:
    """The engineered table, the linear model `lc` of its train part and `lt`, its predictions for the test part."""
    return f"""{ctes.with_engineered().replace("WITH ", "WITH RECURSIVE ", 1)},
tr AS (SELECT * FROM engineered WHERE {_split_sql()} >= 20), {linear_ctes("tr")},
lt AS (SELECT respondent_id, {TARGET_COL} AS y, {prediction()} AS p FROM engineered, lc WHERE {_split_sql()} < 20)"""


def _linear_metrics_sql() -> str:
    return f"""{_linear_cte()}
SELECT {S.rnd("avg(abs(p - y))", 4)} AS mae, {S.rnd("sqrt(avg((p - y) * (p - y)))", 4)} AS rmse,
       {S.rnd("1 - sum((p - y) * (p - y)) / (var_pop(y) * count(y))", 4)} AS r2, 'LinearRegression' AS model FROM lt"""


@query("model_lr", "M4", _linear_metrics_sql)
def q_model_lr(spark, sf):
    return _fit_one(spark, sf, "LinearRegression")


@query("model_rf", "M5")
def q_model_rf(spark, sf):
    return _fit_one(spark, sf, "RandomForest")


@query("model_gbt", "M6")
def q_model_gbt(spark, sf):
    return _fit_one(spark, sf, "GradientBoosting")


@query("model_gbt_sub", "M7")
def q_model_gbt_sub(spark, sf):
    return _fit_one(spark, sf, "GradientBoostingSubsampled")


@query("cv_r2", "M8")
def q_cv_r2(spark, sf):
    cv = _cv(spark, sf)
    folds = spark.createDataFrame([(name, i, v) for name, r2 in cv.items() for i, v in enumerate(r2)], "model string, fold int, r2 double")
    return md.with_cv(folds, cv)


def _formula_pred_cte() -> str:
    """Test part of the engineered table with a formula prediction (scoring-mode score, same range)."""
    ind = S.select_list(S.index_exprs(SPEC, "score"))
    inter = S.select_list(S.interaction_exprs("score"))
    pred = S.rnd(f"least(greatest(({S.minmax_expr('raw2')}), {S.D(0.0)}), {S.D(100.0)})", 2)
    return f"""{ctes.with_engineered()},
sc AS (SELECT respondent_id, burnout_score, {ind} FROM engineered WHERE {_split_sql()} < 20),
r2 AS (SELECT sc.*, {S.raw_expr()} AS raw2 FROM sc),
pred AS (SELECT respondent_id, burnout_score, {pred} AS prediction FROM r2, rng)"""


def _formula_pred(spark, sf):
    """Deterministic 'model': the scoring-mode formula with the training range."""
    r = fx.respondents(spark, sf)
    row = feat.frozen_range(r, SPEC).first()
    e = _engineered(spark, sf)
    _, test = md.split(e)
    known = test.withColumnRenamed(TARGET_COL, "label").drop(*SPEC.indices)  # the label stays in its row: no join back
    scored = feat.formula_score(known, SPEC, frozen=(row["mn"], row["mx"]))
    return scored.select("respondent_id", F.col(TARGET_COL).alias("prediction"), F.col("label").alias(TARGET_COL))


@query("regression_metrics", "M9", lambda: f"""{_formula_pred_cte()}
SELECT {S.rnd(S.grid_mean('abs(prediction - burnout_score)', 100), 4)} AS mae,
       {S.rnd(f"sqrt({S.grid_mean('(prediction - burnout_score) * (prediction - burnout_score)', 10000)})", 4)} AS rmse,
       {S.rnd(f'{S.D(1.0)} - (CAST(sum(CAST(round_even((prediction - burnout_score) * (prediction - burnout_score) * {S.D(10000)}, 0) AS BIGINT)) AS DOUBLE) / {S.D(10000)}) / (var_pop(burnout_score) * count(burnout_score))', 4)} AS r2 FROM pred""")
def q_regression_metrics(spark, sf):
    return md.regression_metrics(_formula_pred(spark, sf), grid=100)


@query("residual_stats", "M13", lambda: f"""{_formula_pred_cte()}
SELECT {S.rnd(S.grid_mean('burnout_score - prediction', 100), 4)} AS mean, {S.rnd('stddev_pop(burnout_score - prediction)', 4)} AS std,
       {S.rnd('max(abs(burnout_score - prediction))', 4)} AS max_abs FROM pred""")
def q_residual_stats(spark, sf):
    return md.residual_stats(_formula_pred(spark, sf), grid=100)


def _linear_folds_sql() -> str:
    """Least squares of every fold's train part by sweeping its matrix of sums of products, in DuckDB SQL."""
    cols = ["CAST(1 AS DOUBLE)", *[f"CAST({c} AS DOUBLE)" for c in MODEL_FEATURES], TARGET_COL]
    w = len(cols)
    at = f"list_extract(a, CAST(t * {w} + e % {w} AS BIGINT) + 1)"
    return f"""{ctes.with_engineered().replace("WITH ", "WITH RECURSIVE ", 1)},
tr AS (SELECT *, row_number() OVER (ORDER BY respondent_id) - 1 AS r, count(*) OVER () // 5 AS size, count(*) OVER () % 5 AS longer FROM engineered WHERE {_split_sql()} >= 20),
fd AS (SELECT *, CASE WHEN r < longer * (size + 1) THEN r // (size + 1) ELSE longer + (r - longer * (size + 1)) // size END AS fold FROM tr),
xs AS (SELECT respondent_id, fold, unnest(range({w})) AS i, unnest([{", ".join(cols)}]) AS x FROM fd),
g AS (SELECT a.fold, a.i, b.i AS j, sum(a.x * b.x) AS s FROM xs a JOIN xs b USING (respondent_id) GROUP BY a.fold, a.i, b.i),
m AS (SELECT k, list(s ORDER BY i, j) AS a FROM (SELECT k, i, j, sum(s) AS s FROM g, range(5) f(k) WHERE fold <> k GROUP BY k, i, j) GROUP BY k),
sw(k, t, a) AS (SELECT k, 0, a FROM m UNION ALL
  SELECT k, t + 1, list_transform(range({w * w}), lambda e: CASE WHEN e // {w} = t THEN {at} / list_extract(a, t * {w} + t + 1)
    ELSE list_extract(a, e + 1) - list_extract(a, (e // {w}) * {w} + t + 1) * {at} / list_extract(a, t * {w} + t + 1) END) FROM sw WHERE t < {w - 1}),
b AS (SELECT k, unnest(range({w - 1})) AS i, unnest(list_transform(range({w - 1}), lambda e: list_extract(a, e * {w} + {w}))) AS slope FROM sw WHERE t = {w - 1}),
p AS (SELECT fold, respondent_id, sum(slope * x) AS prediction FROM xs JOIN b ON b.k = xs.fold AND b.i = xs.i GROUP BY fold, respondent_id)
SELECT CAST(fold AS INTEGER) AS fold, round(1 - sum(({TARGET_COL} - prediction) * ({TARGET_COL} - prediction)) / (var_pop({TARGET_COL}) * count(*)), 7) AS r2
FROM p JOIN (SELECT respondent_id, {TARGET_COL} FROM fd) USING (respondent_id) GROUP BY fold"""


@query("cv_r2_linear", "M8", _linear_folds_sql)
def q_cv_r2_linear(spark, sf):
    e = _engineered(spark, sf)
    r2 = md.linear_cv_r2(md.with_folds(md.split(e)[0]), md.available_features(e))
    return spark.createDataFrame([(k, round(v, 7)) for k, v in enumerate(r2)], "fold int, r2 double")


@query("train_all", "M10")
def q_train_all(spark, sf):
    return _validated(spark, sf)


@query("best_model", "M11")
def q_best_model(spark, sf):
    return md.best_model(_trained(spark, sf)[0])


@query("evaluation_report", "M12")
def q_evaluation_report(spark, sf):
    metrics, fitted, model_dir = _trained(spark, sf)
    _, test = md.split(_engineered(spark, sf))
    best = md.best_model(metrics).first()["model"]  # one row
    return md.evaluate_saved(md.saved_model_dirs(model_dir, list(fitted)), test).withColumn("best_model", F.lit(best))


#: Deterministic predictors of the evaluation query, as SQL over the formula's prediction.
PREDICTORS = {"formula": "prediction", "shifted": "prediction + 1.5", "mirror": "100.0 - prediction", "flat": "50.0"}


def _evaluation_sql() -> str:
    parts = " UNION ALL ".join(f"SELECT {i} AS position, '{name}' AS model, burnout_score AS y, CAST({e} AS DOUBLE) AS p FROM pred" for i, (name, e) in enumerate(PREDICTORS.items()))
    r = lambda e: S.rnd(e, 4)
    return f"""{_formula_pred_cte()}, l AS ({parts}),
m AS (SELECT position, model, {r("avg(abs(p - y))")} AS mae, {r("sqrt(avg((p - y) * (p - y)))")} AS rmse, {r("1 - sum((p - y) * (p - y)) / (var_pop(y) * count(y))")} AS r2,
  {r("avg(y - p)")} AS residual_mean, {r("stddev_pop(y - p)")} AS residual_std, {r("max(abs(y - p))")} AS residual_max_abs FROM l GROUP BY position, model)
SELECT * EXCLUDE (position), model = (SELECT model FROM m ORDER BY r2 DESC, position LIMIT 1) AS is_best FROM m"""


@query("evaluation_formula", "M11 M12 M15", _evaluation_sql)
def q_evaluation_formula(spark, sf):
    """The evaluation over deterministic predictors, whose metrics SQL can state, and the best of them."""
    pairs = [F.struct(F.lit(name).alias("model"), F.expr(e).cast("double").alias("prediction")) for name, e in PREDICTORS.items()]
    path = scratch_path(spark, "formula")  # written: the formula is evaluated once, not once per predictor
    _formula_pred(spark, sf).write.parquet(path)
    m = md.evaluate_predictions(spark.read.parquet(path).select(TARGET_COL, F.array(*pairs).alias("predictions"))).persist()  # one row per model
    place = F.element_at(F.create_map(*[F.lit(x) for i, name in enumerate(PREDICTORS) for x in (name, i)]), F.col("model"))
    best = md.best_model(m.withColumn("position", place)).select(F.col("model").alias("best"))
    return m.join(F.broadcast(best), m.model == best.best, "left").withColumn("is_best", F.col("best").isNotNull()).drop("best")


@query("feature_importance", "M14")
def q_feature_importance(spark, sf):
    shown, fitted = ["RandomForest", "GradientBoosting"], _fitted(spark, sf)
    fitted |= md.fit_models(md.split(_engineered(spark, sf))[0], [name for name in shown if name not in fitted])
    rows = [(name, rank + 1, f, v) for name in shown for rank, (f, v) in enumerate(md.feature_importance(fitted[name]))]
    return spark.createDataFrame(rows, "model string, rank int, feature string, importance double")


@query("model_comparison", "M15")
def q_model_comparison(spark, sf):
    return md.model_comparison(_trained(spark, sf)[0])


# --- S ------------------------------------------------------------------------------


@query("scan_csv_roundtrip", "S1 S2", lambda: f"WITH {ctes.respondents()} SELECT * EXCLUDE (cohort) FROM respondents")
def q_scan_csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    io.write_table(fx.respondents(spark, sf).drop("cohort"), path, "csv")
    return io.read_csv(spark, path, io.survey_schema(SPEC))


def _scored_features(source: str, key: str = "respondent_id") -> str:
    """CTE `sf`: the indicators of ``source`` with the features rebuilt for scoring."""
    return f"sf AS (SELECT *, {S.select_list(S.index_exprs(SPEC, 'score'))}, {S.select_list(S.interaction_exprs('score'))} FROM {source})"


def _clipped(p: str) -> str:
    return S.rnd(f"least(greatest({p}, {S.D(0.0)}), {S.D(100.0)})", 2)


def _saved_linear(spark, sf) -> str:
    """The folder of the linear model, fitted on the train part and saved; once per session."""
    key = _session_key(spark, sf)
    if key not in _SAVED:
        fitted = _fitted(spark, sf)
        if "LinearRegression" not in fitted:
            fitted |= md.fit_models(md.split(_engineered(spark, sf))[0], ["LinearRegression"])
        _SAVED[key] = io.save_model(fitted["LinearRegression"], scratch_path(spark, "model"))
    return _SAVED[key]


def _batch_predict_sql() -> str:
    return f"""{_linear_cte()},
{_scored_features("respondents")},
sc AS (SELECT sf.*, {_clipped(prediction())} AS burnout_score FROM sf, lc),
banded AS (SELECT *, {S.band_expr("burnout_score")} AS risk_level FROM sc),
contrib AS ({_contrib_sql("banded")}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY respondent_id ORDER BY stress_contribution DESC, pos) AS rank FROM contrib),
top AS (SELECT respondent_id, string_agg(name || '=' || CAST(stress_contribution AS VARCHAR), ',' ORDER BY rank) AS drivers FROM ranked WHERE rank <= 3 GROUP BY respondent_id)
SELECT respondent_id, burnout_score, risk_level, {", ".join(SPEC.indices)}, drivers FROM banded JOIN top USING (respondent_id)"""


@query("batch_predict", "Q2 Q3 Q4 Q5 S3 D2", _batch_predict_sql)
def q_batch_predict(spark, sf):
    """Every respondent scored with the saved linear model, the best one on these tables."""
    model = io.load_model(_saved_linear(spark, sf))
    out = predict(fx.respondents(spark, sf), model, spec=SPEC)
    drivers = F.array_join(F.transform("stress_drivers", lambda d: F.concat(d["name"], F.lit("="), d["stress_contribution"].cast("string"))), ",")
    return out.select("respondent_id", "burnout_score", "risk_level", *SPEC.indices, drivers.alias("drivers"))


@query("best_residuals", "M13", lambda: f"""{_linear_cte()}
SELECT {S.rnd("avg(y - p)", 4)} AS mean, {S.rnd("stddev_pop(y - p)", 4)} AS std, {S.rnd("max(abs(y - p))", 4)} AS max_abs FROM lt""")
def q_best_residuals(spark, sf):
    """Residuals of the saved linear model, the best one on these tables."""
    _, test = md.split(_engineered(spark, sf))
    return md.residual_stats(io.load_model(_saved_linear(spark, sf)).transform(test))


def _feature_list_sql() -> str:
    rows = ", ".join(f"({i}, '{f}')" for i, f in enumerate(MODEL_FEATURES))
    return f"""{ctes.with_engineered()}, l(position, feature) AS (VALUES {rows}), n AS (SELECT count(*) AS n FROM engineered WHERE {_split_sql()} >= 20)
SELECT CAST(position AS INTEGER) AS position, feature, n AS train_rows FROM l, n"""


@query("feature_manifest", "S4", _feature_list_sql)
def q_feature_manifest(spark, sf):
    """The columns of the saved model in order, written as a table beside it and read back."""
    path = _saved_linear(spark, sf)
    io.write_manifest(spark, io.load_model(path), f"{path}-features", md.split(_engineered(spark, sf))[0].count())
    return io.read_manifest(spark, f"{path}-features")


@query("model_roundtrip", "S3 S4 Q2 Q3", lambda: f"""{_linear_cte()},
{_scored_features("respondents")} SELECT respondent_id, {_clipped(prediction())} AS burnout_score FROM sf, lc WHERE {_split_sql()} < 20""")
def q_model_roundtrip(spark, sf):
    _, test = md.split(_engineered(spark, sf))
    loaded = io.load_model(_saved_linear(spark, sf))
    records = io.with_missing_features(feat.score_features(test.select("respondent_id", *SPEC.features)), io.model_features(loaded))
    return loaded.transform(records).select("respondent_id", feat.clip_score(F.col("prediction")).alias("burnout_score"))


@query("metrics_summary", "S5")
def q_metrics_summary(spark, sf):
    metrics = _validated(spark, sf)
    path = scratch_path(spark, "metrics")
    io.write_metrics(metrics, path)
    back = io.read_metrics(spark, path)
    best = md.best_model(back).first()["model"]  # one row
    return back.withColumn("is_best", F.col("model") == F.lit(best))


@query("run_log", "S6")
def q_run_log(spark, sf):
    metrics = _validated(spark, sf)
    path = scratch_path(spark, "runlog")
    for _ in range(2):
        io.append_run_log(metrics, path, uuid.uuid4().hex, md.parameters())
    return io.read_run_log(spark, path)


def _run_log_sql() -> str:
    m = "SELECT * FROM (" + _linear_metrics_sql()[len(_linear_cte()):] + ")"
    return f"""{_linear_cte()}, m AS ({m}), k(run_id, folds) AS (VALUES ('run-a', 5.0), ('run-b', 6.0))
SELECT run_id, 'LinearRegression' AS model, key, value FROM k, (UNPIVOT m ON mae, rmse, r2 INTO NAME key VALUE value)
UNION ALL SELECT run_id, 'LinearRegression', 'param.folds', CAST(folds AS DOUBLE) FROM k"""


@query("run_log_linear", "S6", _run_log_sql)
def q_run_log_linear(spark, sf):
    """Two runs of the linear model in the log, the first written twice and the second three times."""
    _, test = md.split(_engineered(spark, sf))
    metrics = md.regression_metrics(io.load_model(_saved_linear(spark, sf)).transform(test)).withColumn("model", F.lit("LinearRegression")).persist()
    path = scratch_path(spark, "runlog")
    for run_id, folds in (("run-a", 5), ("run-b", 1), ("run-a", 5), ("run-b", 2), ("run-b", 6)):
        io.append_run_log(metrics, path, run_id, {"LinearRegression": {"folds": folds}})
    return io.read_run_log(spark, path)


def _json_sql() -> str:
    ind = S.select_list(S.index_exprs(SPEC, "score"))
    inter = S.select_list(S.interaction_exprs("score"))
    tr = S.select_list(S.index_exprs(SPEC))
    clipped = S.rnd(f"least(greatest(({S.minmax_expr()}), {S.D(0.0)}), {S.D(100.0)})", 2)
    return f"""WITH {ctes.respondents()},
tr AS (SELECT {tr} FROM respondents),
rng AS (SELECT min({S.raw_expr()}) AS mn, max({S.raw_expr()}) AS mx FROM tr),
sf AS (SELECT *, {ind}, {inter} FROM respondents),
rawt AS (SELECT *, {S.raw_expr()} AS raw_score FROM sf),
scored AS (SELECT respondent_id, {clipped} AS burnout_score FROM rawt, rng)
SELECT respondent_id, burnout_score, {S.band_expr('burnout_score')} AS risk_level FROM scored"""


@query("json_score_in_out", "S7 Q5", _json_sql)
def q_json_score_in_out(spark, sf):
    r = fx.respondents(spark, sf)
    row = feat.frozen_range(r, SPEC).first()
    schema = io.survey_schema(SPEC, key="respondent_id")
    text = r.select(io.records_to_json(r, ["respondent_id", *SPEC.features, "stress_level"]).alias("json"))
    parsed = text.select(io.json_to_records(F.col("json"), schema).alias("rec")).select("rec.*")
    scored = feat.formula_score(parsed, SPEC, frozen=(row["mn"], row["mx"]))
    out = scored.select("respondent_id", "burnout_score", "risk_level")
    # JSON sink and source of the scored records
    path = scratch_path(spark, "json")
    out.write.mode("overwrite").json(path)
    return spark.read.schema("respondent_id bigint, burnout_score double, risk_level string").json(path)


#: Every so many respondents, a planted fault of the CSV line or the JSON record; the first that applies counts.
CSV_FAULTS = {"type": 97, "short": 89, "long": 83}
JSON_FAULTS = {"cut": 31, "text": 37, "word": 41, "absent": 43, "extra": 47, "fraction": 53, "list": 59}


def _fault(faults: dict[str, int]):
    out = F.lit("")
    for name, k in reversed(faults.items()):
        out = F.when(F.col("respondent_id") % k == 0, F.lit(name)).otherwise(out)
    return out


def _fault_sql(faults: dict[str, int]) -> str:
    return "CASE " + " ".join(f"WHEN respondent_id % {k} = 0 THEN '{name}'" for name, k in faults.items()) + " ELSE '' END"


def _dirty_csv(spark, sf) -> str:
    """A folder of CSV files of the respondents with planted bad lines."""
    cols = [f.name for f in io.survey_schema(SPEC).fields]
    r = fx.respondents(spark, sf).withColumn("fault", _fault(CSV_FAULTS))
    head = F.concat_ws(",", *[F.col(c).cast("string") for c in cols[:-1]])
    broken = F.when(F.col("fault") == "type", F.concat(head, F.lit(",high"))).when(F.col("fault") == "short", head)
    whole = F.concat(head, F.lit(","), F.col(cols[-1]).cast("string"))
    lines = r.select(F.coalesce(broken, F.when(F.col("fault") == "long", F.concat(whole, F.lit(",9"))), whole).alias(",".join(cols)))
    path = scratch_path(spark, "dirty-csv")
    lines.write.option("header", True).option("quote", "").option("sep", "\t").csv(path)
    return path


@query("csv_good_rows", "S1", lambda: f"WITH {ctes.respondents()} SELECT * EXCLUDE (cohort) FROM respondents WHERE {_fault_sql(CSV_FAULTS)} = ''")
def q_csv_good_rows(spark, sf):
    return io.read_csv_with_rejects(spark, _dirty_csv(spark, sf), io.survey_schema(SPEC))[0]


def _csv_rejects_sql() -> str:
    cols = [f.name for f in io.survey_schema(SPEC).fields]
    head = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in cols[:-1])
    return f"""WITH {ctes.respondents()}, f AS (SELECT *, {_fault_sql(CSV_FAULTS)} AS fault FROM respondents)
SELECT {head} || CASE fault WHEN 'type' THEN ',high' WHEN 'short' THEN '' ELSE ',' || CAST({cols[-1]} AS VARCHAR) || ',9' END AS line,
       CAST(CASE WHEN fault = 'long' THEN {len(cols)} ELSE {len(cols) - 1} END AS INTEGER) AS n_read, CASE WHEN fault = 'type' THEN 'type:{cols[-1]}' ELSE 'fields' END AS reason FROM f WHERE fault <> ''"""


@query("csv_rejects", "S1", _csv_rejects_sql)
def q_csv_rejects(spark, sf):
    return io.read_csv_with_rejects(spark, _dirty_csv(spark, sf), io.survey_schema(SPEC))[1]


def _csv_types_sql() -> str:
    cols = [f.name for f in io.survey_schema(SPEC).fields]
    rows = [f"SELECT '{c}' AS column_name, 'int' AS type, count(*) FILTER (WHERE fault <> 'short' OR {i} < {len(cols) - 1}) AS n_values, {'count(*) FILTER (WHERE fault = ' + chr(39) + 'type' + chr(39) + ')' if i == len(cols) - 1 else 0} AS n_misfits FROM f" for i, c in enumerate(cols)]
    return f"WITH {ctes.respondents()}, f AS (SELECT *, {_fault_sql(CSV_FAULTS)} AS fault FROM respondents) " + " UNION ALL ".join(rows)


@query("csv_types", "S1", _csv_types_sql)
def q_csv_types(spark, sf):
    """Inferred types of the file with planted faults, 2 % misfits allowed."""
    return io.inferred_types(spark, _dirty_csv(spark, sf), tolerance=0.02)


def _json_records_sql() -> str:
    rejected = {"cut": "malformed", "word": "type:sleep_quality", "absent": "missing:depression", "fraction": "type:headache", "list": "not_an_object"}
    reason = "CASE fault " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rejected.items()) + " END"
    notes = "CASE fault WHEN 'text' THEN 'text:anxiety_level' WHEN 'extra' THEN 'extra:mood' ELSE '' END"
    total = " + ".join(SPEC.features)
    return f"""WITH {ctes.respondents()}, f AS (SELECT *, {_fault_sql(JSON_FAULTS)} AS fault FROM respondents), r AS (SELECT *, {reason} AS reason, {notes} AS notes FROM f)
SELECT respondent_id, reason, notes, CASE WHEN reason IS NULL THEN {total} END AS total FROM r"""


@query("json_records", "S7", _json_records_sql)
def q_json_records(spark, sf):
    """JSON records with planted faults, read one by one: why each was rejected, what was noted, and the sum of its indicators."""
    r = fx.respondents(spark, sf).withColumn("fault", _fault(JSON_FAULTS))
    fault = F.col("fault")
    text = F.to_json(F.struct(*[F.col(c) for c in SPEC.features]))
    swap = lambda f, value: F.regexp_replace(text, f'"{f}":-?[0-9]+', value)
    text = (
        F.when(fault == "cut", F.substring(text, 1, 40))
        .when(fault == "text", swap("anxiety_level", F.concat(F.lit('"anxiety_level":"'), F.col("anxiety_level"), F.lit('"'))))
        .when(fault == "word", swap("sleep_quality", F.lit('"sleep_quality":"bad"')))
        .when(fault == "absent", swap("depression", F.lit('"depressed":1')))
        .when(fault == "extra", F.concat(F.lit('{"mood":1,'), F.substring(text, 2, 100_000)))
        .when(fault == "fraction", swap("headache", F.lit('"headache":2.5')))
        .when(fault == "list", F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text)
    )
    schema = T.StructType([f for f in io.survey_schema(SPEC, key=None).fields if f.name in SPEC.features])
    read = io.read_json_records(r.select("respondent_id", text.alias("json")), "json", schema)
    total = sum((F.col(f"record.{f}") for f in SPEC.features[1:]), F.col(f"record.{SPEC.features[0]}"))
    notes = F.when(F.col("reason").startswith("missing"), F.lit("")).otherwise(F.col("notes"))
    return read.select("respondent_id", "reason", notes.alias("notes"), total.cast("long").alias("total"))
