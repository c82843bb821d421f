"""Model training and evaluation with Spark ML.

Each fit is a distributed Spark ML job; the driver only loops over the
handful of estimators. The train/test split comes from an
arithmetic hash of the key, so they do not depend on partitioning (as
``randomSplit`` would) and are reproducible by an SQL oracle. Cross-validation
cuts the train part into contiguous folds by a global row number; the linear
model's folds are solved from sums of products per fold, without a fit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import regression as ml
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellscore.functions.columns import grid_mean, round_half_even
from wellscore.operators.gramian import Products, means, products
from wellscore.operators.ranges import numbered
from wellscore.operators.trees import GBTRegressor, RandomForestRegressor
from wellscore.session import scratch_path
from wellscore.spec import MODEL_FEATURES, TARGET_COL


def available_features(df: DataFrame, wanted: list[str] | None = None) -> list[str]:
    """The model's feature list, restricted to columns present in ``df``."""
    have = set(df.columns)
    return [c for c in (wanted or MODEL_FEATURES) if c in have]


def split_bucket(key: Column, seed: int = 42) -> Column:
    """Stable 0..99 bucket of an integer key (partitioning-independent)."""
    return F.pmod(F.pmod(F.pmod(key, F.lit(1000003)) * F.lit(7919), F.lit(1000003)) * F.lit(31) + F.lit(seed), F.lit(100))


def split(df: DataFrame, key: str = "respondent_id", test_pct: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    b = split_bucket(F.col(key), seed)
    return df.where(b >= test_pct), df.where(b < test_pct)


FOLD = "__fold"


def with_folds(train: DataFrame, key: str = "respondent_id", folds: int = 5) -> DataFrame:
    """``train`` with its fold (0-based): contiguous runs in key order, the first n % folds of them one row longer."""
    rows = numbered(train, [key], "__row")
    size, longer = divmod(rows.count(), folds)
    edge = longer * (size + 1)
    fold = F.when(F.col("__row") < edge, F.expr(f"__row div {size + 1}")).otherwise(F.expr(f"{longer} + (__row - {edge}) div {max(size, 1)}"))
    return rows.withColumn(FOLD, fold.cast("int")).drop("__row")


def standardize(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - mean) / population std per column; one aggregate for all means and stds."""
    stats = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols], *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols]).first()
    out = {}
    for c in cols:
        m, s = stats[f"m_{c}"], stats[f"s_{c}"]
        out[c] = (F.col(c).cast("double") - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
    return df.withColumns(out)


@dataclass(frozen=True)
class ModelConfig:
    rf_trees: int = 150
    rf_depth: int = 12
    rf_min_leaf: int = 2
    gbt_iters: int = 200
    gbt_depth: int = 5
    gbt_step: float = 0.05
    gbt2_iters: int = 200
    gbt2_depth: int = 6
    gbt2_subsample: float = 0.8
    seed: int = 42


FULL = ModelConfig()


def estimators(cfg: ModelConfig = FULL, label: str = TARGET_COL) -> dict:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "LinearRegression": LinearRegression(**common),
        "RandomForest": RandomForestRegressor(
            numTrees=cfg.rf_trees, maxDepth=cfg.rf_depth, minInstancesPerNode=cfg.rf_min_leaf, featureSubsetStrategy="all", seed=cfg.seed, **common
        ),
        "GradientBoosting": GBTRegressor(maxIter=cfg.gbt_iters, maxDepth=cfg.gbt_depth, stepSize=cfg.gbt_step, seed=cfg.seed, **common),
        "GradientBoostingSubsampled": GBTRegressor(
            maxIter=cfg.gbt2_iters, maxDepth=cfg.gbt2_depth, stepSize=cfg.gbt_step, subsamplingRate=cfg.gbt2_subsample,
            featureSubsetStrategy="0.8", seed=cfg.seed, **common,
        ),
    }


def parameters(cfg: ModelConfig = FULL) -> dict[str, dict[str, float]]:
    """The numeric parameters set on each estimator, for the run log."""
    return {
        name: {p.name: float(est.getOrDefault(p)) for p in est.params if est.isSet(p) and isinstance(est.getOrDefault(p), (int, float))}
        for name, est in estimators(cfg).items()
    }


def make_pipeline(features: list[str], estimator) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="raw_features", handleInvalid="keep"),
            StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
            estimator,
        ]
    )


def regression_metrics(df: DataFrame, label: str = TARGET_COL, pred: str = "prediction", digits: int = 4, grid: float | None = None) -> DataFrame:
    """MAE, RMSE, R^2 in one aggregate (R^2 null for a constant label).

    ``grid=100`` when label and prediction are 2-digit values: the error sums
    are then exact integer sums, independent of partitioning.
    """
    e = F.col(pred) - F.col(label)
    if grid:
        sq = F.rint(e * e * F.lit(float(grid * grid))).cast("bigint")
        mae, mse = grid_mean(F.abs(e), grid), grid_mean(e * e, grid * grid)
        sse = F.sum(sq).cast("double") / F.lit(float(grid * grid))
    else:
        mae, mse, sse = F.avg(F.abs(e)), F.avg(e * e), F.sum(e * e)
    agg = df.agg(
        mae.alias("mae"),
        F.sqrt(mse).alias("rmse"),
        sse.alias("sse"),
        (F.var_pop(F.col(label)) * F.count(F.col(label))).alias("sst"),
    )
    return agg.select(
        round_half_even(F.col("mae"), digits).alias("mae"),
        round_half_even(F.col("rmse"), digits).alias("rmse"),
        round_half_even(F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst")), digits).alias("r2"),
    )


def residual_stats(df: DataFrame, label: str = TARGET_COL, pred: str = "prediction", digits: int = 4, grid: float | None = None) -> DataFrame:
    r = F.col(label) - F.col(pred)
    return df.agg(
        round_half_even(grid_mean(r, grid) if grid else F.avg(r), digits).alias("mean"),
        round_half_even(F.stddev_pop(r), digits).alias("std"),
        round_half_even(F.max(F.abs(r)), digits).alias("max_abs"),
    )


def least_squares(train: Products) -> tuple[float, np.ndarray]:
    """(intercept, slopes) from sums of products, label last: of all lines that fit best, the one of smallest norm over standardised columns.

    Collinear columns share a slope and constant ones have none, where an iterative solver stops short."""
    n, s = train.n[0, 0], train.x.diagonal()
    c = train.xx - np.outer(s, s) / n
    scale = np.sqrt(np.maximum(c.diagonal(), 0.0))
    scale = np.where(scale > 1e-9 * np.sqrt(np.maximum(train.xx.diagonal(), 1e-300)), scale, np.inf)
    z = c / np.outer(scale, scale)
    slopes = np.linalg.lstsq(z[:-1, :-1], c[:-1, -1] / scale[:-1], rcond=1e-12)[0] / scale[:-1]
    return float((s[-1] - slopes @ s[:-1]) / n), slopes


def linear_r2(train: Products, held: Products) -> float | None:
    """R^2 on held-out rows of the least-squares line of the train rows, both given as sums of products."""
    intercept, slopes = least_squares(train)
    w = np.append(-slopes, 1.0)  # the residual before the intercept
    m, t = held.n[0, 0], held.x.diagonal()
    sse = w @ held.xx @ w - 2 * intercept * (w @ t) + m * intercept**2
    sst = held.xx[-1, -1] - t[-1] ** 2 / m
    return None if sst <= 0 else float(1.0 - sse / sst)


def fit_linear(train: DataFrame, features: list[str], label: str = TARGET_COL) -> PipelineModel:
    """The linear model as a pipeline to save: the feature columns' assembler and the line as an SQL stage.

    One pass for the means and one for the sums of products; rows with a missing value are left out,
    and a row to score with one has no prediction."""
    cols = [*features, label]
    x = train.dropna(subset=cols)
    shift = np.array(means(x, cols))
    sums = products(x, cols, shift=list(shift)).get(None)
    if sums is None:
        raise ValueError("no complete row to fit")
    intercept, slopes = least_squares(sums)
    intercept += shift[-1] - slopes @ shift[:-1]
    terms = [f"({float(v)!r}D * CAST(`{f}` AS DOUBLE))" for f, v in zip(features, slopes, strict=True)]
    line = SQLTransformer(statement=f"SELECT *, ({' + '.join([f'({float(intercept)!r}D)', *terms])}) AS prediction FROM __THIS__")
    return PipelineModel([VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep"), line])


def linear_cv_r2(folded: DataFrame, features: list[str], label: str = TARGET_COL, folds: int = 5) -> list[float | None]:
    """R^2 of the linear model on every fold, fitted on the others: one pass for the sums of products of every fold.

    The train part of a fold is the total less the fold, so no fold is read again and none is fitted.
    Rows with a missing value are left out."""
    cols = [*features, label]
    x = folded.dropna(subset=cols)
    parts = products(x, cols, FOLD, means(x, cols))
    total = None
    for p in parts.values():
        total = p if total is None else total + p
    return [linear_r2(total - parts[k], parts[k]) if k in parts and len(parts) > 1 else None for k in range(folds)]


def in_threads(spark: SparkSession, jobs: list, run, parallelism: int = 8) -> list:
    """run(job) of every job, ``parallelism`` at a time; the jobs' Spark work shares the session's executors."""
    from multiprocessing.pool import ThreadPool

    from pyspark import inheritable_thread_target

    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        return pool.map(inheritable_thread_target(spark)(run), jobs, chunksize=1)


#: Rows per task of a tree fit. A boosting round is a chain of small jobs: below this many rows their
#: cost is the starting of tasks, and the fits that run at the same time fill the cores.
TREE_ROWS = 100_000

#: The same for a forest fitted with few others: a row costs it all its trees in every pass, so that
#: few rows fill a task. More tasks also shuffle more node statistics, so cross-validation, which
#: fills the cores with its fits, stays with TREE_ROWS.
FOREST_ROWS = 15_000


def compact(df: DataFrame, rows: int, rows_per_task: int = TREE_ROWS) -> DataFrame:
    """``df`` in no more partitions than ``rows`` needs; larger partitions stay as they are (no shuffle)."""
    return df.coalesce(max(1, -(-rows // rows_per_task)))


#: A forest keeps the node that every row has reached in every tree, up to so many of them (4 bytes each): walking
#: down all levels of all trees again in every pass takes longer. Larger forests walk. The trees are the same either way.
NODE_IDS = 200_000_000


def keeping_nodes(est, rows: int):
    """A copy of ``est`` to fit on ``rows`` rows; a forest's keeps its node ids if they are few enough."""
    est = est.copy()
    return est.setCacheNodeIds(rows * est.getNumTrees() <= NODE_IDS) if isinstance(est, ml.RandomForestRegressor) else est


def cv_r2(
    train: DataFrame, features: list[str], ests: dict, key: str = "respondent_id", folds: int = 5, label: str = TARGET_COL, parallelism: int = 16
) -> dict[str, list[float]]:
    """R^2 of every estimator and fold: fit on the other folds, score the held-out one (``with_folds``).

    The linear model's come from sums of products. The tree models need no scaling: all their fits read
    one written table of assembled vectors, in as many partitions as the rows of the fit need, the slowest first.
    """
    folded = with_folds(train, key, folds)
    trees = [name for name, est in ests.items() if not isinstance(est, LinearRegression)]
    linear = linear_cv_r2(folded, features, label, folds) if len(trees) < len(ests) else []
    out = {name: linear for name in ests if name not in trees}
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="keep")
    rows, f = train.count(), assembler.transform(folded).select("features", label, FOLD)
    others = rows - rows // folds
    if trees:  # written, not kept: a kept table takes its whole lineage into every task of every round
        path = scratch_path(train.sparkSession, "folds")
        compact(f, rows).write.parquet(path)
        f = train.sparkSession.read.schema(f.schema).parquet(path)

    def one(job: tuple[str, int]) -> float:
        name, k = job
        model = keeping_nodes(ests[name], others).fit(compact(f.where(F.col(FOLD) != k), others))
        return regression_metrics(model.transform(f.where(F.col(FOLD) == k)), label, digits=12).first()["r2"]

    jobs = [(name, k) for name in reversed(trees) for k in range(folds)]
    r2 = dict(zip(jobs, in_threads(train.sparkSession, jobs, one, parallelism), strict=True)) if jobs else {}
    out |= {name: [r2[name, k] for k in range(folds)] for name in trees}
    return {name: out[name] for name in ests}


def fit_models(train: DataFrame, names: list[str], cfg: ModelConfig = FULL, parallelism: int = 4) -> dict[str, PipelineModel]:
    """The named models, fitted on the train part at the same time."""
    features, ests, rows = available_features(train), estimators(cfg), train.count()
    kept = compact(train.select(*features, TARGET_COL), rows, FOREST_ROWS).persist()

    def fit(name: str) -> PipelineModel:
        if isinstance(ests[name], LinearRegression):
            return fit_linear(kept, features)
        return make_pipeline(features, keeping_nodes(ests[name], rows)).fit(kept if isinstance(ests[name], ml.RandomForestRegressor) else compact(kept, rows))

    try:
        models = in_threads(train.sparkSession, names, fit, parallelism)
    finally:
        kept.unpersist()
    return dict(zip(names, models, strict=True))


def train_all(
    spark: SparkSession,
    df: DataFrame,
    cfg: ModelConfig = FULL,
    key: str = "respondent_id",
    model_dir: str | None = None,
    fitted: dict[str, PipelineModel] | None = None,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every estimator on the train part, score the test part.

    Returns the metrics table (model, position, mae, rmse, r2; ``with_cv`` adds the
    cross-validated columns) and the fitted pipelines (saved under ``model_dir`` if given).
    ``fitted`` may hold pipelines already fitted on this train part; they aren't fitted again.
    """
    train, test = split(df, key)
    rows, fitted = [], dict(fitted or {})
    fitted |= fit_models(train, [name for name in estimators(cfg) if name not in fitted], cfg)
    for pos, name in enumerate(estimators(cfg)):
        m = regression_metrics(fitted[name].transform(test)).first()
        rows.append((name, pos, m["mae"], m["rmse"], m["r2"]))
        if model_dir:
            fitted[name].write().overwrite().save(f"{model_dir}/{name.lower()}_model")
    metrics = spark.createDataFrame(rows, "model string, position int, mae double, rmse double, r2 double")
    if model_dir and rows:
        # the best model (highest R^2, first on ties) is also kept as its own copy
        best = max(rows, key=lambda r: (r[4] if r[4] is not None else float("-inf"), -r[1]))[0]
        fitted[best].write().overwrite().save(f"{model_dir}/{BEST_MODEL_DIR}")
    return metrics, fitted


def with_cv(metrics: DataFrame, cv: dict[str, list[float]]) -> DataFrame:
    """The metrics table with cv_r2_mean and cv_r2_std (population) of every model."""
    import statistics

    rows = [(name, round(statistics.fmean(r2), 4), round(statistics.pstdev(r2), 4)) for name, r2 in cv.items()]
    stats = metrics.sparkSession.createDataFrame(rows, "model string, cv_r2_mean double, cv_r2_std double")
    return metrics.join(F.broadcast(stats), "model", "left")


BEST_MODEL_DIR = "best_model"


def saved_model_dirs(model_dir: str, names: list[str]) -> dict[str, str]:
    """Every saved model folder, the best-model copy included (as an extra entry)."""
    out = {n.lower(): f"{model_dir}/{n.lower()}_model" for n in names}
    out[BEST_MODEL_DIR] = f"{model_dir}/{BEST_MODEL_DIR}"
    return out


def best_model(metrics: DataFrame) -> DataFrame:
    """Highest R^2; the first listed wins a tie."""
    return metrics.orderBy(F.col("r2").desc_nulls_last(), F.col("position").asc()).limit(1)


def model_comparison(metrics: DataFrame) -> DataFrame:
    """Long (model, metric, value, is_best) for the comparison chart."""
    best = best_model(metrics).select(F.col("model").alias("best"))
    long = metrics.unpivot(["model"], ["mae", "rmse", "r2"], "metric", "value")
    return long.join(F.broadcast(best), how="left", on=long.model == best.best).select(
        "model", "metric", "value", F.coalesce(F.col("best") == F.col("model"), F.lit(False)).alias("is_best")
    )


def feature_importance(model: PipelineModel, top: int = 18) -> list[tuple[str, float]]:
    """Top tree-model importances, zipped with the assembler's input columns."""
    features = model.stages[0].getInputCols()
    imp = model.stages[-1].featureImportances.toArray()
    pairs = sorted(zip(features, imp), key=lambda t: -t[1])
    return [(f, float(v)) for f, v in pairs[:top]]


def evaluate_saved(dirs: dict[str, str], test: DataFrame, label: str = TARGET_COL) -> DataFrame:
    """Load each saved pipeline and evaluate it on the held-out part."""
    return evaluate({name: PipelineModel.load(path) for name, path in dirs.items()}, test, label)


def all_predictions(models: dict[str, PipelineModel], test: DataFrame, label: str = TARGET_COL) -> DataFrame:
    """(label, predictions): every row once, with array<struct<model, prediction>> of all models in order."""
    df = test
    for i, m in enumerate(models.values()):
        made = [c for c in m.transform(df.limit(0)).columns if c not in df.columns and c != "prediction"]
        df = m.transform(df).withColumnRenamed("prediction", f"__p{i}").drop(*made)
    pairs = [F.struct(F.lit(name).alias("model"), F.col(f"__p{i}").cast("double").alias("prediction")) for i, name in enumerate(models)]
    return df.select(label, F.array(*pairs).alias("predictions"))


def evaluate(models: dict[str, PipelineModel], test: DataFrame, label: str = TARGET_COL) -> DataFrame:
    """Metrics and residual statistics of every model: one scan of the test part applies all models."""
    return evaluate_predictions(all_predictions(models, test, label), label)


def evaluate_predictions(rows: DataFrame, label: str = TARGET_COL) -> DataFrame:
    """Metrics and residual statistics by model, one aggregate over rows that hold all predictions in an array."""
    preds = rows.select(label, F.inline("predictions"))
    e = F.col("prediction") - F.col(label)
    g = preds.groupBy("model").agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.sum(e * e).alias("sse"), (F.var_pop(label) * F.count(label)).alias("sst"),
        F.avg(-e).alias("mean"), F.stddev_pop(e).alias("std"), F.max(F.abs(e)).alias("worst"),
    )
    return g.select(
        "model",
        round_half_even(F.col("mae"), 4).alias("mae"),
        round_half_even(F.col("rmse"), 4).alias("rmse"),
        round_half_even(F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst")), 4).alias("r2"),
        round_half_even(F.col("mean"), 4).alias("residual_mean"),
        round_half_even(F.col("std"), 4).alias("residual_std"),
        round_half_even(F.col("worst"), 4).alias("residual_max_abs"),
    )
