"""Trees grown over binned rows: Spark ML's own trees where nothing is random, few jobs, odd rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml import regression as ml
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from wellscore.operators import models as md
from wellscore.operators import trees as tr
from wellscore.spec import TARGET_COL

COLS = list("abcde")


@pytest.fixture(scope="module")
def rows(spark):
    rng, n = np.random.default_rng(1), 2000
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 6, n), rng.integers(0, 40, n), rng.normal(size=n) ** 3, np.full(n, 2.0)])
    y = np.round(x[:, 0] * 3 + x[:, 1] * x[:, 2] / 5 + np.sin(x[:, 3]) + rng.normal(size=n) * 0.1, 2)
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=[*COLS, TARGET_COL])).repartition(3)
    return VectorAssembler(inputCols=COLS, outputCol="features", handleInvalid="keep").transform(df).cache()


def predictions(model, rows):
    return np.array([r[0] for r in model.transform(rows).select("prediction").collect()])


def r2(model, rows):
    return md.regression_metrics(model.transform(rows)).first()["r2"]


def test_boosting_grows_the_trees_of_spark_ml(rows):
    params = {"labelCol": TARGET_COL, "maxIter": 8, "maxDepth": 4, "stepSize": 0.05, "seed": 42}
    want, got = ml.GBTRegressor(**params).fit(rows), tr.GBTRegressor(**params).fit(rows)
    shape = lambda m: [line.split("Predict")[0] for line in m.toDebugString.splitlines()[1:]]
    assert shape(got) == shape(want)
    assert predictions(got, rows) == pytest.approx(predictions(want, rows), abs=1e-9)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-4)
    assert got.treeWeights == want.treeWeights and got.extractParamMap().keys() == {got.getParam(p.name) for p in want.extractParamMap()}


def test_bins_of_many_rows_are_those_of_spark_ml(spark):
    df = spark.range(0, 12_000, 1, 3).selectExpr("sqrt(id % 4001) AS x", "id % 7 AS z", f"round(sqrt(id % 4001) * (id % 7), 2) AS {TARGET_COL}")
    table = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)
    params = {"labelCol": TARGET_COL, "maxIter": 2, "maxDepth": 3, "seed": 42}
    want, got = ml.GBTRegressor(**params).fit(table), tr.GBTRegressor(**params).fit(table)
    shape = lambda m: [line.split("Predict")[0] for line in m.toDebugString.splitlines()[1:]]
    assert shape(got) == shape(want)


def test_a_forest_is_as_good_as_that_of_spark_ml_and_always_the_same(rows):
    params = {"labelCol": TARGET_COL, "numTrees": 12, "maxDepth": 8, "minInstancesPerNode": 2, "featureSubsetStrategy": "all", "seed": 42}
    want, got = ml.RandomForestRegressor(**params).fit(rows), tr.RandomForestRegressor(**params).fit(rows)
    assert got.getNumTrees == 12 and r2(got, rows) == pytest.approx(r2(want, rows), abs=0.002)
    assert got.totalNumNodes == pytest.approx(want.totalNumNodes, rel=0.05)
    assert predictions(tr.RandomForestRegressor(**params).fit(rows), rows).tolist() == predictions(got, rows).tolist()
    assert len({t.toDebugString for t in got.trees}) == 12


def test_a_subsampled_boosting_is_as_good_as_that_of_spark_ml(rows):
    params = {"labelCol": TARGET_COL, "maxIter": 12, "maxDepth": 5, "stepSize": 0.2, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
    of = lambda kind: np.mean([r2(kind(seed=s, **params).fit(rows), rows) for s in (1, 2)])
    assert of(tr.GBTRegressor) == pytest.approx(of(ml.GBTRegressor), abs=0.01)


def test_no_fit_of_the_configuration_starts_a_job_per_level(spark, rows):
    cfg = md.ModelConfig(rf_trees=6, rf_depth=6, gbt_iters=20, gbt2_iters=20)
    for name, est in list(md.estimators(cfg).items())[1:]:
        spark.sparkContext.setJobGroup(f"fit {name}", name)
        est.fit(rows)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit {name}")) < 20  # boosting alone took 100 level passes
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_thresholds_share_rows_out_or_are_all_midpoints():
    assert tr.thresholds(np.array([3.0, 1.0, 2.0, 2.0, np.nan])).tolist() == [1.5, 2.5]
    assert tr.thresholds(np.full(9, 4.0)).tolist() == []
    cuts = tr.thresholds(np.random.default_rng(0).random(10_000))
    assert len(cuts) == 31 and np.abs(np.diff(np.append(0, cuts)) - 1 / 32).max() < 0.01


def test_features_that_share_a_code_are_counted_apart():
    rng = np.random.default_rng(2)
    x = np.column_stack([rng.integers(0, k, 500) for k in (2, 6, 5, 30, 40)]).astype(float)
    lay = tr.Layout.of([tr.thresholds(c) for c in x.T])
    rows, node, v = tr.Rows(lay, lay.encode(x)), rng.integers(0, 4, 500), rng.normal(size=500)  # node 3 is none
    rows.separate()
    got = []
    for apart in (False, True):
        sums = tr.Sums(lay, 3, apart, False)
        for lo in (0, 200):
            part = slice(lo, 200 if not lo else 500)
            sums.add(rows, lo, node[part], v[part], v[part], None)
        got.append(sums.histograms())
    bins = np.searchsorted(lay.cuts[1], x[:, 1])
    assert np.allclose(got[0], got[1]) and len(lay.codes) < 5
    assert got[0][0, 2, 1, :6].tolist() == np.bincount(bins[node == 2], minlength=6).tolist()
    assert np.allclose(got[0][1, 1, 1, :6], np.bincount(bins[node == 1], v[node == 1], 6))


def test_missing_features_go_right_and_missing_labels_are_refused(spark, tmp_path):
    df = spark.range(400).select((F.when(F.col("id") % 4 == 0, float("nan")).otherwise(F.col("id") % 4)).alias("x"), F.lit(1.0).alias("one"), (F.col("id") % 4 * 5.0).alias(TARGET_COL))
    table = VectorAssembler(inputCols=["x", "one"], outputCol="features", handleInvalid="keep").transform(df)
    model = tr.GBTRegressor(labelCol=TARGET_COL, maxIter=3, maxDepth=3).fit(table)
    worst = model.transform(table).where("NOT isnan(x)").agg(F.max(F.abs(F.col("prediction") - F.col(TARGET_COL)))).first()[0]
    assert worst < 15 and model.transform(table).where("isnan(prediction)").count() == 0
    flat = tr.RandomForestRegressor(labelCol=TARGET_COL, numTrees=2, featureSubsetStrategy="all").fit(table.withColumn(TARGET_COL, F.lit(7.0)))
    assert flat.totalNumNodes == 2 and set(predictions(flat, table)) == {7.0}
    PipelineModel([flat]).save(f"{tmp_path}/m")
    assert set(predictions(PipelineModel.load(f"{tmp_path}/m"), table)) == {7.0}
    with pytest.raises(Exception, match="labels must not be null or NaN"):
        tr.GBTRegressor(labelCol=TARGET_COL).fit(table.withColumn(TARGET_COL, F.when(F.col("x") > 1, F.lit(None)).otherwise(F.col(TARGET_COL))))
    with pytest.raises(ValueError, match="no row"):
        tr.RandomForestRegressor(labelCol=TARGET_COL, featureSubsetStrategy="all").fit(table.limit(0))


def test_a_forest_of_more_rows_than_a_task_holds_has_the_same_trees(rows, monkeypatch):
    params = {"labelCol": TARGET_COL, "numTrees": 5, "maxDepth": 7, "minInstancesPerNode": 2, "featureSubsetStrategy": "all", "seed": 42}
    whole = tr.RandomForestRegressor(**params).fit(rows)
    monkeypatch.setattr(tr, "LOCAL_ROWS", 400)
    monkeypatch.setattr(ml.RandomForestRegressor, "_fit", None)
    parts = tr.RandomForestRegressor(**params).fit(rows)
    assert parts.totalNumNodes == whole.totalNumNodes
    assert predictions(parts, rows) == pytest.approx(predictions(whole, rows), abs=1e-9)
    assert parts.featureImportances.toArray() == pytest.approx(whole.featureImportances.toArray(), abs=1e-9)
    shallow = {**params, "maxDepth": 1, "numTrees": 2}
    assert [t.numNodes for t in tr.RandomForestRegressor(**shallow).fit(rows).trees] == [3, 3]
    flat = rows.withColumn(TARGET_COL, F.lit(7.0))
    assert set(predictions(tr.RandomForestRegressor(**params).fit(flat), flat)) == {7.0}
