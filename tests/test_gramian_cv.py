"""Sums of products with missing values, contiguous folds, and the linear model's folds without a fit."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from wellscore.operators import models as md
from wellscore.operators import report as rep
from wellscore.operators.gramian import means, products
from wellscore.spec import TARGET_COL


@pytest.fixture(scope="module")
def holed(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(rng.normal(size=(700, 4)) * [1, 10, 100, 1] + [0, 5, 1000, 0], columns=list("abcd"))
    frame["d"] = frame["a"] * 2 + frame["b"]
    for i, c in enumerate("abc"):
        frame.loc[i :: 7 + i, c] = np.nan
    df = spark.createDataFrame(frame).withColumn("k", (F.monotonically_increasing_id() % 3).cast("int"))
    half = F.when(F.isnan("a") & (F.col("k") == 0), None).otherwise(F.col("a"))  # some missing values null, some NaN
    return frame, df.withColumn("a", half).repartition(5)


def test_correlation_of_columns_with_missing_values(holed):
    frame, df = holed
    want = frame.corr()
    got = rep.correlation_pairs(df, list("abcd"), digits=9).collect()
    assert len(got) == 6
    for r in got:
        assert r["corr"] == pytest.approx(want.loc[r["row_col"], r["col_col"]], abs=1e-8)


def test_products_per_group_add_up(spark, holed):
    _, df = holed
    cols = list("abcd")
    shift = means(df, cols)
    whole, parts = products(df, cols, shift=shift)[None], products(df, cols, "k", shift)
    assert sorted(parts) == [0, 1, 2]
    for name in ("xx", "x", "x2", "n"):
        assert np.allclose(sum(getattr(p, name) for p in parts.values()), getattr(whole, name))
    assert products(df.limit(0), cols) == {}
    assert all(r["corr"] is None for r in rep.correlation_pairs(df.limit(0), cols).collect())


def test_folds_are_contiguous(spark):
    df = spark.range(1003).select((F.col("id") * 10).alias("respondent_id")).repartition(7)
    rows = sorted((r["respondent_id"], r[md.FOLD]) for r in md.with_folds(df).collect())
    assert [f for _, f in rows] == [k for k, n in enumerate([201, 201, 201, 200, 200]) for _ in range(n)]
    assert md.with_folds(df.limit(3)).where(F.col(md.FOLD) < 3).count() == 3
    assert md.with_folds(df.limit(0)).count() == 0


def test_linear_folds_equal_fitted_ones(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(500, 3))
    frame = pd.DataFrame(x, columns=["a", "b", "c"])
    frame["same"], frame["twin"] = 4.0, frame["a"] * 3 - 1  # a constant column and a linear copy
    frame[TARGET_COL] = x @ [2, -1, 0.5] + 30 + rng.normal(size=500)
    frame["respondent_id"] = rng.permutation(500)
    df = md.with_folds(spark.createDataFrame(frame))
    cols = ["a", "b", "c", "same", "twin"]
    got = md.linear_cv_r2(df, cols)
    for k in range(5):
        model = md.make_pipeline(cols, LinearRegression(labelCol=TARGET_COL)).fit(df.where(F.col(md.FOLD) != k))
        assert got[k] == pytest.approx(md.regression_metrics(model.transform(df.where(F.col(md.FOLD) == k)), digits=12).first()["r2"], abs=1e-6)  # a singular system is solved iteratively there


def test_linear_folds_leave_missing_rows_out_and_take_small_tables(spark):
    rows = [(i, float(i), 2.0 * i if i % 4 else None) for i in range(40)]
    df = md.with_folds(spark.createDataFrame(rows, f"respondent_id long, x double, {TARGET_COL} double"))
    assert md.linear_cv_r2(df, ["x"]) == pytest.approx([1.0] * 5)
    assert md.linear_cv_r2(df.limit(0), ["x"]) == [None] * 5


def test_tree_rows_are_coalesced_but_never_split(spark):
    from wellscore.operators.models import compact

    df = spark.range(0, 1000, 1, 8)
    assert [compact(df, n, 100).rdd.getNumPartitions() for n in (0, 100, 250, 1000)] == [1, 1, 3, 8]
    assert compact(df, 250, 100).agg({"id": "sum"}).first()[0] == 499_500


def test_a_forest_reads_more_partitions_than_boosting(spark, monkeypatch):
    from wellscore.operators import models as md

    seen = {}

    class Recorded:
        def __init__(self, est):
            self.est = est

        def fit(self, df):
            seen[type(self.est).__name__] = (df.rdd.getNumPartitions(), df.count())

    monkeypatch.setattr(md, "make_pipeline", lambda features, est: Recorded(est))
    df = spark.range(0, 35_000, 1, 8).selectExpr("id AS anxiety_level", f"id * 0.5D AS {md.TARGET_COL}")
    md.fit_models(df, ["RandomForest", "GradientBoosting"])
    assert seen == {"RandomForestRegressor": (3, 35_000), "GBTRegressor": (1, 35_000)}


def test_fits_of_a_fold_read_a_written_table_by_their_own_rows(spark, monkeypatch):
    seen, compact = [], md.compact

    class Recorded(RandomForestRegressor):
        def fit(self, df, params=None):
            seen.append((df.count(), df.rdd.getNumPartitions(), self.getCacheNodeIds(), "InMemoryRelation" in df._jdf.queryExecution().toString()))
            return super().fit(df, params)

    monkeypatch.setattr(md, "compact", lambda df, rows: compact(df, rows, 100))
    df = spark.range(0, 120, 1, 8).selectExpr("id AS respondent_id", "id % 10 AS x", f"id % 10 * 3.0D AS {TARGET_COL}")
    r2 = md.cv_r2(df, ["x"], {"forest": Recorded(labelCol=TARGET_COL, numTrees=3, seed=1)})
    assert seen == [(96, 1, True, False)] * 5 and min(r2["forest"]) > 0.8


def test_node_ids_are_kept_by_small_forests_only_and_change_no_tree(spark):
    forest = RandomForestRegressor(labelCol=TARGET_COL, numTrees=5, maxDepth=6, seed=3)
    assert [md.keeping_nodes(forest, n).getCacheNodeIds() for n in (md.NODE_IDS // 5, md.NODE_IDS // 5 + 1)] == [True, False]
    df = spark.range(0, 600, 1, 2).selectExpr("id % 37 AS a", "id % 11 AS b", f"(id % 37) * (id % 11) * 1.0D AS {TARGET_COL}")
    df = md.make_pipeline(["a", "b"], forest).getStages()[0].transform(df).withColumnRenamed("raw_features", "features")
    walked, kept = forest.fit(df), md.keeping_nodes(forest, 600).fit(df)
    assert kept.getCacheNodeIds() and kept.toDebugString.splitlines()[1:] == walked.toDebugString.splitlines()[1:]
    linear = LinearRegression()
    assert md.keeping_nodes(linear, 10).uid == linear.uid
