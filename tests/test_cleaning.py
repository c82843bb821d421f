"""Cleaning chain: names, imputation, dedupe, IQR clip, one-hot."""

import pytest
from pyspark.sql import functions as F

from wellscore.operators import clean as cl
from wellscore.operators import validate as val


def test_standardize_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["  Anxiety Level ", "Study Load"])
    assert cl.standardize_names(df).columns == ["anxiety_level", "study_load"]
    with pytest.raises(ValueError):
        cl.standardize_names(spark.createDataFrame([(1, 2)], ["A b", "a_b"]))


def test_missing_columns_raise(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        val.require_columns(df, ["a", "b"])


def test_median_mode_imputation_and_nan(spark):
    rows = [(1.0, "x"), (None, None), (float("nan"), "y"), (3.0, "y"), (4.0, "x")]
    df = spark.createDataFrame(rows, "v double, c string")
    assert {r["column_name"]: r["null_count"] for r in val.null_counts(df).collect()} == {"v": 2, "c": 1, "__total__": 3}
    out = cl.impute(df).collect()
    assert [r["v"] for r in out] == [1.0, 3.0, 3.0, 3.0, 4.0]
    assert [r["c"] for r in out] == ["x", "x", "y", "y", "x"]  # tie -> smallest


def test_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "a int, b double")
    assert [r["b"] for r in cl.impute(df).collect()] == [None, None]


def test_dedupe_after_imputation_merges_rows(spark):
    df = spark.createDataFrame([(1.0, 2), (None, 2), (1.0, 2)], "a double, b int")
    assert cl.dedupe(cl.impute(df)).count() == 1


def test_iqr_clip_and_counts(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    out = [r["x"] for r in cl.iqr_clip(df, ["x"], 1.5).collect()]
    # q1 = 3, q3 = 7, iqr = 4 -> bounds [-3, 13]
    assert max(out) == 13.0
    counts = {r["column_name"]: r["n_clipped"] for r in cl.outlier_counts(df, ["x"], 1.5).collect()}
    assert counts == {"x": 1, "__total__": 1}


def test_one_hot_drop_first(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",)], "g string")
    out = cl.one_hot(df, ["g"])
    assert out.columns == ["g_b", "g_c"]
    assert [tuple(r) for r in out.collect()] == [(True, False), (False, False), (False, True)]


def test_approx_quantile_path_close_to_exact(spark):
    df = spark.range(0, 20001).select((F.col("id") % 1000).cast("double").alias("x"), F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id") % 500).cast("double").alias("y"))
    exact = {r["column_name"]: r for r in cl.iqr_bounds(df, ["x", "y"], 1.5).collect()}
    approx = {r["column_name"]: r for r in cl.iqr_bounds(df, ["x", "y"], 1.5, approx=True).collect()}
    for c in ("x", "y"):
        assert abs(exact[c]["q1"] - approx[c]["q1"]) <= 2 and abs(exact[c]["q3"] - approx[c]["q3"]) <= 2
    med = cl.missing_stats(df, approx=True)["y"][1]
    assert abs(med - 249.5) <= 2
