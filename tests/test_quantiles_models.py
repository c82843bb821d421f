"""Quantiles and modes from value counts, cross-validation of all models, rebuilt stored tables, stream files."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wellscore.operators import models as md
from wellscore.operators.quantiles import mode, quantiles
from wellscore.plans.stored import stored
from wellscore.spec import TARGET_COL
from wellscore.streaming import stream as st


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    hot = np.where(rng.random(5000) < 0.4, 7.0, rng.normal(size=5000))  # one value holds 40 % of the rows
    frame = pd.DataFrame({"hot": hot, "few": rng.integers(0, 4, 5000).astype(float), "one": np.full(5000, 2.5)})
    frame.loc[::10, "few"] = np.nan
    df = spark.createDataFrame(frame).withColumn("none", F.lit(None).cast("double"))
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["column_name"], r["prob"]): r["value"] for r in quantiles(df, ["hot", "few", "one", "none"], probs).collect()}
    assert {c for c, _ in got} == {"hot", "few", "one"}
    for (c, p), v in got.items():
        assert v == pytest.approx(np.nanquantile(frame[c], p), abs=1e-12)


def test_mode_ties_and_empty(spark):
    df = spark.createDataFrame([("b", None), ("b", None), ("a", None), ("a", None), (None, None), (None, None), (None, None)], "c string, e string")
    assert mode(df, "c") == "a" and mode(df, "e") is None


def test_cross_validation_of_every_model(spark):
    df = spark.range(400).select(F.col("id").alias("respondent_id"), (F.col("id") % 20).alias("x"), (F.col("id") % 20 * 3.0).alias(TARGET_COL))
    small = md.ModelConfig(rf_trees=4, rf_depth=5, gbt_iters=4, gbt_step=0.5, gbt2_iters=4)
    cv = md.cv_r2(df, ["x"], md.estimators(small))
    assert list(cv) == list(md.estimators()) and all(len(r2) == 5 for r2 in cv.values())
    assert min(cv["LinearRegression"]) > 0.999 and min(v for r2 in cv.values() for v in r2) > 0.8


def test_stored_is_built_again_for_new_input(spark, tmp_path):
    def build():
        return spark.read.parquet(f"{tmp_path}/orders.parquet")

    spark.range(3).write.parquet(f"{tmp_path}/orders.parquet")
    assert stored(spark, "t", str(tmp_path), build).count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{tmp_path}/orders.parquet")
    assert stored(spark, "t", str(tmp_path), build).count() == 5


def test_engineered_rows_are_built_from_written_respondents_by_compiled_methods(spark, monkeypatch):
    from conftest import SF_SMALL
    from wellscore.operators import features as feat
    from wellscore.plans import q_report
    from wellscore.plans import stored as st_module
    from wellscore.session import METHOD_LIMIT
    from wellscore.sources import fixtures as fx

    seen, engineer, before = [], feat.engineer, spark.conf.get(METHOD_LIMIT)

    def recorded(df, spec):
        seen.append((int(spark.conf.get(METHOD_LIMIT)) <= 8000, all("/respondents-" in f for f in df.inputFiles())))
        return engineer(df, spec)

    monkeypatch.setattr(st_module, "_MEMO", {})
    monkeypatch.setattr(feat, "engineer", recorded)
    got = q_report._engineered(spark, SF_SMALL)
    assert seen == [(True, True)] and spark.conf.get(METHOD_LIMIT) == before
    want = engineer(fx.respondents(spark, SF_SMALL))
    assert got.columns == want.columns and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_stream_slices_of_many_files(spark):
    rows = spark.range(30000).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 7).alias("ts"))
    path, files = st.write_event_files(spark, rows, rows_per_file=1500)
    assert files == 2
    written = spark.read.parquet(path)
    assert written.count() == 30000 and len(written.inputFiles()) == 16
