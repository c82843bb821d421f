"""Null and NaN values are missing everywhere; no respondent disappears."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wellscore.functions.columns import norm
from wellscore.operators import clean, drivers, features, models, report, survey
from wellscore.plans.queries import queries

NAN = float("nan")


def test_missing_scores_have_no_band(spark):
    df = spark.createDataFrame([(None,), (NAN,), (-3.0,), (50.0,), (120.0,)], "s double").select(features.clip_score(F.col("s")).alias("s"))
    got = df.select("s", features.risk_band(F.col("s")).alias("b"), features.band_advice(features.risk_band(F.col("s"))).isNull().alias("none")).collect()
    assert [tuple(r) for r in got] == [(None, None, True), (None, None, True), (0.0, "Low", False), (50.0, "Moderate", False), (100.0, "High", False)]
    assert spark.createDataFrame([(NAN,)], "x double").select(norm("x", 5)).first()[0] is None


def test_nan_is_not_an_outlier_nor_in_a_bin(spark):
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(20)] + [(NAN, 1.0)], "x double, y double")
    assert clean.iqr_clip(df, ["x"]).filter("x IS NULL").count() == 1
    assert {r["column_name"]: r["n_clipped"] for r in clean.outlier_counts(df, ["x"]).collect()}["x"] == 0
    h = report.histogram(df, "x", 5)
    assert h.agg(F.sum(h.columns[-1])).first()[0] == 20
    assert report.correlation_pairs(df, ["x", "y"]).count() == 1


def test_null_contribution_is_no_driver(spark):
    rows = [(0, "a", 0.5), (1, "b", None), (2, "c", 0.9)]
    s = spark.createDataFrame([(rows,)], "c array<struct<pos:int,name:string,stress_contribution:double>>")
    assert [d["name"] for d in s.select(drivers.top_drivers(F.col("c"))).first()[0]] == ["c", "a"]


def test_split_of_large_keys(spark):
    assert 0 <= spark.createDataFrame([(2**62,)], "k long").select(models.split_bucket(F.col("k"))).first()[0] < 100


def test_respondent_without_a_valid_answer_stays(spark):
    bank = survey.option_bank(spark, "A")
    first = bank.first()
    answers = spark.createDataFrame([(1, 1, first["feature"], "1"), (2, 1, first["feature"], "99"), (2, 2, "nothing", "1"), (3, 1, first["feature"], "1"), (3, 2, first["feature"], "99")], "respondent_id int, answer_seq int, feature string, opt_idx string")
    wide = survey.answers_wide(survey.answers_to_values(answers, bank, keep_invalid=True), [first["feature"]])
    got = {r[0]: r[1] for r in wide.collect()}
    assert set(got) == {1, 2, 3} and got[2] is None and got[3] == got[1] is not None


def test_saved_model_scores_as_well_as_the_fitted_one(spark):
    got = queries()["model_roundtrip"](spark, SF_SMALL)
    truth = queries()["engineered"](spark, SF_SMALL).select("respondent_id", F.col("burnout_score").alias("truth"))
    worst = got.join(truth, "respondent_id").agg(F.max(F.abs(F.col("burnout_score") - F.col("truth"))), F.count("*")).first()
    assert worst[1] > 0 and worst[0] < 0.1, worst
