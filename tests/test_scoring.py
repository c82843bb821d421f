"""Feature ranges, score, bands, profiles and edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from wellscore.operators import features as feat
from wellscore.operators import report as rep
from wellscore.sources import fixtures as fx
from wellscore.spec import DEFAULT_SPEC, INDEX_TERMS

FEATS = DEFAULT_SPEC.features
HIGH = dict(zip(FEATS, [18, 5, 1, 22, 4, 3, 1, 4, 4, 1, 1, 1, 1, 5, 1, 5, 0, 5, 0, 5]))
LOW = dict(zip(FEATS, [2, 28, 0, 2, 0, 1, 5, 0, 1, 5, 5, 5, 5, 1, 5, 0, 3, 0, 5, 0]))


def test_weights_sum_to_one():
    DEFAULT_SPEC.validate_weights()
    DEFAULT_SPEC.validate_scales()


def test_zero_span_scale_rejected():
    from wellscore.spec import INDICATORS, Spec

    bad = Spec(indicators=[(n, lo, lo if n == "headache" else hi) for n, lo, hi in INDICATORS])
    with pytest.raises(ValueError):
        feat.index_columns(bad)


def test_fixture_facts(spark):
    r = fx.respondents(spark, SF_SMALL)
    assert len(r.columns) == 23
    assert r.count() == r.select("respondent_id").distinct().count()
    labels = {row[0] for row in r.select("stress_level").distinct().collect()}
    assert labels == {0, 1, 2}


def test_indices_in_unit_range_and_monotone_label_mean(spark):
    e = feat.engineer(fx.respondents(spark, SF_SMALL))
    for c in INDEX_TERMS:
        lo, hi = e.agg(F.min(c), F.max(c)).first()
        assert 0.0 <= lo and hi <= 1.01
    s = e.agg(F.min("burnout_score"), F.max("burnout_score")).first()
    assert s[0] == 0.0 and s[1] == 100.0
    means = [r["mean_score"] for r in feat.score_by_label(e).orderBy("stress_level").collect()]
    assert means[0] < means[1] < means[2]


@pytest.mark.parametrize("score,band", [(0.0, "Low"), (33.0, "Low"), (33.01, "Moderate"), (33.5, "Moderate"), (66.0, "Moderate"), (66.01, "High"), (100.0, "High")])
def test_band_edges(spark, score, band):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(feat.risk_band(F.col("s"))).first()[0] == band


@pytest.mark.parametrize("profile,check", [(HIGH, lambda s, b: s >= 60 and b == "High"), (LOW, lambda s, b: s <= 40 and b == "Low")])
def test_profiles(spark, profile, check):
    row = feat.frozen_range(fx.respondents(spark, SF_SMALL)).first()
    df = spark.createDataFrame([tuple(profile[f] for f in FEATS)], ", ".join(f"{f} int" for f in FEATS)).withColumn("respondent_id", F.lit(1))
    out = feat.formula_score(df, frozen=(row["mn"], row["mx"])).first()
    assert check(out["burnout_score"], out["risk_level"])


def test_minmax_constant_and_empty(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.5)], "id int, raw_score double")
    assert {r[0] for r in feat.minmax_score(df).select("burnout_score").collect()} == {0.0}
    empty = spark.createDataFrame([], "id int, raw_score double")
    assert feat.minmax_score(empty).count() == 0


def test_round_half_even_matches_numpy(spark):
    import numpy as np

    from wellscore.functions.columns import round_half_even

    vals = [0.125, 0.375, 2.675, 1.005, 33.005, 0.625, 12.5, -0.125]
    got = spark.createDataFrame([(v,) for v in vals], "x double").select(round_half_even(F.col("x"), 2)).collect()
    assert [r[0] for r in got] == [float(np.round(v, 2)) for v in vals]


def test_stress_sleep_ratio_at_zero_sleep(spark):
    df = spark.createDataFrame([(21, 0)], "anxiety_level int, sleep_quality int")
    ratio = df.select(feat.interaction_columns()["stress_sleep_ratio"]).first()[0]
    assert ratio == pytest.approx(21e6)


def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, c double")
    out = {(r["row_col"], r["col_col"]): r["corr"] for r in rep.correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert out[("b", "a")] == pytest.approx(1.0, abs=0.01)
    assert out[("c", "a")] is None and out[("c", "b")] is None


def test_correlation_pairwise_complete_with_nulls(spark):
    rows = [(1.0, 1.0), (2.0, 2.0), (3.0, None), (4.0, 4.5), (None, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = rep.correlation_pairs(df, ["a", "b"]).first()["corr"]
    import numpy as np

    x = np.array([1.0, 2.0, 4.0])
    y = np.array([1.0, 2.0, 4.5])
    assert got == round(float(np.corrcoef(x, y)[0, 1]), 2)


def test_histogram_matches_numpy(spark):
    import numpy as np

    vals = [0.0, 1.5, 2.25, 10.0, 3.33, 6.67, 9.99, 10.0, 5.0]
    df = spark.createDataFrame([(v,) for v in vals], "burnout_score double")
    got = [r["n"] for r in rep.histogram(df, bins=30).orderBy("bin").collect()]
    assert got == list(np.histogram(vals, bins=30)[0])


def test_box_stats_whiskers(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([("g", v) for v in vals], "g string, burnout_score double")
    r = rep.box_stats(df, "g").first()
    assert r["whisker_hi"] == 5.0 and r["n_outliers"] == 1 and r["whisker_lo"] == 1.0
    assert not math.isnan(r["notch_lo"])


def test_approx_paths_of_report_quantiles(spark):
    df = spark.range(0, 10001).select((F.col("id") / 100.0).alias("burnout_score"), (F.col("id") % 3).alias("g"))
    ex, ap = rep.center(df).first(), rep.center(df, approx=True).first()
    assert abs(ex["median_score"] - ap["median_score"]) <= 0.05
    bx = {r["g"]: r for r in rep.box_stats(df, "g").collect()}
    ba = {r["g"]: r for r in rep.box_stats(df, "g", approx=True).collect()}
    for g in bx:
        assert abs(bx[g]["median"] - ba[g]["median"]) <= 0.05
    from wellscore.operators import validate as val

    d1, d2 = val.describe(df, "burnout_score").first(), val.describe(df, "burnout_score", approx=True).first()
    assert abs(d1["p75"] - d2["p75"]) <= 0.05
