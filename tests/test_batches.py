"""Summaries merged from batches' sketches, scores over batches, NaN in drivers and interactions."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from wellscore.operators import drivers as drv
from wellscore.operators import features as feat
from wellscore.operators import score_store as store
from wellscore.operators import sketches
from wellscore.session import scratch_path
from wellscore.sources.fixtures import respondent_exprs


def test_sketches_merge_in_any_order(spark):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.lognormal(3, 2, 20_000), np.full(9_000, 7.0)])  # a hot value holds a third
    frame = pd.DataFrame({"x": rng.permutation(x), "batch": rng.integers(0, 5, len(x)), "none": np.nan})
    df = spark.createDataFrame(frame)
    path = scratch_path(spark, "t-sk")
    for b in (3, 0, 1, 4, 2, 0):  # one batch twice
        sketches.add_batch(df.where(F.col("batch") == b), ["x", "none"], path, b)
    parts = sketches.read_parts(spark, path)
    got = {r["column_name"]: r for r in sketches.merged(parts, [0.01, 0.25, 0.5, 0.9, 0.999]).collect()}
    r = got["x"]
    assert r["count"] == len(x) and r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std(ddof=1)) and (r["min"], r["max"]) == (x.min(), x.max())
    for p, q in zip([0.01, 0.25, 0.5, 0.9, 0.999], r["quantiles"], strict=True):
        assert (x < q).mean() <= p + 0.01 and (x <= q).mean() >= p - 0.01
    assert got["none"]["count"] == 0 and got["none"]["quantiles"] is None
    for order in itertools.islice(itertools.permutations(range(5)), 0, 120, 50):
        again = sketches.merged(parts.orderBy(F.element_at(F.lit(list(order)), F.col("batch_id").cast("int") + 1))).where("column_name = 'x'").first()
        assert again["count"] == len(x) and abs((x <= again["quantiles"][1]).mean() - (x <= r["quantiles"][2]).mean()) < 0.02


def test_only_a_widened_range_scales_old_batches_again(spark):
    rows = spark.range(400).selectExpr(*respondent_exprs("spark", key="id", cohort=None))
    raw = feat.add_raw_score(feat.add_indices(rows)).select("respondent_id", "raw_score").toPandas().sort_values("raw_score")
    middle, ends = raw["respondent_id"].iloc[50:350].tolist(), raw["respondent_id"].iloc[:50].tolist() + raw["respondent_id"].iloc[350:].tolist()
    path = scratch_path(spark, "t-store")
    part = lambda ids: rows.where(F.col("respondent_id").isin(ids))
    assert not store.add_batch(part(middle[:1] + middle[-1:]), path, 0)
    assert not store.add_batch(part(middle[1:-1]), path, 1)  # inside the range
    assert store.score_range(spark, path) == (raw["raw_score"].iloc[50], raw["raw_score"].iloc[349])
    assert store.add_batch(part(ends), path, 2)
    assert not store.add_batch(part(ends), path, 2)  # a retried batch changes nothing
    assert not store.add_batch(rows.limit(0), path, 3)
    want = {r["respondent_id"]: r["burnout_score"] for r in feat.engineer(rows).select("respondent_id", "burnout_score").collect()}
    got = {r["respondent_id"]: r["burnout_score"] for r in store.scores(spark, path).collect()}
    assert got == want and store.scores(spark, path).count() == 400


def test_nan_is_missing_in_drivers_and_interactions(spark):
    row = spark.range(1).selectExpr(*respondent_exprs("spark", key="id", cohort=None))
    row = row.withColumns({c: F.lit(float("nan")) for c in ("noise_level", "social_support")})
    names = [r["name"] for r in drv.top_drivers_long(row, n=20).collect()]
    assert "noise_level" not in names and "social_support" not in names and len(names) == 18
    for mode in ("train", "score"):
        assert feat.add_interactions(row, mode).first()["isolation_index"] is None
